"""Distinct counts that roll up: HyperLogLog sketches.

The original toolkit sums stored HLL values (union, then cardinality). Spark's
built-in sketches are Apache DataSketches HLL: mergeable binary columns, so a
detail table stores one sketch per group and any coarser grouping is a union
of those — without going back to the raw rows and without an exact
``count(distinct)`` shuffle. Sketches are not byte-compatible with the
original toolkit's; only the estimates are comparable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

# Fixed value: default sketch size (2^12 registers, about 1.6 % standard error).
DEFAULT_LG_K = 12


def hll_sketches(df: DataFrame, group_cols: list[str], value_col: str,
                 lg_k: int = DEFAULT_LG_K, out: str = "sketch") -> DataFrame:
    """One mergeable sketch of ``value_col`` per group (map-side partial
    aggregation: each task ships one sketch per group)."""
    return df.groupBy(*group_cols).agg(F.hll_sketch_agg(F.col(value_col), lg_k).alias(out))


def hll_union(sketches: DataFrame, group_cols: list[str], sketch: str = "sketch",
              out: str = "sketch") -> DataFrame:
    """Coarser sketches: the union of the detail sketches in each group."""
    return sketches.groupBy(*group_cols).agg(F.hll_union_agg(F.col(sketch), True).alias(out))


def hll_rollup(sketches: DataFrame, group_cols: list[str], sketch: str = "sketch",
               out: str = "distinct_estimate") -> DataFrame:
    """Union then estimate: the distinct count per (coarser) group."""
    return sketches.groupBy(*group_cols).agg(
        F.hll_sketch_estimate(F.hll_union_agg(F.col(sketch), True)).alias(out))


def sketch_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored sketches below ``path``, or None before the first load."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def load_sketches(df: DataFrame, path: str, group_cols: list[str], value_col: str, period_col: str,
                  lg_k: int = DEFAULT_LG_K, sketch: str = "sketch") -> None:
    """Merge the rows of one load into the sketches stored below ``path``.

    The table has a folder per period. The load's rows become one sketch per
    (group, period); stored sketches of the periods it touches are read, united
    with them by group and written back, other periods stay as they are. Raw
    rows of earlier loads are never read again, and loading rows twice changes
    nothing (a union has no duplicates). Rows without a period have their own."""
    spark = df.sparkSession
    keys = [*group_cols, period_col]
    fresh = hll_sketches(df, keys, value_col, lg_k, sketch)
    stored = sketch_table(spark, path)
    if stored is not None:
        touched = fresh.select(period_col).distinct()
        old = stored.join(touched, stored[period_col].eqNullSafe(touched[period_col]), "left_semi")
        fresh = hll_union(fresh.unionByName(old.select(*fresh.columns)), keys, sketch, sketch)
    (fresh.hint("rebalance", F.col(period_col)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(period_col).parquet(path))
