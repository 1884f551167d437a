"""Consecutive numbering of a DataFrame in a given order, without a
single-partition window.

Rows are range-partitioned on the order columns and checkpointed, so each
row's partition is fixed; the row count of every partition (one row per
partition) gives each partition's offset, and ``row_number`` inside the
partition finishes the job. The only data gathered in one place is the list
of partition sizes, whose length is the partition count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.session import ensure_checkpoint_dir


def number_in_order(df: DataFrame, order_cols: list[str], out: str = "ordinal",
                    start: Column | int = 0) -> DataFrame:
    """Add ``out`` = start + 1, start + 2, ... following ``order_cols``
    (ascending, NULLs first). Ties get distinct numbers in arbitrary order.

    Meant for unique orderings (distinct labels, positions): range bounds
    cannot split equal keys, so a value repeated many times would make one
    range partition large."""
    ensure_checkpoint_dir(df.sparkSession)
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    placed = (
        df.repartitionByRange(*order)
        .withColumn("_part", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    base = F.lit(start) if isinstance(start, int) else start
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(out, (base + F.col("_offset") + F.row_number().over(inside)).cast("int"))
        .drop("_part", "_offset")
    )
