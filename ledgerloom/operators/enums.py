"""Enumerations kept as ordered dictionaries ``(value, ordinal)``.

An enum column in the original toolkit is a text column restricted to a list of
labels with a defined order. Here the list is a small DataFrame; membership
is a join, order is the ``ordinal`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.ordinals import number_in_order

ENUM_SCHEMA = T.StructType([
    T.StructField("value", T.StringType(), False),
    T.StructField("ordinal", T.IntegerType(), False),
])
# Fixed value: labels longer than this are reported by long_labels (never cut).
MAX_LABEL_CHARS = 63


def _from_list(spark: SparkSession, values: list[str]) -> DataFrame:
    seen: dict[str, int] = {}
    for v in values:
        if v is None:
            continue
        if v not in seen:
            seen[v] = len(seen)
    return spark.createDataFrame([(v, i) for v, i in seen.items()], "value string, _pos int")


def create_enum(values: DataFrame | list[str], column: str | None = None,
                spark: SparkSession | None = None, order_by: str | None = None) -> DataFrame:
    """A new dictionary. From a list: labels in list order. From a DataFrame:
    the distinct non-NULL values of ``column``, sorted by label, or by the
    smallest ``order_by`` value seen with each label (ties by label).
    NULLs are skipped; labels are kept whole."""
    if isinstance(values, list):
        if spark is None:
            raise ValueError("a SparkSession is needed to build an enum from a list")
        labels = _from_list(spark, values)
        if labels.isEmpty():
            return spark.createDataFrame([], ENUM_SCHEMA)
        return number_in_order(labels, ["_pos"]).select("value", "ordinal")
    col = column or values.columns[0]
    label = F.col(col).cast("string").alias("value")
    if order_by is not None:
        labels = (values.select(label, F.col(order_by).alias("_key"))
                  .where("value IS NOT NULL").groupBy("value").agg(F.min("_key").alias("_key")))
        return number_in_order(labels, ["_key", "value"]).select("value", "ordinal")
    labels = values.select(label).where("value IS NOT NULL").distinct()
    return number_in_order(labels, ["value"]).select("value", "ordinal")


def add_enum_values(enum: DataFrame, values: DataFrame | list[str], column: str | None = None) -> DataFrame:
    """The dictionary with new labels appended after the current largest
    ordinal. Labels already present add nothing; labels are kept whole."""
    spark = enum.sparkSession
    if isinstance(values, list):
        fresh = _from_list(spark, values)
    else:
        col = column or values.columns[0]
        fresh = values.select(F.col(col).cast("string").alias("value"), F.lit(0).alias("_pos")) \
            .where("value IS NOT NULL")
    fresh = (
        fresh.groupBy("value").agg(F.min("_pos").alias("_pos"))
        .join(enum.select("value"), "value", "left_anti")
    )
    top = enum.agg(F.coalesce(F.max("ordinal"), F.lit(0))).scalar()
    added = number_in_order(fresh, ["_pos", "value"], start=top).select("value", "ordinal")
    return enum.select("value", "ordinal").unionByName(added)


def long_labels(values: DataFrame | list[str], column: str | None = None,
                spark: SparkSession | None = None) -> DataFrame:
    """Labels over 63 characters, with their length: candidates for a review before a load."""
    if isinstance(values, list):
        values = (spark or SparkSession.active()).createDataFrame([(v,) for v in values], "value string")
        column = "value"
    col = column or values.columns[0]
    v = F.col(col).cast("string")
    return values.select(v.alias("value"), F.char_length(v).alias("chars")).where(F.col("chars") > MAX_LABEL_CHARS).distinct()


def with_ordinal(df: DataFrame, column: str, enum: DataFrame, out: str | None = None) -> DataFrame:
    """Attach each row's label ordinal (NULL for labels outside the enum)."""
    name = out or f"{column}_ordinal"
    d = enum.select(F.col("value").alias("_label"), F.col("ordinal").alias(name))
    return df.join(d, F.col(column) == F.col("_label"), "left").drop("_label")


def outside_enum(df: DataFrame, column: str, enum: DataFrame) -> DataFrame:
    """Rows whose non-NULL label is not in the enum."""
    d = enum.select(F.col("value").alias("_label"))
    return df.where(F.col(column).isNotNull()).join(d, F.col(column) == F.col("_label"), "left_anti")
