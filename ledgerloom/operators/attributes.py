"""Attribute lookup tables: how often each value of each text column occurs.

Given a table, every text column becomes an ``attribute`` and each of its
non-NULL values a row ``(attribute, value, row_count)``. The lookup table
serves auto-completion: find the values of one attribute that match what a
user typed, most frequent first.

Plan: one scan of the text columns, one ``Expand`` (unpivot) and a two-phase
hash aggregate — partial counts are combined map-side before the shuffle, so a
column with few distinct values (or one value holding most rows) moves only
one row per value and task. The original toolkit issued one scan per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import like_escape, trigram_similarity, trigrams

ATTRIBUTE_SCHEMA = T.StructType([
    T.StructField("attribute", T.StringType(), False),
    T.StructField("value", T.StringType(), False),
    T.StructField("row_count", T.LongType(), False),
])

# Fixed value: the default similarity threshold of trigram matching.
DEFAULT_SIMILARITY_THRESHOLD = 0.3


def quote_name(name: str) -> str:
    """A column name as a backtick-quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def text_columns(df: DataFrame) -> list[str]:
    """Names of all string-typed columns (text, varchar, char, enum labels)."""
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))
    ]


def attribute_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(attribute, value, row_count)`` for every text column; NULLs skipped,
    empty strings kept. A table without text columns gives an empty result."""
    cols = text_columns(df) if columns is None else list(columns)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], ATTRIBUTE_SCHEMA)
    # names may hold dots or backticks: refer to each column by a quoted name
    # and let the alias carry the attribute name
    values = [F.col(quote_name(c)).cast("string").alias(c) for c in cols]
    long = df.unpivot([], values, "attribute", "value").where(F.col("value").isNotNull())
    return long.groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("row_count"))


# Column holding a value's precomputed trigrams in a stored attribute table.
TRIGRAM_COLUMN = "value_trigrams"


def write_attributes(attrs: DataFrame, path: str, mode: str = "overwrite",
                     with_trigrams: bool = False) -> None:
    """One folder per attribute, values sorted inside the files.

    Range-partitioning on (attribute, value) keeps a large attribute from
    landing in a single task and gives each file tight min/max statistics on
    ``value``, so prefix lookups skip row groups. ``with_trigrams`` stores
    each value's trigrams (the counterpart of a trigram index), so similarity
    lookups read them instead of recomputing them.
    """
    if with_trigrams:
        attrs = attrs.withColumn(TRIGRAM_COLUMN, trigrams(F.col("value")))
    (
        attrs.repartitionByRange("attribute", "value")
        .sortWithinPartitions("attribute", "value")
        .write.mode(mode)
        .option("partitionOverwriteMode", "static")  # a rewrite drops attributes that are gone
        .partitionBy("attribute")
        .parquet(path)
    )


def autocomplete(attrs: DataFrame, attribute: str, typed: str, k: int = 10,
                 mode: str = "substring", case_sensitive: bool = False) -> DataFrame:
    """Top-k values of one attribute containing (or starting with) ``typed``,
    most frequent first, ties by value.

    The ``attribute`` filter prunes partitions of a table written by
    :func:`write_attributes`; the top-k is a bounded ``TakeOrderedAndProject``.
    A case-sensitive prefix lookup is pushed into the Parquet scan, where the
    value-sorted files let row-group statistics skip everything else.
    """
    if mode not in ("substring", "prefix"):
        raise ValueError("mode must be 'substring' or 'prefix'")
    if case_sensitive:
        match = F.col("value").startswith(typed) if mode == "prefix" else F.col("value").contains(typed)
    else:
        pattern = like_escape(typed.lower()) + "%"
        if mode == "substring":
            pattern = "%" + pattern
        match = F.lower(F.col("value")).like(pattern)
    return (
        attrs.where(F.col("attribute") == F.lit(attribute))
        .where(match)
        .select("value", "row_count")
        .orderBy(F.col("row_count").desc(), F.col("value").asc())
        .limit(k)
    )


def similar_values(attrs: DataFrame, attribute: str, typed: str, k: int = 10,
                   threshold: float = DEFAULT_SIMILARITY_THRESHOLD) -> DataFrame:
    """Top-k values of one attribute by word-trigram similarity to ``typed``.

    The typed text's trigrams are a constant array, so each value is scored on
    its own (array intersection) in the scan: no join, no shuffle, then a
    bounded top-k. ``similarity`` is rounded to 6 places.
    """
    if threshold <= 0:
        raise ValueError("threshold must be > 0")
    query = trigrams(F.lit(typed))
    grams = F.col(TRIGRAM_COLUMN) if TRIGRAM_COLUMN in attrs.columns else trigrams(F.col("value"))
    sim = trigram_similarity(grams, query)
    return (
        attrs.where(F.col("attribute") == F.lit(attribute))
        .select("value", "row_count", sim.alias("_sim"))
        .where(F.col("_sim") >= F.lit(threshold))
        .orderBy(F.col("_sim").desc(), F.col("row_count").desc(), F.col("value").asc())
        .limit(k)
        .select("value", "row_count", F.round("_sim", 6).alias("similarity"))
    )


# Fixed value: the default name suffix of an attribute table.
ATTRIBUTES_SUFFIX = "_attributes"


def create_attributes_table(spark, source_table: str, suffix: str = ATTRIBUTES_SUFFIX,
                            path: str | None = None) -> str:
    """Build ``<source_table><suffix>`` as a catalog table partitioned by
    attribute (replacing an existing one) and return its name."""
    from ledgerloom.session import partition_overwrite
    target = source_table + suffix
    attrs = attribute_counts(spark.table(source_table))
    writer = (
        attrs.repartitionByRange("attribute", "value").sortWithinPartitions("attribute", "value")
        .write.format("parquet").mode("overwrite").partitionBy("attribute")
    )
    if path is not None:
        writer = writer.option("path", path)
    with partition_overwrite(spark, "static"):  # a rebuild drops attributes that are gone
        writer.saveAsTable(target)
    return target
