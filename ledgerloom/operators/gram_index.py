"""A stored index for lookups in attribute values: postings by gram.

The counterpart of a trigram index for the two lookups of
:mod:`ledgerloom.operators.attributes`. Below one folder:

* ``words``: for every value the trigrams of its words (similarity);
* ``parts``: for every value its lower-cased substrings of up to three
  characters (substring and prefix lookups);
* ``sizes``: how many values a gram has, which tells rare grams from common;
* ``first``: the ``KEPT`` most frequent values of every part, in order.

Postings are range-partitioned and sorted by (gram, number of grams, value)
inside a folder per attribute, so a lookup prunes folders by attribute and row
groups by gram: what it reads grows with the asked grams' postings, not with
the values. Everything is one row per (gram, value), combined map-side where it
is counted; a gram that all values have spreads over several tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.text import like_escape, trigram_similarity, trigrams
from ledgerloom.operators.attributes import DEFAULT_SIMILARITY_THRESHOLD

# The longest part kept, and the values listed per part.
PART = 3
KEPT = 100


def parts(text: Column) -> Column:
    """The distinct substrings of up to ``PART`` characters, lower-cased; the
    empty one lists every value."""
    low = F.lower(text)
    size = F.length(low)
    of = lambda n: F.when(size >= n, F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(low, i, n)))
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.array(F.lit("")), *[F.coalesce(of(n), none) for n in range(1, PART + 1)]))


def _sorted(postings: DataFrame) -> DataFrame:
    keys = ["attribute", "gram", "n_grams", "value"]
    return postings.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _store(df: DataFrame, path: str, block: int | None) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("attribute")
    if block:  # bytes of a row group: smaller ones skip more finely
        writer = writer.option("parquet.block.size", str(block)).option("parquet.page.row.count.limit", "2000")
    writer.parquet(path)


def write_gram_index(attrs: DataFrame, path: str, kept: int = KEPT, block: int | None = None) -> None:
    """Index ``(attribute, value, row_count)`` below ``path``, replacing an
    older index there. ``block`` sets the bytes of a row group."""
    base = attrs.where("attribute is not null and value is not null").select("attribute", "value", "row_count")
    for kind, grams in (("words", trigrams(F.col("value"))), ("parts", parts(F.col("value")))):
        keyed = base.withColumn("grams", grams).withColumn("n_grams", F.size("grams"))
        postings = keyed.select("attribute", F.explode("grams").alias("gram"), "n_grams", "value", "row_count")
        _store(_sorted(postings), f"{path}/{kind}", block)
    spark = attrs.sparkSession
    both = [spark.read.parquet(f"{path}/{kind}").groupBy("attribute", F.lit(kind).alias("kind"), "gram").agg(
        F.count(F.lit(1)).alias("n_values")) for kind in ("words", "parts")]
    sizes = both[0].unionByName(both[1])
    _store(sizes.repartitionByRange("attribute", "gram").sortWithinPartitions("attribute", "gram"), f"{path}/sizes", block)
    most = Window.partitionBy("attribute", "gram").orderBy(F.col("row_count").desc(), F.col("value").asc())
    # a list of few values per gram: each task sends its own first ones only
    split = Window.partitionBy("attribute", "gram", F.pmod(F.xxhash64("value"), F.lit(32))).orderBy(
        F.col("row_count").desc(), F.col("value").asc())
    some = (spark.read.parquet(f"{path}/parts").select("attribute", "gram", "value", "row_count")
            .withColumn("rank", F.row_number().over(split)).where(F.col("rank") <= kept))
    first = some.withColumn("rank", F.row_number().over(most)).where(F.col("rank") <= kept)
    _store(first.repartitionByRange("attribute", "gram", "rank").sortWithinPartitions("attribute", "gram", "rank"),
           f"{path}/first", block)


def _sizes(spark: SparkSession, path: str, attribute: str, kind: str, grams: list[str]) -> dict[str, int]:
    """How many values have each of the typed text's grams (as many rows at most)."""
    found = spark.read.parquet(f"{path}/sizes").where(
        (F.col("attribute") == attribute) & (F.col("kind") == kind) & F.col("gram").isin(grams))
    return {r["gram"]: r["n_values"] for r in found.select("gram", "n_values").collect()}


def _grams_of(spark: SparkSession, grams: Column) -> list[str]:
    return spark.range(1).select(grams.alias("g")).first()["g"]


def _nothing(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _postings(spark: SparkSession, path: str, attribute: str, kind: str, grams: list[str]) -> DataFrame:
    return spark.read.parquet(f"{path}/{kind}").where((F.col("attribute") == attribute) & F.col("gram").isin(grams))


def indexed_autocomplete(spark: SparkSession, path: str, attribute: str, typed: str, k: int = 10,
                         mode: str = "substring", kept: int = KEPT) -> DataFrame:
    """Top-k values that contain (or start with) ``typed``, as
    :func:`ledgerloom.operators.attributes.autocomplete` without case.

    A typed part of up to ``PART`` characters, asked as a substring for up to
    ``kept`` values (what the index was written with), is one list in
    ``first``. Otherwise the postings of its rarest part are read and the match
    is verified on the value. An empty text matches every value. The typed text
    may hold any characters; wildcards are taken literally."""
    if mode not in ("substring", "prefix"):
        raise ValueError("mode must be 'substring' or 'prefix'")
    low = spark.range(1).select(F.lower(F.lit(typed)).alias("t")).first()["t"]
    order = [F.col("row_count").desc(), F.col("value").asc()]
    if (mode == "substring" or not low) and len(low) <= PART and k <= kept:
        first = spark.read.parquet(f"{path}/first").where((F.col("attribute") == attribute) & (F.col("gram") == low))
        return first.where(F.col("rank") <= k).select("value", "row_count").orderBy(*order).limit(k)
    size = min(PART, len(low))
    asked = sorted({low[i:i + size] for i in range(len(low) - size + 1)})
    pattern = like_escape(low) + "%"
    match = F.lower(F.col("value")).like(pattern if mode == "prefix" else "%" + pattern)
    sizes = _sizes(spark, path, attribute, "parts", asked)
    if len(sizes) < len(asked):  # a part that no value has
        return _nothing(spark, "value string, row_count long")
    rarest = min(asked, key=lambda g: (sizes[g], g))
    return (_postings(spark, path, attribute, "parts", [rarest]).where(match)
            .select("value", "row_count").orderBy(*order).limit(k))


def asked_grams(sizes: dict[str, int], grams: list[str], threshold: float) -> tuple[list[str], int, int]:
    """``(grams to look up, least and most grams of a value)`` for a similarity
    of ``threshold`` or more to a text with ``grams``.

    shared / union >= t needs shared >= t * |grams|, so a value without any of
    the |grams| - ceil(t |grams|) + 1 rarest ones is out (prefix filter), and
    so is one with fewer than t |grams| or more than |grams| / t (count filter)."""
    n = len(grams)
    need = max(1, math.ceil(threshold * n - 1e-9))
    rare = sorted(grams, key=lambda g: (sizes.get(g, 0), g))[:n - need + 1]
    return [g for g in rare if sizes.get(g, 0)], need, math.floor(n / threshold + 1e-9)


def indexed_similar_values(spark: SparkSession, path: str, attribute: str, typed: str, k: int = 10,
                           threshold: float = DEFAULT_SIMILARITY_THRESHOLD) -> DataFrame:
    """Top-k values by word-trigram similarity to ``typed``, as
    :func:`ledgerloom.operators.attributes.similar_values`, from the postings of
    the rarest typed trigrams. Candidates are scored on their whole text."""
    if threshold <= 0:
        raise ValueError("threshold must be > 0")
    grams = _grams_of(spark, trigrams(F.lit(typed)))
    rare, least, most = asked_grams(_sizes(spark, path, attribute, "words", grams), grams, threshold)
    if not rare:
        return _nothing(spark, "value string, row_count long, similarity double")
    candidates = (_postings(spark, path, attribute, "words", rare).where(F.col("n_grams").between(least, most))
                  .select("value", "row_count").distinct())
    sim = trigram_similarity(trigrams(F.col("value")), F.array(*[F.lit(g) for g in grams]))
    return (candidates.select("value", "row_count", sim.alias("_sim")).where(F.col("_sim") >= F.lit(threshold))
            .orderBy(F.col("_sim").desc(), F.col("row_count").desc(), F.col("value").asc()).limit(k)
            .select("value", "row_count", F.round("_sim", 6).alias("similarity")))
