"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a target in words by its weight, at most ``cap`` times its
own size. Whole passes over the source come first; the rest of its target is
filled by choosing documents: documents are counted by exact length, each
length first gives its proportional share, then single documents by largest
remainder, and a bounded-knapsack dynamic programme over the counts that are
left closes the remaining gap. The plan is a number of documents per source
and length; which ones is decided by a seeded hash of the ids, ranked inside
hash buckets, so a length that a third of all documents share is not one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from ledgerloom.llm.graph import stored
from ledgerloom.llm.workers import ready
from ledgerloom.operators.ordinals import number_in_order

WEIGHTS, CAP, SEED = (5, 2, 1), 3, 17
BUCKETS = 256
GAP = 1 << 15  # words left to the dynamic programme, besides one document's


def n_words(text: str = "text") -> Column:
    """Number of runs of characters other than ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(spark: SparkSession, sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   cap: int = CAP) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources in code-point order, null last, weigh ``weights``, repeating. The
    total size is shared by weight; a source above ``cap`` times its own size
    is held there and the excess shared among the others, until none is above.
    """
    keyed = sizes.select("source", "source_size", F.col("source").isNull().alias("_last"))
    numbered = number_in_order(keyed, ["_last", "source"], "n")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.col("n") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = stored(spark, numbered.select("source", "source_size", w.cast("double").alias("w")), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    rate, limit = 0.0, F.lit(float(cap)) * F.col("source_size")
    while total:
        held = F.col("w") * F.lit(rate) > limit if rate else F.lit(False)
        fixed, free = table.agg(F.sum(F.when(held, F.col("source_size")).otherwise(F.lit(0))),
                                F.sum(F.when(held, F.lit(0.0)).otherwise(F.col("w")))).first()
        if not free:
            break
        new = (total - cap * fixed) / free
        if new <= rate:
            break
        rate = new
    return table.select("source", "source_size", F.least(F.col("w") * F.lit(rate), limit).alias("target"))


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to choose so that their sizes sum as
    near to ``budget`` as found; exact whenever the last gap can be filled."""
    chosen = np.zeros(len(sizes), dtype=np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or total == 0:
        return chosen
    if budget >= total:
        return counts.astype(np.int64).copy()
    share = counts * (budget / total)
    chosen = np.minimum(np.floor(share), counts).astype(np.int64)
    left = budget - int((sizes * chosen).sum())
    order = np.lexsort((sizes, chosen - share))
    order = order[(chosen < counts)[order]]
    run = np.cumsum(sizes[order])
    some = order[:int(np.searchsorted(run, max(0, left - GAP), side="right"))]
    chosen[some] += 1
    left -= int(sizes[some].sum())
    # dynamic programme over what is left: reached[s] holds the step that first reached sum s
    spare = counts - chosen
    useful = np.flatnonzero((spare > 0) & (sizes > 0))
    if left <= 0 or len(useful) == 0:
        return chosen
    top = left + int(sizes[useful].min())
    reached = np.full(top + 1, -1, dtype=np.int32)
    reached[0] = 0
    steps: list[tuple[int, int]] = [(0, 0)]  # (index into sizes, documents)
    for i in useful[np.argsort(sizes[useful], kind="stable")]:
        size, rest, piece = int(sizes[i]), int(min(spare[i], top // int(sizes[i]))), 1
        while rest > 0 and reached[left] < 0:
            take = min(piece, rest)
            rest, piece = rest - take, piece * 2
            move = size * take
            fresh = np.flatnonzero((reached[:top + 1 - move] >= 0) & (reached[move:] < 0)) + move
            reached[fresh] = len(steps)
            steps.append((int(i), take))
        if reached[left] >= 0:
            break
    sums = np.flatnonzero(reached >= 0)
    at = int(sums[np.argmin(np.abs(sums - left), axis=0)])
    while at:
        i, take = steps[reached[at]]
        chosen[i] += take
        at -= int(sizes[i]) * take
    return chosen


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("size")
    sizes, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    whole, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    passes = int(target // whole) if whole else 0
    extra = fit_counts(sizes, counts, int(round(target - passes * whole))) if whole else counts * 0
    return pd.DataFrame({"source": pdf["source"], "size": sizes, "passes": passes, "extra": extra})


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP,
        seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)`` per row.

    ``copies`` is how often the mix takes the document (0 to ``cap``), ``taken``
    the words that makes. Null texts and texts without words have size 0 and
    are not taken. Null sources are one source, the last. Rows equal in id,
    source and size are interchangeable. An empty table gives no rows; the
    same rows give the same mix, in whatever order and partitions they come."""
    same = ["_key", "doc_id", "source", "size"]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       n_words(text_col).alias("size"))
    rows = rows.withColumn("_key", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "source", "size"))
    rows = stored(spark, rows.groupBy(*same).agg(F.count("*").alias("n")), "lengths")
    rows = rows.withColumn("_bucket", F.pmod("_key", F.lit(BUCKETS)).cast("int"))
    by_bucket = rows.groupBy("source", "size", "_bucket").agg(F.sum("n").alias("n"))
    hist = stored(spark, by_bucket, "histogram")
    targets = stored(spark, source_targets(
        spark, hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, cap), "targets")
    counts = hist.groupBy("source", "size").agg(F.sum("n").alias("n"))
    named = targets.withColumnRenamed("source", "_source")
    at = F.col("source").eqNullSafe(F.col("_source"))
    kind = docs.schema[source_col].dataType
    plan_schema = T.StructType([T.StructField("source", kind), T.StructField("size", T.LongType()),
                                T.StructField("passes", T.LongType()), T.StructField("extra", T.LongType())])
    plan = stored(spark, ready(counts).join(named, at).drop("_source").groupBy("source")
                  .applyInPandas(_plan, plan_schema), "plan")
    before = W.Window.partitionBy("source", "size").orderBy("_bucket").rowsBetween(W.Window.unboundedPreceding, -1)
    key = [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("source", "size")]
    offsets = hist.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    plan_at = (offsets.alias("r").join(plan.alias("p"), key).select("r.*", "p.passes", "p.extra")
               .join(named, at).drop("_source"))
    inside = (W.Window.partitionBy("source", "size", "_bucket").orderBy("_key", "doc_id")
              .rowsBetween(W.Window.unboundedPreceding, -1))
    ranked = rows.withColumn("_rank", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    key = [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("source", "size", "_bucket")]
    full = ranked.alias("r").join(plan_at.alias("p"), key).select("r.*", "p.passes", "p.extra", "p._before",
                                                                  "p.source_size", "p.target")
    # of n equal rows, those ranked below the number wanted are taken once more
    once = F.greatest(F.lit(0), F.least(F.col("n"), F.col("extra") - F.col("_before") - F.col("_rank")))
    each = full.withColumn("_part", F.explode(F.array(
        F.struct(F.lit(1).alias("more"), once.alias("k")),
        F.struct(F.lit(0).alias("more"), (F.col("n") - once).alias("k"))))).where("_part.k > 0")
    each = each.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_part.k"))))
    copies = F.when(F.col("size") > 0, F.col("passes") + F.col("_part.more")).otherwise(F.lit(0)).cast("int")
    return each.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                       (copies * F.col("size")).cast("long").alias("taken"))


def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it does. Rows
    that share id, source and size share their copies in the order of a hash of
    the whole row, so the result is the same on every run."""
    plan = mix(spark, docs, **options).where("copies > 0")
    per = plan.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"), F.sum("copies").alias("copies"))
    # the row travels as one column, so none of its names can clash
    sized = docs.select(F.struct(*docs.columns).alias("doc"), n_words().alias("words"))
    on = (F.col("doc.doc_id").eqNullSafe(per["doc_id"]) & F.col("doc.source").eqNullSafe(per["source"])
          & (F.col("words") == per["size"]))
    joined = sized.join(per, on).select("doc", "words", "n", "copies")
    rank = F.row_number().over(W.Window.partitionBy("doc.doc_id", "doc.source", "words").orderBy(F.xxhash64("doc")))
    one = joined.where("n = 1").select("doc", "copies")
    # rows that share id, source and size
    more = joined.where("n > 1").withColumn("r", rank).select("doc", (
        F.floor(F.col("copies") / F.col("n")) + (F.col("r") <= F.pmod("copies", "n")).cast("long")).cast("long").alias("copies"))
    return (one.unionByName(more).where("copies > 0")
            .select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("doc.*"))
