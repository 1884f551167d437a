"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

1. Words are counted per task, then by word; those rare or short are left out.
2. Words of one length are cut into cells by the upper levels of a k-d tree over
   their letter counts, fitted on about ``sample`` words. Every word is filed in
   its cell; as a query it goes to the cells of its own length and of the next
   one whose boxes are in reach (``kd_tree``).
3. Each cell is a task's group: a k-d tree with tight boxes over its words is
   searched for the queries, and letter order is verified on whole words. Cells
   that are too full are dealt into tiles that all of their queries visit.
4. A word's form is its most frequent near word, if that is at least twice as
   frequent; forms are followed to the last by pointer doubling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.graph import stored
from ledgerloom.llm.kd_tree import Tree, code_points, near_rows, vectors
from ledgerloom.llm.workers import ready

MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
#: One in so many words of a document loses a letter before it is counted.
DELETES = 97
#: Words a cell is meant for (fewer where they are long), levels of the upper tree, words it is fitted on.
CELL, LEVELS, SAMPLE = 4096, 12, 40_000
#: Characters of text looked at in one go, distinct words a task counts at a time.
CHUNK, KNOWN = 1 << 20, 1 << 18
# The letters of a word.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
OUTSIDE = re.compile("[^A-Za-zÀ-ÿ]")

PAIRS = "word string, near string, near_n long"


def runs(text: str) -> Iterator[list[str]]:
    """The maximal runs of letters of a text, those of about CHUNK characters at a time."""
    at = 0
    while at < len(text):
        gap = OUTSIDE.search(text, min(len(text), at + CHUNK))
        end = gap.start() if gap else len(text)
        yield RUN.findall(text, at, end)
        at = end


def spelt(run: str, start: int, deletes: int = DELETES) -> str:
    """``run`` as a document spells it, one in ``deletes`` without a letter;
    ``start`` is the CRC-32 of the document's id and a colon."""
    h = zlib.crc32(run.encode(), start)
    return run if h % deletes else run[:h % len(run)] + run[h % len(run) + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, deletes: int = DELETES,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)``: words of at least ``min_length`` code points and
    ``min_count`` occurrences."""
    def some(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                if not text:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for part in runs(text.lower().decode("utf-8", "replace")):
                    for word, k in Counter(part).items():
                        if len(word) >= min_length:
                            word = spelt(word, start, deletes)
                            if len(word) >= min_length:
                                counts[word] += k
                    if len(counts) >= KNOWN:
                        yield some(counts)
                        counts.clear()
        yield some(counts)

    source = ready(docs).select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def _capacity(length: int, cell: int) -> int:
    return max(1, cell * 16 // max(16, length))


def upper_trees(words: DataFrame, cell: int = CELL, levels: int = LEVELS, sample: int = SAMPLE) -> dict[int, Tree]:
    """The tree of each length that has more words than a cell holds."""
    sizes = {r["length"]: r["n"] for r in words.groupBy(F.char_length("word").alias("length")).agg(F.count("*").alias("n"))
             .where(F.col("n") * F.greatest(F.lit(16), "length") > cell * 16).toLocalIterator()}
    if not sizes:
        return {}
    every = max(1, sum(sizes.values()) // sample)
    drawn: dict[int, list[str]] = {}
    for r in words.where(F.char_length("word").isin(list(sizes)) & (F.pmod(F.xxhash64("word"), F.lit(every)) == 0)).toLocalIterator():
        drawn.setdefault(len(r["word"]), []).append(r["word"])
    trees = {}
    for length, some in sorted(drawn.items()):
        leaves = 1 << min(levels, (sizes[length] // _capacity(length, cell)).bit_length())
        trees[length] = Tree(vectors(code_points(sorted(some))), leaves, tight=False)
    return trees


def _by_length(words: list[str]) -> dict[int, np.ndarray]:
    lengths = np.array([len(w) for w in words])
    return {int(n): np.flatnonzero(lengths == n) for n in np.unique(lengths)}


def filed(words: DataFrame, trees, queries: bool) -> DataFrame:
    """``(length, leaf, word, n)``: each word in its own cell or, as a query,
    in all cells in reach (``length`` is that of the cell's words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, count = b.column(0).to_pylist(), b.column(1).to_numpy()
            for length, at in _by_length(text).items():
                v = vectors(code_points([text[i] for i in at]))
                for target, up, down in ((length, 1, 1), (length + 1, 1, 0)) if queries else ((length, 0, 0),):
                    tree = trees.value.get(target)
                    if tree is None:
                        row, leaf = np.arange(len(at)), np.zeros(len(at), dtype=np.int64)
                    elif queries:
                        row, node = tree.reach(v, up, down)
                        leaf = tree.leaf[node]
                    else:
                        row, leaf = np.arange(len(at)), tree.leaf_of(v)
                    mine = at[row]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(mine), target, dtype=np.int32)), pa.array(leaf.astype(np.int32)),
                         pa.array([text[i] for i in mine], pa.string()), pa.array(count[mine])],
                        names=["length", "leaf", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "length int, leaf int, word string, n long")


def near_words(spark: SparkSession, words: DataFrame, cell: int = CELL, levels: int = LEVELS, sample: int = SAMPLE) -> DataFrame:
    """``(word, near, near_n)``: every word one edit away from each word of the
    written table ``(word, n)``, with its n."""
    trees = spark.sparkContext.broadcast(upper_trees(ready(words), cell, levels, sample))
    index = filed(words, trees, False)
    most = F.greatest(F.lit(1), F.floor(F.lit(cell * 16) / F.greatest(F.lit(16), F.col("length"))))
    full = (index.groupBy("length", "leaf").agg(F.count("*").alias("rows"))
            .select("length", "leaf", F.ceil(F.col("rows") / (most * 2)).alias("tiles")).where("tiles > 1"))
    tiles = F.coalesce("tiles", F.lit(1))
    kept = index.join(full, ["length", "leaf"], "left").select(
        "length", "leaf", F.pmod(F.xxhash64("word"), tiles).alias("tile"), F.lit(True).alias("own"), "word", "n")
    asked = filed(words, trees, True).join(full, ["length", "leaf"], "left").select(
        "length", "leaf", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)).alias("tile"), F.lit(False).alias("own"), "word", "n")

    def search(group: pa.Table) -> pa.Table:
        own = group.column("own").to_numpy()
        text, count = np.array(group.column("word").to_pylist(), dtype=object), group.column("n").to_numpy()
        mine, n = text[own], count[own]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(mine):
            index = code_points(mine.tolist())
            others, m = text[~own], count[~own]
            lengths = np.array([len(w) for w in others])
            for length in np.unique(lengths):
                some, k = others[lengths == length], m[lengths == length]
                for a, b in near_rows(code_points(some.tolist()), index):
                    found.append((some[a], mine[b], n[b]))
                    if length < index.shape[1]:
                        found.append((mine[b], some[a], k[a]))
        word, near, near_n = (np.concatenate(x) for x in zip(*found)) if found else ([], [], [])
        return pa.table({"word": pa.array(word, pa.string()), "near": pa.array(near, pa.string()),
                         "near_n": pa.array(near_n, pa.int64())})

    return kept.unionByName(asked).groupBy("length", "leaf", "tile").applyInArrow(search, PAIRS)


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``(word, root)``: forms ``(word, form)`` followed to the last. A form is
    more frequent than its word, so there is no circle."""
    now = stored(spark, forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stored(spark, now.join(after, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(spark: SparkSession, docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      ratio: int = RATIO, deletes: int = DELETES, cell: int = CELL, levels: int = LEVELS,
                      sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` per word.

    n_near counts the words one inserted, deleted or replaced code point away,
    form is the most frequent of them (ties: the first in code-point order) if
    its n is ``ratio`` times the word's or more, else null like form_n; root is
    the end of the chain of forms, the word itself without one. Null and empty
    texts hold no words, a null id reads as empty, rows that repeat count as
    often as they occur. Without words there are no rows. Other columns are
    ignored, whatever their names."""
    words = stored(spark, word_counts(docs, min_length, min_count, deletes, id_col, text_col), "words")
    pairs = near_words(spark, words, cell, levels, sample)
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    much = -F.col("best.m") >= F.col("n") * ratio
    judged = stored(spark, words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(much, F.col("best.near")).alias("form"),
        F.when(much, -F.col("best.m")).alias("form_n")), "variants")
    ends = roots(spark, judged.where("form is not null"))
    return judged.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
