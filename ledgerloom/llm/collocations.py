"""Phrase collocations counted in counting quotient filters.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?``, line feeds and
carriage returns, and pieces into words at spaces and tabs; all counts are per
language (null: ``und``).

1. Vocabulary: occurrences of every word. A word's id is the 64-bit XXH64 of
   its bytes under a seed; that no two words of a language share an id is
   checked over the whole vocabulary, and another seed is taken if they do.
2. Phrases of two words, then of three and four, are packed as their ids and
   counted in quotient filters (``quotient_filter``): each task fills filters
   and ships them by shard, each shard's sorted filters are merged. A phrase
   needs all of its parts to be frequent, so words, then pairs, that are not
   frequent are left out before counting: the frequent ones set bits of a
   bitmap of fixed size (2 ** ``bits``) that every task gets. Other phrases may
   hit a set bit and are counted in vain; none is lost.
3. A candidate's lowest-scoring cut, the candidates that a longer one stands
   for, and the first ``top`` of each language are found by joins and
   aggregates over the frequent phrases alone.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import quotient_filter as qf
from ledgerloom.llm.graph import stored
from ledgerloom.llm.workers import ready

MIN_COUNT, LONGEST, TOP = 30, 4, 2000
BITS = 26
#: Occurrences of phrases of one language that a shard is meant for, and the least number of shards, as powers of two.
SHARD_BITS, LEAST_SHARD_BITS = 21, 6
#: Bytes of text split at a time, words a task counts or knows at a time.
CHUNK, KNOWN = 1 << 20, 1 << 18
# The characters that end a piece, and those between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
_TABLE = bytes.maketrans(PIECE_ENDS + SPACES, b"\n" * len(PIECE_ENDS) + b" " * len(SPACES))
#: Ids that stand for the end of a piece (or a word of no phrase) and for nothing at all.
END, NOTHING = 0, 1

FILTERS = "lang string, size int, shard long, m int, runs binary, remainders binary, lanes binary, counters binary"
PHRASES = "lang string, ws array<long>, f long"


def tokens(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The words of the texts, a line feed after each piece, empty strings
    between neighbouring spaces; some at a time."""
    def cut(text: bytes) -> Iterator[list[bytes]]:
        at = 0
        while at < len(text):
            end = text.find(b" ", at + CHUNK)
            end = len(text) if end < 0 else end
            yield text[at:end].replace(b"\n", b" \n ").split(b" ")
            at = end

    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= CHUNK:
            yield from cut((b"\n".join(held) + b"\n").lower().translate(_TABLE))
            held, size = [], 0
    if held:
        yield from cut((b"\n".join(held) + b"\n").lower().translate(_TABLE))


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """``lang`` and its texts of a batch ``(lang, text)``."""
    groups: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
        if text:
            groups.setdefault("und" if lang is None else lang, []).append(text)
    yield from groups.items()


def _source(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return ready(docs).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))


def vocabulary(spark: SparkSession, docs: DataFrame, seed: int, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(lang, word, id, n)`` of every word, as a written table."""
    def rows(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            words = list(c)
            ids = np.array([xxhash.xxh64_intdigest(w, seed) for w in words], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string()),
                 pa.array(ids.view(np.int64)), pa.array(list(c.values()), pa.int64())], names=["lang", "word", "id", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for b in batches:
            for lang, texts in _by_language(b):
                c = counts.setdefault(lang, Counter())
                for part in tokens(texts):
                    c.update(part)
                    del c[b""], c[b"\n"]
                    if len(c) >= KNOWN:
                        yield from rows({lang: c})
                        c.clear()
        yield from rows(counts)

    some = _source(docs, lang_col, text_col).mapInArrow(run, "lang string, word string, id long, n long")
    return stored(spark, some.groupBy("lang", "word", "id").agg(F.sum("n").alias("n")), "vocabulary")


def _distinct_ids(words: DataFrame) -> bool:
    shared = words.groupBy("lang", "id").agg(F.count("*").alias("k")).where((F.col("k") > 1) | F.col("id").isin(END, NOTHING))
    return shared.isEmpty()


def _places(lang: str, lanes: list[np.ndarray], bits: int) -> np.ndarray:
    """The bit of each n-gram in a bitmap of 2 ** bits."""
    salt = np.uint64(xxhash.xxh64_intdigest(lang))
    return (qf.permute([lanes[0] ^ salt, *lanes[1:]])[0] >> np.uint64(64 - bits)).astype(np.int64)


def bitmap(phrases: DataFrame, bits: int = BITS) -> np.ndarray:
    """Bytes of the bitmap in which the n-grams of ``(lang, ws)``, all of one
    size, set their bits. At most 2 ** bits bits come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ws = b.column(1)
            flat = ws.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(b.num_rows, -1)
            langs = np.array(b.column(0).to_pylist(), dtype=object)
            at = np.empty(b.num_rows, dtype=np.int64)
            for lang in set(langs.tolist()):
                mine = langs == lang
                at[mine] = _places(lang, list(flat[mine].T), bits)
            yield pa.RecordBatch.from_arrays([pa.array(at)], names=["at"])

    places = ready(phrases).select("lang", "ws").mapInArrow(run, "at long").select((F.col("at") + 1).alias("at"))
    parts = places.groupBy(F.bitmap_bucket_number("at").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(max(4096, 1 << (bits - 3)), dtype=np.uint8)
    for row in parts.toLocalIterator():
        out[(row["b"] - 1) * 4096:row["b"] * 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


class _Ids(dict):
    """Word to id; END for words that are not frequent. At most KNOWN are kept."""

    def __init__(self, lang: str, seed: int, frequent: np.ndarray, bits: int) -> None:
        super().__init__()
        self.rule, self.salt = (seed, frequent, bits), xxhash.xxh64_intdigest(lang)
        self.first()

    def first(self) -> None:
        self.clear()
        self.update({b"": NOTHING, b"\n": END})

    def __missing__(self, word: bytes) -> int:
        seed, frequent, bits = self.rule
        id = xxhash.xxh64_intdigest(word, seed)
        at = qf.scatter_one(id ^ self.salt) >> (64 - bits)
        id = id if frequent[at >> 3] >> (at & 7) & 1 else END
        self[word] = id
        return id


def _pairs(lang: str, a: np.ndarray, known: np.ndarray | None, bits: int) -> np.ndarray:
    """Which neighbours in ``a`` are a pair of words (of those in ``known``)."""
    both = (a[:-1] != END) & (a[1:] != END)
    if known is None:
        return both
    at = np.flatnonzero(both)
    place = _places(lang, [a[at], a[at + 1]], bits)
    both[at] = known[place >> 3] >> (place & 7).astype(np.uint8) & 1
    return both


def count_phrases(docs: DataFrame, sizes: tuple[int, ...], seed: int, lead: int, words, pairs=None,
                  bits: int = BITS, min_count: int = MIN_COUNT, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(lang, ws, f)``: phrases of ``sizes`` words with at least ``min_count``
    occurrences. ``words`` and ``pairs`` are broadcast bitmaps of the frequent
    words and pairs."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[str, _Ids] = {}
        counters: dict[tuple[str, int], qf.Counter] = {}
        known = None if pairs is None else pairs.value

        def out(key: tuple[str, int]) -> Iterator[pa.RecordBatch]:
            rows = [dict(zip(schema.names, (*key, *row))) for row in counters[key].take(lead)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

        for b in batches:
            for lang, texts in _by_language(b):
                table = ids.get(lang)
                if table is None:
                    table = ids[lang] = _Ids(lang, seed, words.value, bits)
                before = np.zeros(0, dtype=np.uint64)
                for part in tokens(texts):
                    a = np.fromiter(map(table.__getitem__, part), dtype=np.uint64, count=len(part))
                    if len(table) >= KNOWN:
                        table.first()
                    a = np.concatenate([before, a[a != NOTHING]])
                    run = _pairs(lang, a, known, bits)
                    for size in range(2, LONGEST + 1):
                        if size > 2:
                            run = run[:-1] & run[1:]
                        if size in sizes:
                            at = np.flatnonzero(run)
                            at = at[at + size > len(before)]
                            c = counters.setdefault((lang, size), qf.Counter(size))
                            if c.add([a[at + i] for i in range(size)]):
                                yield from out((lang, size))
                    before = a[-(max(sizes) - 1):]
        for key in counters:
            yield from out(key)

    schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("shard", pa.int64()), ("m", pa.int32()),
                        ("runs", pa.binary()), ("remainders", pa.binary()), ("lanes", pa.binary()), ("counters", pa.binary())])

    def joined(key: tuple, filters: pa.Table) -> pa.Table:
        lang, size, shard = (k.as_py() for k in key)
        parts = filters.select(["m", "runs", "remainders", "lanes", "counters"]).to_pylist()
        lanes, counts = qf.merge([qf.unpack(size, p["m"], shard, lead, p["runs"], p["remainders"], p["lanes"], p["counters"])
                                  for p in parts])
        often = counts >= min_count
        grams = qf.restore([x[often] for x in lanes])
        flat = np.stack(grams, axis=1).reshape(-1).view(np.int64)
        offsets = np.arange(0, len(flat) + 1, size, dtype=np.int32)
        return pa.table({"lang": pa.array([lang] * int(often.sum()), pa.string()),
                         "ws": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                         "f": pa.array(counts[often])})

    filters = _source(docs, lang_col, text_col).mapInArrow(fill, FILTERS)
    return filters.groupBy("lang", "size", "shard").applyInArrow(joined, PHRASES)


def phrase_counts(spark: SparkSession, docs: DataFrame, min_count: int = MIN_COUNT, bits: int = BITS, seed: int = 42,
                  lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``words (lang, word, id, n)``, all of them, and ``phrases (lang, ws, f)``
    of one to four words with at least ``min_count`` occurrences, ``ws`` their
    words' ids; both written tables."""
    while True:
        words = vocabulary(spark, docs, seed, lang_col, text_col)
        if _distinct_ids(words):
            break
        seed += 1
    total = words.groupBy("lang").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    lead = max(LEAST_SHARD_BITS, math.ceil(math.log2(max(1, total))) - SHARD_BITS)
    single = stored(spark, words.where(F.col("n") >= min_count).select("lang", F.array("id").alias("ws"), F.col("n").alias("f")),
                    "frequent-words")
    sc = spark.sparkContext
    known = sc.broadcast(bitmap(single, bits))
    rule = {"seed": seed, "lead": lead, "words": known, "bits": bits, "min_count": min_count, "lang_col": lang_col,
            "text_col": text_col}
    two = stored(spark, count_phrases(docs, (2,), **rule), "frequent-pairs")
    pairs = sc.broadcast(bitmap(two, bits))
    more = stored(spark, count_phrases(docs, (3, 4), pairs=pairs, **rule), "frequent-phrases")
    return words, single.unionByName(two).unionByName(more)


def _exact(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def collocations(spark: SparkSession, docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, bits: int = BITS,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``, numbers long: per language
    the first ``top`` phrases by score, a (both descending) and phrase.

    a, l and r are the occurrences of the phrase and of the two parts of its
    lowest-scoring cut (ties: the earliest), score is floor(2000000 a / (l + r)),
    n the language's words. A phrase inside a longer one that has 80 % of its
    occurrences or more is left out. A null language is ``und``; null and empty
    texts hold no words; rows that repeat count as often as they occur. A
    table without a frequent phrase gives no rows. Other columns are ignored."""
    words, phrases = phrase_counts(spark, docs, min_count, bits, lang_col=lang_col, text_col=text_col)
    size = F.size("ws")
    found = phrases.where(size > 1)
    # both parts of every cut, looked up in one join
    cuts = found.select("lang", "ws", "f", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    parts = cuts.select("lang", "ws", "f", "k", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.slice("ws", F.lit(1), F.col("k")).alias("part")),
        F.struct(F.lit(1).alias("side"), F.slice("ws", F.col("k") + 1, size - F.col("k")).alias("part")))).alias("p"))
    parts = parts.select("lang", "ws", "f", "k", "p.side", "p.part")
    looked = parts.join(phrases.select("lang", F.col("ws").alias("part"), F.col("f").alias("f_part")), ["lang", "part"])
    each = looked.groupBy("lang", "ws", "f", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("f_part"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f_part"))).alias("r"))
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(f as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = each.withColumn("score", score.cast("long")).groupBy("lang", "ws", F.col("f").alias("a")).agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # what a longer phrase stands for: the largest f of the longer ones around it
    places = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda s: F.transform(
        F.sequence(F.lit(1), size - s + 1), lambda at: F.slice("ws", at, s))))
    inside = (found.where(size > 2).select("lang", F.col("f").alias("longer"), F.explode(places).alias("ws"))
              .groupBy("lang", "ws").agg(F.max("longer").alias("longer")))
    kept = scored.join(inside, ["lang", "ws"], "left").where(
        F.col("longer").isNull() | (_exact(F.col("longer")) * 100 < _exact(F.col("a")) * 80))
    # words for ids; the phrase decides ties
    spelt = kept.select("lang", "ws", "a", "cut", F.posexplode("ws").alias("at", "id")).join(
        words.where(F.col("n") >= min_count).select("lang", "id", "word"), ["lang", "id"])
    named = spelt.groupBy("lang", "ws", "a", "cut").agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    order = [F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # a language's first are among the first of each of its parts
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    first = named.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    ranked = first.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
