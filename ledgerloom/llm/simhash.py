"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

Fingerprint: lower-case A-Z, split on ASCII white space, join every run of
``shingle`` words (all words when there are fewer) by one space, hash each with
XXH64 (seed 42); a bit is 1 if it is set in over half of the hashes.

Search for fingerprints at two or fewer differing bits: the 64 bits are cut
into three segments, each padded to a 23-bit word of the perfect binary Golay
code, whose 4096 spheres of radius three fill the space. A word decodes to one
codeword index; a word at distance three from its codeword has neighbours (one
bit away) in five other spheres, so "itself or one bit off" is one key or six.
With two errors over three segments there is always a segment without an error
whose successor (cyclically) has one at most. So a fingerprint is filed under
three keys (exact segment, index of the next) and looks under the keys of the
next segment's neighbours, up to eighteen. Matches are verified on all 64 bits.
Only distinct fingerprints are keyed: copies never meet as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.graph import components, stored
from ledgerloom.llm.workers import ready
from ledgerloom.operators.attributes import quote_name

SHINGLE, MAX_BITS, SEED = 3, 2, 42
# Generator polynomial of the binary Golay code (23, 12, 7);
# widths of the three segments of a 64-bit fingerprint.
GENERATOR = 0b110001110101
WIDTHS = (22, 21, 21)
HASHES_AT_ONCE = 8192


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint, unsigned; 0 for a text without words or null."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, n, HASHES_AT_ONCE):
        until = min(n, at + HASHES_AT_ONCE)
        part = words[at:until + shingle - 1]
        if shingle == 3 and len(words) >= 3:
            h = [hashed(b"%b %b %b" % x, SEED) for x in zip(part, part[1:], part[2:])]
        else:
            h = [hashed(b" ".join(part[i:i + shingle]), SEED) for i in range(until - at)]
        bits = np.unpackbits(np.array(h, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` per row; fp is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("fp", T.LongType())])
    return ready(docs).select(id_col, text_col).mapInArrow(run, schema)


def _with_fingerprint(docs: DataFrame, shingle: int) -> DataFrame:
    """The rows of ``docs`` with the fingerprint of their text as ``row_fp``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(at)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps.view(np.int64))], names=[*b.schema.names, "row_fp"])

    return ready(docs).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("row_fp", T.LongType())]))


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where((rest >> bit) & 1, GENERATOR << (bit - 11), 0)
    return rest


def error_table() -> np.ndarray:
    """For each of the 2048 syndromes the one error pattern of weight <= 3."""
    singles = 1 << np.arange(23)
    patterns = {0}
    for _ in range(3):
        patterns |= {p ^ int(s) for p in patterns for s in singles}
    e = np.array(sorted(patterns), dtype=np.int64)
    table = np.zeros(2048, dtype=np.int64)
    table[_syndromes(e)] = e
    return table


def codeword_index(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The 12 message bits of the codeword whose sphere holds each word."""
    return (words ^ table[_syndromes(words)]) >> 11


def keys_of(fps: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, filed): the keys of unsigned fingerprints. ``filed`` marks
    the three keys a fingerprint is filed under; every key is looked up."""
    ends = np.cumsum(WIDTHS)
    segments = [((fps >> np.uint64(e - w)) & np.uint64((1 << w) - 1)).astype(np.int64)
                for e, w in zip(ends, WIDTHS)]
    rows, keys, filed = [], [], []
    here = np.arange(len(fps))
    for i in range(3):
        j = (i + 1) % 3
        exact = (np.int64(i) << 40) | (segments[i] << 12)
        near = [segments[j]] + [segments[j] ^ (1 << bit) for bit in range(WIDTHS[j])]
        index = np.stack([codeword_index(s, table) for s in near], axis=1)
        own = index[:, 0].copy()
        index.sort(axis=1)
        fresh = np.ones(index.shape, dtype=bool)
        fresh[:, 1:] = index[:, 1:] != index[:, :-1]
        r, c = np.nonzero(fresh)
        rows.append(here[r])
        keys.append(exact[r] | index[r, c])
        filed.append(index[r, c] == own[r])
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(filed)


def _keyed(distinct: DataFrame) -> DataFrame:
    def run(batches):
        table = error_table()
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 4096):
                some = fps[at:at + 4096]
                r, k, f = keys_of(some.view(np.uint64), table)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some[r]), pa.array(k), pa.array(f)], names=["fp", "key", "filed"])

    return ready(distinct).select("fp").mapInArrow(run, "fp long, key long, filed boolean")


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(u, v)``: every pair u < v of the fingerprints in column ``fp`` that
    differ in at most ``max_bits`` (0 to 2) bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the keys are complete for up to two differing bits")
    keyed = _keyed(distinct)
    a = keyed.select(F.col("fp").alias("u"), "key")
    b = keyed.where("filed").select(F.col("fp").alias("v"), "key")
    return (a.join(b, "key")
            .where((F.col("u") < F.col("v"))
                   & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))
            .select("u", "v").distinct())


def simhash_groups(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE,
                   max_bits: int = MAX_BITS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id, root)`` per input row.

    component_id is the smallest non-null id among the documents whose
    fingerprints are linked, directly or through others; it is null where all
    of them are null. root is the component's smallest fingerprint. Null,
    empty and blank texts have fingerprint 0 and form a group with whatever is
    linked to it. Repeated rows come out once each. An empty table gives none.
    Other columns are ignored, whatever their names."""
    fps = stored(spark, fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    firsts = stored(spark, fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    comps = components(spark, links(firsts, max_bits))
    rooted = (firsts.join(comps, firsts["fp"] == comps["node"], "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id", "root")


def simhash_dedup(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE,
                  max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the document with the
    smallest doc_id (once, if its row is repeated; of rows that share this id
    the one with the group's smallest fingerprint, then text; a group whose ids
    are all null keeps one row). Columns are those of ``docs``, whatever their
    names; they travel as one struct beside the id and the text."""
    groups = simhash_groups(spark, docs, shingle, max_bits)
    kept = (groups.where("doc_id = component_id").groupBy("root").agg(F.min(F.struct("doc_id", "fp")).alias("k"))
            .select(F.col("k.doc_id").alias("id"), F.col("k.fp").alias("kept_fp")))
    ids = kept.select("id").distinct()
    shared = stored(spark, groups.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).count()
                    .where("count > 1").select("id"), "shared")
    rows = docs.select(F.struct(*[F.col(quote_name(c)) for c in docs.columns]).alias("row"), F.col("doc_id").alias("of"), "text")
    named = rows.join(ids, rows["of"] == ids["id"], "left_semi")
    if not shared.isEmpty():
        # rows that share an id may differ in text: the fingerprint tells which of them the group keeps
        several = _with_fingerprint(named.join(shared, named["of"] == shared["id"], "left_semi"), shingle)
        several = several.join(kept, (several["of"] == kept["id"]) & several["row_fp"].eqNullSafe(kept["kept_fp"]), "left_semi")
        several = several.groupBy("of", "row_fp").agg(F.min_by("row", F.struct("text", F.xxhash64("row"))).alias("row"))
        named = named.join(shared, named["of"] == shared["id"], "left_anti").select("row").unionByName(several.select("row"))
    lost = groups.where("component_id is null").select("fp", "root")
    if not lost.isEmpty():
        pick = lost.groupBy("root").agg(F.min("fp").alias("least")).select("least")
        nameless = rows.where("of is null").withColumn("key", F.xxhash64("text"))
        at = fingerprints(nameless.select("key", "text"), shingle, id_col="key")
        texts = at.join(pick, at["fp"] == pick["least"], "left_semi").groupBy("fp").agg(F.min("doc_id").alias("key"))
        named = named.select("row").unionByName(
            nameless.join(texts.select("key"), "key", "left_semi").dropDuplicates(["key"]).select("row"))
    return named.select("row.*")
