"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: several rotations are learned on a bounded
sample (iterative quantisation, one per 64 bits or fewer, each from its own
random start) and the signs of the rotated vector are the code. A code is
cut into ``parts`` substrings of 16 bits. By the pigeonhole principle, codes
within Hamming radius r of a query agree with it, in some substring, up to
r // parts bits: the index of a block of vectors lists, per substring and
value, the rows that have it, and a query looks up all values that near. So
probing up to t bits retrieves every code within radius parts (t + 1) - 1, and
many beyond; all that the probes return are reranked by their exact cosine.

How far a query probes is its own: t grows until k rows are found, then to
where a vector as near as the k-th of these would be retrieved with probability
``recall``: its bits differ from the query's with probability arccos(cosine) /
pi each. That is the least of the k: nearer ones are likelier, and each block of
vectors sets it by its own k-th. The best k of all blocks are merged per query.

Queries and vectors meet in blocks of bounded size, each pair of blocks being
one row of work, so nothing grows with the table but the number of blocks.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ledgerloom.llm.graph import stored
from ledgerloom.llm.workers import ready

BITS, RECALL = 512, 0.6
FIT_ROWS, BLOCK, QUERY_BLOCK = 4096, 16384, 256
#: Bits of a substring; from so many differing ones on, a probe returns all rows.
WIDTH, ALL_FROM = 16, 6


def usable(vector: str = "embedding"):
    """Not null, not zero, every component a finite number."""
    v = F.col(vector)
    inf = float("inf")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == inf))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def learn_rotations(sample: np.ndarray, bits: int = BITS, rounds: int = 15, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(mean, matrix of dims x bits) by iterative quantisation of unit vectors."""
    dims = sample.shape[1]
    mean = sample.mean(axis=0)
    centred = sample - mean
    out = []
    for i in range(-(-bits // dims)):
        r = np.linalg.qr(np.random.default_rng(seed + i).normal(size=(dims, dims)))[0]
        for _ in range(rounds):
            signs = np.where(centred @ r >= 0, 1.0, -1.0)
            u, _, vt = np.linalg.svd(centred.T @ signs)
            r = u @ vt
        out.append(r)
    return mean, np.concatenate(out, axis=1)[:, :bits]


def codes_of(unit: np.ndarray, mean: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Packed codes, one row of bits / 16 substrings of 16 bits each."""
    bits = (unit - mean) @ matrix >= 0
    return np.packbits(bits, axis=1).view(np.uint16)


def flips(most: int) -> np.ndarray:
    """All 16-bit masks with up to ``most`` bits set."""
    return np.array([sum(1 << b for b in c) for n in range(most + 1) for c in itertools.combinations(range(16), n)],
                    dtype=np.uint16)


class BlockIndex:
    """The substring tables of one block of codes: per substring, where each of
    its 65,536 values begins in the list of rows sorted by value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.words = np.ascontiguousarray(codes).view(np.uint64)
        n, parts = codes.shape
        self.rows = np.argsort(codes, axis=0, kind="stable").T.astype(np.int32).ravel()
        self.begin = np.zeros((parts, (1 << WIDTH) + 1), dtype=np.int64)
        for i in range(parts):
            np.cumsum(np.bincount(codes[:, i], minlength=1 << WIDTH), out=self.begin[i, 1:])
        self.begin += (np.arange(parts) * n)[:, None]
        self.masks: dict[int, np.ndarray] = {}

    def probe(self, code: np.ndarray, near: int) -> np.ndarray:
        """Rows that agree with the query in some substring up to ``near`` bits."""
        n, parts = self.codes.shape
        if near >= ALL_FROM:
            return np.arange(n)
        if near not in self.masks:
            self.masks[near] = flips(near)
        values = (self.masks[near][None, :] ^ code[:, None]).astype(np.int64)
        part = np.arange(parts)[:, None]
        low, high = self.begin[part, values].ravel(), self.begin[part, values + 1].ravel()
        size = high - low
        full = size > 0
        low, size = low[full], size[full]
        at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        hit = np.zeros(n, dtype=bool)
        hit[self.rows[at]] = True
        return np.flatnonzero(hit)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within ``radius`` bits, all of them."""
        rows = self.probe(code, radius // self.codes.shape[1])
        return rows[self.distances(code, rows) <= radius]

    def distances(self, code: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.words[rows] ^ code.view(np.uint64)).sum(axis=1, dtype=np.int64)


def near_for(cosine: float, parts: int, recall: float) -> int:
    """Differing bits up to which a substring must be probed so that a vector
    of this cosine agrees in one of them with probability ``recall``."""
    p = np.arccos(np.clip(cosine, -1.0, 1.0)) / np.pi
    agree = 0.0
    for near in range(WIDTH):
        agree += math.comb(WIDTH, near) * p**near * (1 - p)**(WIDTH - near)
        if 1 - (1 - min(1.0, agree))**parts >= recall:
            return near
    return WIDTH


def search_block(index: BlockIndex, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray,
                 queries: np.ndarray, query_codes: np.ndarray, k: int, recall: float, rows: np.ndarray,
                 query_rows: np.ndarray):
    """(query, rows found, cosines, rows probed) for every query of a block."""
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    parts, start = index.codes.shape[1], 0
    for q in range(len(query_ids)):
        v, code = queries[q], query_codes[q]
        norm = np.sqrt(v @ v)
        own = rows == query_rows[q]

        def nearest(near: int):
            got = index.probe(code, near)
            got = got[~own[got]]
            cos = np.einsum("ij,j->i", vectors[got], v) / (norms[got] * norm)
            order = np.lexsort((ids[got], -cos))[:k]
            return got[order], cos[order], len(got)

        want = min(k, len(own) - int(own.sum()))
        if want == 0:
            continue
        # from where the query before began, or one bit less where that found far more than it needed
        near = start
        got, cos, probed = nearest(near)
        while len(got) < want:
            near += 1
            got, cos, probed = nearest(near)
        start = max(0, near - (probed > 50 * k))
        wide = near_for(float(cos[-1]), parts, recall)
        if wide > near:
            got, cos, probed = nearest(wide)
        yield q, got, cos, probed


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _blocked(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows ``(id, row, v)`` packed ``size`` to a row: ``(ids, rows, vs)``."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, size):
                part = b.slice(at, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c.to_pylist()], type=f.type) for c, f in zip(
                        [part.column(0), part.column(1)], [pa.field("a", pa.list_(pa.int64()))] * 2)]
                    + [pa.array([np.ascontiguousarray(_matrix(part.column(2))).tobytes()], pa.binary())],
                    names=["ids", "rows", "vs"])

    return ready(rows).mapInArrow(run, "ids array<long>, rows array<long>, vs binary")


def nearest_neighbours(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 5, bits: int = BITS,
                       recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding",
                       fit_rows: int = FIT_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows of
    ``vectors`` found for each row of ``queries``, by cosine in double
    precision, ties to the smaller id; all others if there are fewer. Rows of
    equal id and vector are the same row: asked once, found once, and not its
    own neighbour.

    Vectors that are null, zero or hold a null or non-finite component take no
    part on either side, nor do null ids. Only vectors of the table's most
    frequent length take part (of several lengths as frequent, the largest).
    Empty tables give no rows; other columns are ignored."""
    def clean(df):
        return (df.where(F.col(id_col).isNotNull() & usable(vector_col))
                .select(F.col(id_col).cast("long").alias("id"), F.xxhash64(id_col, vector_col).alias("row"),
                        F.col(vector_col).cast("array<double>").alias("v")))

    data = clean(vectors)
    length = data.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    data = data.where(F.size("v") == (length["dims"] if length else 0))
    sample = data.select("v").orderBy(F.xxhash64("id")).limit(fit_rows).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return spark.createDataFrame([], schema)
    x = np.array([r["v"] for r in sample])
    mean, matrix = learn_rotations(x / np.linalg.norm(x, axis=1, keepdims=True), bits)
    dims = x.shape[1]
    blocks = stored(spark, _blocked(data, BLOCK, "blocks").withColumn("b", F.monotonically_increasing_id()), "blocks")
    asked = stored(spark, _blocked(clean(queries).where(F.size("v") == dims).dropDuplicates(["id", "row"])
                                   .repartition(1 + queries.count() // QUERY_BLOCK, "id"),
                                   QUERY_BLOCK, "queries").withColumn("q", F.monotonically_increasing_id())
                   .selectExpr("ids as q_ids", "rows as q_rows", "vs as q_vs", "q"), "queries")
    # every block of queries meets every block of vectors: their numbers pair up first, then fetch the blocks
    numbers = blocks.select("b").withColumn("one", F.lit(1)).join(asked.select("q").withColumn("one", F.lit(1)), "one")
    work = numbers.drop("one").repartition("b", "q").join(blocks, "b").join(asked, "q").repartition("b", "q")

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids, rows = np.array(r["ids"], dtype=np.int64), np.array(r["rows"], dtype=np.int64)
                vs = np.frombuffer(r["vs"]).reshape(-1, dims)
                once = np.sort(np.unique(np.stack([ids, rows]), axis=1, return_index=True)[1])
                ids, rows, vs = ids[once], rows[once], vs[once]
                qids, qrows = np.array(r["q_ids"], dtype=np.int64), np.array(r["q_rows"], dtype=np.int64)
                qs = np.frombuffer(r["q_vs"]).reshape(-1, dims)
                unit = [a / np.sqrt(np.einsum("ij,ij->i", a, a))[:, None] for a in (vs, qs)]
                index = BlockIndex(codes_of(unit[0], mean, matrix))
                hits = search_block(index, ids, vs, qids, qs, codes_of(unit[1], mean, matrix), k, recall, rows, qrows)
                found = [(np.full(len(got), qids[q]), np.full(len(got), qrows[q]), ids[got], rows[got], cos)
                         for q, got, cos, _ in hits]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)],
                                                     names=["query_id", "query_row", "vec_id", "vec_row", "score"])

    found = work.select("ids", "rows", "vs", "q_ids", "q_rows", "q_vs").mapInArrow(
        run, "query_id long, query_row long, vec_id long, vec_row long, score double")
    # a row that lies in several blocks is found in each
    found = found.repartition("query_id", "query_row").dropDuplicates(["query_id", "query_row", "vec_id", "vec_row"])
    order = W.Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
