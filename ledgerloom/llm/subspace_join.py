"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine c or more differ by a squared distance of at most
2 - 2c. They are rotated onto the principal axes, and the axes are dealt into
blocks, each with a share of that budget in proportion to its variance: a
pair within the whole budget is within its share in one block at least. Every
block is range-joined on a grid over its two widest axes (cells as wide as the
block's radius, so partners lie in the same or a neighbouring cell), filtered
by the distance inside the block, and verified by the exact cosine.

Coordinates are whole numbers (scaled components times a scaled rotation), so
block distances are exact in any order of summation. A pair counts in the
first block whose share holds it, and so once. Equal vectors are one class
with a size. Classes travel in tiles of bounded size; a tile pair gives counts
and a spanning forest of its links, never the pairs themselves, so a crowded
cell is many small units of work and its output follows its vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.graph import components, stored
from ledgerloom.llm.multi_index import usable
from ledgerloom.llm.workers import ready

MIN_COSINE, BLOCKS, TILE = 0.93, 4, 512
SCALE = 1 << 20
#: Own cell and the half of the neighbours that come later.
NEIGHBOURS = ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))


def principal_axes(spark: SparkSession, vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(variances, axes as columns), widest first, of the unit vectors in ``v``.
    Tasks sum outer products; only these sums reach the driver."""
    def run(batches):
        total, n = np.zeros((dims + 1, dims + 1)), 0
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)
            x = np.concatenate([x / np.linalg.norm(x, axis=1, keepdims=True), np.ones((len(x), 1))], axis=1)
            total += x.T @ x
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([total.tobytes()])], names=["g", "s"])

    def add(batches):
        total = np.zeros((dims + 1, dims + 1))
        for b in batches:
            for s in b.column(1):
                total += np.frombuffer(s.as_py()).reshape(dims + 1, dims + 1)
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([total.tobytes()])], names=["g", "s"])

    sums = ready(vectors).select("v").mapInArrow(run, "g long, s binary")
    got = sums.repartition(8).mapInArrow(add, "g long, s binary").collect()
    m = sum(np.frombuffer(r["s"]).reshape(dims + 1, dims + 1) for r in got)
    n, mean = m[-1, -1], m[-1, :-1] / m[-1, -1]
    variance, axes = np.linalg.eigh(m[:-1, :-1] / n - np.outer(mean, mean))
    return np.maximum(variance[::-1], 0), axes[:, ::-1]


class Subspaces:
    """Rotation, blocks of axes and their radii, in whole numbers."""

    def __init__(self, variance: np.ndarray, axes: np.ndarray, min_cosine: float, blocks: int):
        dims = len(variance)
        blocks = max(1, min(blocks, dims))
        self.rotation = np.rint(axes * SCALE)
        self.axes = [np.arange(b, dims, blocks) for b in range(blocks)]
        widths = np.array([variance[a].sum() for a in self.axes]) + 1e-9
        # rounding moves a coordinate by dims + 1 units at most, a difference by twice that
        slack = 2 * (dims + 1) * np.sqrt([len(a) for a in self.axes])
        budget = max(0.0, 2 - 2 * min_cosine) + 1e-9
        self.radius = np.ceil(np.sqrt(budget * widths / widths.sum()) * SCALE + slack)
        self.min_cosine = min_cosine

    def coordinates(self, vectors: np.ndarray) -> np.ndarray:
        unit = np.rint(vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None] * SCALE)
        return np.floor((unit @ self.rotation) / SCALE)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """Grid cell of every vector in every block: shape (n, blocks, 2)."""
        c = self.coordinates(vectors)
        out = np.zeros((len(c), len(self.axes), 2), dtype=np.int64)
        for b, a in enumerate(self.axes):
            for i, axis in enumerate(a[:2]):
                out[:, b, i] = c[:, axis] // self.radius[b]
        return out

    def links(self, block: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs first found in ``block`` whose cosine is high enough."""
        cl, cr = self.coordinates(left), self.coordinates(right)

        def apart(b, x, y):
            d = x[:, self.axes[b]], y[:, self.axes[b]]
            return d

        x, y = apart(block, cl, cr)
        square = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
        i, j = np.nonzero(square <= self.radius[block] ** 2)
        for b in range(block):
            if not len(i):
                break
            x, y = apart(b, cl[i], cr[j])
            fresh = ((x - y) ** 2).sum(axis=1) > self.radius[b] ** 2
            i, j = i[fresh], j[fresh]
        u, v = left[i], right[j]
        cosine = np.einsum("ij,ij->i", u, v) / (np.sqrt(np.einsum("ij,ij->i", u, u)) * np.sqrt(np.einsum("ij,ij->i", v, v)))
        high = cosine >= self.min_cosine
        return i[high], j[high]


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root): the links u - v as stars, root the smallest of its set."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _floats(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float)


def linked_classes(spark: SparkSession, classes: DataFrame, min_cosine: float, blocks: int, tile: int) -> DataFrame:
    """Links among ``classes(cid, label, v, size)``: rows ``(u, v, n)`` where
    ``n`` null marks an edge of a spanning forest of the links, and otherwise
    ``u`` has ``n`` more vectors linked to it."""
    dims = len(classes.select("v").first()["v"])
    space = Subspaces(*principal_axes(spark, classes, dims), min_cosine, blocks)

    def place(batches):
        for b in batches:
            cells = space.cells(_floats(b.column(2)).reshape(-1, dims))
            for k in range(cells.shape[1]):
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(np.full(b.num_rows, k)), pa.array(cells[:, k, 0]), pa.array(cells[:, k, 1])],
                    names=["cid", "label", "v", "size", "block", "x", "y"])

    cell = ["label", "block", "x", "y"]
    placed = classes.select("cid", "label", "v", "size").mapInArrow(
        place, "cid long, label string, v array<float>, size long, block long, x long, y long")
    crowd = placed.groupBy(*cell).agg(F.count("*").alias("_n"))
    split = placed.join(crowd, cell).withColumn(
        "part", F.pmod(F.xxhash64("cid"), F.ceil(F.col("_n") / tile)).cast("int"))
    tiles = stored(spark, split.groupBy(*cell, "part").agg(
        F.collect_list(F.struct("cid", "size", "v")).alias("rows")), "tiles")
    near = F.explode(F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy")) for x, y in NEIGHBOURS])).alias("_d")
    a = tiles.select("*", near).select("label", "block", (F.col("x") + F.col("_d.dx")).alias("x"),
                                       (F.col("y") + F.col("_d.dy")).alias("y"), F.col("part").alias("a_part"),
                                       ((F.col("_d.dx") == 0) & (F.col("_d.dy") == 0)).alias("same"),
                                       F.col("rows").alias("a_rows"))
    b = tiles.withColumnsRenamed({"part": "b_part", "rows": "b_rows"})
    pairs = a.join(b, cell).where("not same or a_part <= b_part").select(
        "block", (F.col("same") & (F.col("a_part") == F.col("b_part"))).alias("own"), "a_rows", "b_rows")

    def unpack(column):
        rows = column.flatten()
        ends = np.concatenate([[0], np.cumsum(np.diff(column.offsets.to_numpy()))])
        return (ends, rows.field(0).to_numpy(), rows.field(1).to_numpy(), _floats(rows.field(2)).reshape(-1, dims))

    def verify(batches):
        for batch in batches:
            ea, ia, sa, va = unpack(batch.column(2))
            eb, ib, sb, vb = unpack(batch.column(3))
            for r in range(batch.num_rows):
                block, own = batch.column(0)[r].as_py(), batch.column(1)[r].as_py()
                x, y = slice(ea[r], ea[r + 1]), slice(eb[r], eb[r + 1])
                i, j = space.links(block, va[x], vb[y])
                if own:
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                more = np.bincount(i, weights=sb[y][j], minlength=0).astype(np.int64)
                back = np.bincount(j, weights=sa[x][i], minlength=0).astype(np.int64)
                p, q = np.flatnonzero(more), np.flatnonzero(back)
                node, root = forest(ia[x][i], ib[y][j])
                u = np.concatenate([ia[x][p], ib[y][q], node])
                n = [*more[p].tolist(), *back[q].tolist(), *[None] * len(node)]
                v = np.concatenate([ia[x][p], ib[y][q], root])
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(n, pa.int64())], names=["u", "v", "n"])

    return pairs.mapInArrow(verify, "u long, v long, n long")


def near_duplicate_vectors(spark: SparkSession, vectors: DataFrame, min_cosine: float = MIN_COSINE,
                           blocks: int = BLOCKS, tile: int = TILE, id_col: str = "vec_id",
                           vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``vectors``.

    Rows are compared when their labels are equal and not null; vectors that
    are null, zero or hold a null or non-finite component link with nothing,
    and neither do vectors of another length than the first. ``n_links``
    counts the other rows at ``min_cosine`` or more (a repeated row is another
    row), component_id is the smallest id reachable by links, ``kept`` tells
    whether that is the row's own (null ids: component_id is the smallest
    non-null id reachable, null if there is none, and kept is null-safe).
    An empty table gives no rows; other columns are ignored."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<float>").alias("v"),
                          (F.col(label_col).isNotNull() & usable(vector_col)).alias("ok"))
    good = rows.where("ok")
    first = good.select(F.size("v").alias("d")).first()
    alone = F.struct(F.col("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                     F.lit(True).alias("kept"))
    if first is None:
        return rows.select(alone.alias("r")).select("r.*")
    fits = F.coalesce(F.col("ok") & (F.size("v") == first["d"]), F.lit(False))
    grouped = rows.where(fits).groupBy("label", "v").agg(F.count("*").alias("size"), F.min("vec_id").alias("least"))
    classes = stored(spark, grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    found = stored(spark, linked_classes(spark, classes, min_cosine, blocks, tile), "links")
    counts = found.where("n is not null").groupBy(F.col("u").alias("cid")).agg(F.sum("n").alias("n"))
    comps = components(spark, found.where("n is null").select("u", "v")).withColumnRenamed("node", "cid")
    rooted = (classes.select("cid", "label", "v", "size", "least").join(counts, "cid", "left").join(comps, "cid", "left")
              .withColumn("root", F.coalesce("root", "cid"))
              .withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("size") - 1))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("label", "v", "n_links", "component_id")
    linked = rows.where(fits).join(named, ["label", "v"]).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return linked.unionByName(rows.where(~fits).select(alone.alias("r")).select("r.*"))
