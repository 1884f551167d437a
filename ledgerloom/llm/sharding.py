"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``points`` places on a ring of hash values; a row belongs to
the next place clockwise of its own hash. A shard takes rows up to its load
bound, and rows over it go on clockwise to the next shard with room. The
bounds add up to the number of rows, so counts differ by one at most (the law
``rows``), and only overflow moves away from its ring place.

Who overflows where depends on the number of rows per arc of the ring alone.
Those counts (one per place, whatever the table's size) are walked on the
driver; the rows are then placed by their rank inside the arc. The rest is
DataFrame operations. Equal rows are counted before any shuffle and written
out again at the end, so no repeated row makes an arc heavy.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

POINTS = 64
LAW = "rows"
_HALF = 1 << 63


def ring(spark: SparkSession, shards: int, points: int = POINTS) -> list[tuple[int, int]]:
    """(place, shard) in clockwise order, places being signed longs."""
    at = spark.range(shards * points).select(
        F.xxhash64(F.lit("place"), F.floor(F.col("id") / points), F.col("id") % points).alias("place"),
        F.floor(F.col("id") / points).cast("int").alias("shard"))
    found: dict[int, int] = {}
    for place, shard in sorted(tuple(r) for r in at.collect()):
        found.setdefault(place, shard)
    return sorted(found.items())


def walk(owners: list[int], loads: list[int], bounds: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, rows, shard, first slot): where each arc's rows go.

    ``owners``: the shard of each arc in clockwise order; ``loads``: rows per
    arc; ``bounds``: most rows per shard, adding up to all rows or more."""
    room, used = list(bounds), [0] * len(bounds)
    out = []
    waiting = [[(arc, 0, n)] if n else [] for arc, n in enumerate(loads)]
    while any(waiting):
        onward: list[list] = [[] for _ in loads]
        for arc, queue in enumerate(waiting):
            shard = owners[arc]
            for origin, start, n in queue:
                fits = min(n, room[shard])
                if fits:
                    out.append((origin, start, fits, shard, used[shard]))
                    room[shard] -= fits
                    used[shard] += fits
                if n > fits:
                    onward[(arc + 1) % len(loads)].append((origin, start + fits, n - fits))
        waiting = onward
    return out


def _arc_of(key: Column, places: list[int]) -> Column:
    """Number of the first place clockwise of ``key``: the places under each
    key prefix come from an array, the few inside the prefix are compared."""
    bits = 12
    cells = 1 << bits
    low = [bisect.bisect_left(places, -_HALF + (c << (64 - bits))) for c in range(cells)]
    most = max(b - a for a, b in zip(low, [*low[1:], len(places)]))
    start = F.get(_longs(low), (F.shiftright(key, 64 - bits) + (cells >> 1)).cast("int"))
    after = start
    for i in range(most):
        after = after + F.when(F.get(_longs(places), (start + i).cast("int")) < key, 1).otherwise(0)
    return F.pmod(after, F.lit(len(places))).cast("int")


def _longs(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def shard_rows(spark: SparkSession, rows: DataFrame, shards: int, points: int = POINTS) -> DataFrame:
    """Distinct ``rows`` with their count in column ``n``, each expanded to one
    row per copy, with ``shard`` (0 to shards - 1) and ``slot`` (0 upwards
    without gaps in each shard)."""
    cols = [c for c in rows.columns if c != "n"]
    places, owners = zip(*ring(spark, shards, points))
    keyed = rows.withColumn("_key", F.xxhash64(F.lit("row"), *cols)).withColumn("_arc", _arc_of(F.col("_key"), list(places)))
    loads = {r["_arc"]: r["n"] for r in keyed.groupBy("_arc").agg(F.sum("n").alias("n")).collect()}
    total = sum(loads.values())
    bounds = [total // shards + (s < total % shards) for s in range(shards)]
    moves = walk(list(owners), [loads.get(a, 0) for a in range(len(places))], bounds)
    before = W.Window.partitionBy("_arc").orderBy("_key", *cols).rowsBetween(W.Window.unboundedPreceding, -1)
    ranked = keyed.withColumn("_rank", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # at most a few entries per arc: the table's size depends on shards and points only
    table = spark.createDataFrame(moves, "m_arc int, m_from long, m_n long, m_shard int, m_slot long")
    met = ranked.join(F.broadcast(table), (F.col("_arc") == F.col("m_arc"))
                      & (F.col("_rank") < F.col("m_from") + F.col("m_n"))
                      & (F.col("_rank") + F.col("n") > F.col("m_from")))
    first = F.greatest("_rank", "m_from")
    last = F.least(F.col("_rank") + F.col("n"), F.col("m_from") + F.col("m_n")) - 1
    return (met.withColumn("_at", F.explode(F.sequence(first, last)))
            .select(*cols, F.col("m_shard").alias("shard"),
                    (F.col("m_slot") + F.col("_at") - F.col("m_from")).alias("slot")))


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 24, points: int = POINTS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` per row.

    size is the text's UTF-8 bytes plus 8, text_crc32 the CRC-32 of those
    bytes; a null text counts as empty. Null ids are placed like any other.
    Rows equal in id, size and checksum are interchangeable. The law is
    ``rows``: counts per shard are at most one apart. An empty table gives no
    rows; rows do not depend on order or partitions of the input."""
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(raw) + 8).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    placed = shard_rows(spark, counted, shards, points)
    return placed.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
