"""Working chunk by chunk.

A chunk id is a pure function of a key (see ``functions.chunking``), so rows
with the same key share a chunk across tables. Selecting one chunk is a filter;
laying out a table by chunk (``partitionBy('chunk')``) turns that filter into
partition pruning. Processing all chunks at once needs nothing special: the
chunk id is just another grouping or partitioning key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.chunking import DEFAULT_CHUNKS, chunk_of


def all_chunks(spark: SparkSession, n: int = DEFAULT_CHUNKS) -> DataFrame:
    """Chunk ids 0..n-1 as ``(chunk int)``."""
    return spark.range(n).select(F.col("id").cast("int").alias("chunk"))


def with_chunk(df: DataFrame, key: str, n: int = DEFAULT_CHUNKS, out: str = "chunk") -> DataFrame:
    """``df`` with the chunk id as column ``out``, which must be a new name."""
    if out in df.columns:
        raise ValueError(f"the table has a column {out} already; choose another name")
    return df.withColumn(out, chunk_of(df, key, n))


def select_chunk(df: DataFrame, key: str, chunk: int, n: int = DEFAULT_CHUNKS,
                 layout_column: str | None = None) -> DataFrame:
    """Rows of one chunk, computed from ``key``. For a table laid out by
    :func:`write_by_chunk` (with the same key and ``n``), pass
    ``layout_column="chunk"`` to filter the stored column instead, so the scan
    prunes partitions."""
    if layout_column is not None:
        return df.where(F.col(layout_column) == F.lit(chunk))
    return df.where(chunk_of(df, key, n) == F.lit(chunk))


def chunk_sizes(df: DataFrame, key: str, n: int = DEFAULT_CHUNKS) -> DataFrame:
    """Every chunk id with its row count (0 for empty chunks)."""
    counts = df.groupBy(chunk_of(df, key, n).alias("chunk")).agg(F.count(F.lit(1)).alias("row_count"))
    ids = all_chunks(df.sparkSession, n)
    # Both sides have at most n rows.
    return ids.join(F.broadcast(counts), "chunk", "left").select(
        "chunk", F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"))


def write_by_chunk(df: DataFrame, key: str, path: str, n: int = DEFAULT_CHUNKS, mode: str = "overwrite",
                   out: str = "chunk") -> None:
    """Lay out a table by chunk so that one chunk is one folder.

    Rows are rebalanced by chunk: small chunks are gathered and large ones
    split by measured size, so files do not multiply by tasks x chunks and the
    input is read once. ``out`` names the folder column; a column of that name
    in ``df`` is an error."""
    chunked = with_chunk(df, key, n, out).withColumn(out, F.col(out).cast("int"))
    chunked.hint("rebalance", F.col(out)) \
        .write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(out).parquet(path)
