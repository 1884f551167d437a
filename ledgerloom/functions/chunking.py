"""Chunk ids: a stable small integer 0..n-1 derived from a key.

Big computations are split by chunk so that each piece can be handled (or
re-run) on its own. The id depends on the key only, so the same key lands in
the same chunk in every table and every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default number of chunks, and how many leading hex digits
# of a text key's md5 make its (signed 32-bit) hash.
DEFAULT_CHUNKS = 7
MD5_PREFIX_HEX_DIGITS = 8


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _check_n(n: int) -> None:
    if not 1 <= n <= 32767:
        raise ValueError("the number of chunks must be between 1 and 32767 (chunk ids are SMALLINT)")


def chunk_of_bigint(x: Column | str, n: int = DEFAULT_CHUNKS) -> Column:
    """|x| mod n as smallint; NULL keys go to chunk 0."""
    _check_n(n)
    return F.coalesce(F.abs(_col(x).cast("bigint")) % F.lit(n), F.lit(0)).cast("smallint")


def chunk_of_text(x: Column | str, n: int = DEFAULT_CHUNKS) -> Column:
    """Chunk of a text key: the first 32 bits of its md5, read as a signed int.

    The signed reading matters: '8f...' is negative before ``abs``. The one
    value whose ``abs`` overflows a 32-bit int (0x80000000) is kept in bigint
    and maps to 2147483648 mod n instead of failing.
    """
    unsigned = F.conv(F.substring(F.md5(_col(x).cast("string")), 1, MD5_PREFIX_HEX_DIGITS), 16, 10).cast("bigint")
    signed = F.when(unsigned >= F.lit(2**31), unsigned - F.lit(2**32)).otherwise(unsigned)
    return chunk_of_bigint(signed, n)


def chunk_of(df: DataFrame, column: str, n: int = DEFAULT_CHUNKS) -> Column:
    """Pick the text or integer variant from the column's type."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return chunk_of_text(df[column], n)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return chunk_of_bigint(df[column], n)
    raise TypeError(f"no chunk function for column {column!r} of type {dtype.simpleString()}")
