"""Column expressions. Each returns a ``Column`` built from Spark built-ins,
so it runs inside whole-stage codegen; none of them is a Python UDF."""

from ledgerloom.functions.chunking import chunk_of, chunk_of_bigint, chunk_of_text
from ledgerloom.functions.calendar import day_columns, duration_columns
from ledgerloom.functions.text import row_text, trigrams, like_escape

__all__ = [
    "chunk_of", "chunk_of_bigint", "chunk_of_text",
    "day_columns", "duration_columns",
    "row_text", "trigrams", "like_escape",
]
