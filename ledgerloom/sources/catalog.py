"""Metadata lookups: columns by pattern, text columns, copyable tables.
These read the catalog or a schema only; no data is scanned."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.attributes import text_columns

__all__ = ["like_matches", "columns_like", "table_columns_like", "text_columns", "copyable_tables"]


def _like_regex(pattern: str, escape: str | None = None) -> re.Pattern:
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if escape is not None and ch == escape:
            if i + 1 == len(pattern):
                raise ValueError("a LIKE pattern cannot end with the escape character")
            out.append(re.escape(pattern[i + 1]))
            i += 2
            continue
        out.append(".*" if ch == "%" else "." if ch == "_" else re.escape(ch))
        i += 1
    return re.compile("".join(out), re.DOTALL)


def like_matches(name: str, pattern: str, escape: str | None = None) -> bool:
    """SQL LIKE: ``%`` any run, ``_`` any one character (so ``'%_fk'`` also
    matches ``'xfk'``); pass ``escape='\\\\'`` to match them literally."""
    return _like_regex(pattern, escape).fullmatch(name) is not None


def columns_like(df: DataFrame, pattern: str = "%", escape: str | None = None) -> list[str]:
    """Column names of a DataFrame matching a LIKE pattern, in column order."""
    return [c for c in df.columns if like_matches(c, pattern, escape)]


def table_columns_like(spark: SparkSession, table: str, pattern: str = "%",
                       escape: str | None = None) -> list[str]:
    """Column names of a catalog table matching a LIKE pattern."""
    return [c.name for c in spark.catalog.listColumns(table) if like_matches(c.name, pattern, escape)]


def copyable_tables(spark: SparkSession, database: str) -> list[str]:
    """Tables holding rows in a database: managed or external tables, no views
    and no temporary views (which every database listing includes)."""
    return sorted(
        t.name for t in spark.catalog.listTables(database)
        if not t.isTemporary and (t.tableType or "").upper() in ("MANAGED", "EXTERNAL")
    )
