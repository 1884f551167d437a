"""Wide rate files: one row per date, one column per currency.

The file has a header row, a ``Date`` column and one column per three-letter
currency code; missing quotes are written ``N/A``. A trailing comma at the
end of each line adds an unnamed column, which Spark calls ``_c<i>`` — a
three-character name that must not be taken for a currency.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The layout of the wide rate file.
DATE_COLUMN = "Date"
MISSING = "N/A"
CODE_LENGTH = 3

LONG_SCHEMA = T.StructType([
    T.StructField("currency", T.StringType(), False),
    T.StructField("exchange_rate", T.DoubleType(), False),
    T.StructField("date", T.DateType(), False),
])

_GENERATED = re.compile(r"_c\d+")


def read_rate_file(spark: SparkSession, path: str, missing: str = MISSING) -> DataFrame:
    """The wide file as strings (no schema inference: one pass over the data)."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )


def rate_columns(wide: DataFrame, date_column: str = DATE_COLUMN) -> list[str]:
    """Header names of exactly three characters, other than generated names."""
    return [c for c in wide.columns
            if len(c) == CODE_LENGTH and c != date_column and not _GENERATED.fullmatch(c)]


def melt_rates(wide: DataFrame, date_column: str = DATE_COLUMN, date_format: str = "yyyy-MM-dd",
               missing: str = MISSING) -> DataFrame:
    """Wide -> long ``(currency, exchange_rate double, date date)``; missing
    cells (``missing``, N/A by default) are dropped. Every other cell must be a
    number and every date a date: a blank one fails the load, as the table's
    columns are NOT NULL (:func:`blank_cells` lists them beforehand)."""
    codes = rate_columns(wide, date_column)
    if not codes:
        return wide.sparkSession.createDataFrame([], LONG_SCHEMA)
    long = (
        wide.select(F.col(f"`{date_column}`").alias("_d"), *[F.col(f"`{c}`").cast("string").alias(c) for c in codes])
        .unpivot(["_d"], codes, "currency", "_rate")
        .where(F.trim(F.coalesce(F.col("_rate"), F.lit(""))) != F.lit(missing))
    )
    return long.select(
        "currency",
        _required(F.trim(F.col("_rate")), "exchange rate").cast("double").alias("exchange_rate"),
        F.to_date(_required(F.trim(F.col("_d").cast("string")), "date"), date_format).alias("date"),
    )


def _required(cell, what: str):
    return F.when(F.coalesce(cell, F.lit("")) == "", F.raise_error(F.lit(f"a blank {what} in the rate file"))).otherwise(cell)


def blank_cells(wide: DataFrame, date_column: str = DATE_COLUMN) -> DataFrame:
    """``(date, currency)`` of blank cells, currency null for a blank date."""
    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    cells = [F.when(blank(f"`{c}`"), F.lit(c)) for c in rate_columns(wide, date_column)]
    found = F.array_compact(F.array(*cells)) if cells else F.array().cast("array<string>")
    d = F.col(f"`{date_column}`").cast("string")
    return wide.select(d.alias("date"), F.explode(found).alias("currency")).unionByName(
        wide.where(blank(f"`{date_column}`")).select(d.alias("date"), F.lit(None).cast("string").alias("currency")))


def load_rates(spark: SparkSession, path: str) -> DataFrame:
    """Read a wide rate file and return the long rate table."""
    return melt_rates(read_rate_file(spark, path))


def build_rate_table(spark: SparkSession, path: str, end=None, base: str = "EUR") -> DataFrame:
    """The complete daily rate table from a wide rate file: load, carry the
    last quote forward through ``end`` (default: the last quoted day), add
    ``base`` at rate 1 on every date (found from the quotes, not the dense rows)."""
    from ledgerloom.operators.series import base_rows, gap_fill
    quotes = load_rates(spark, path)
    return gap_fill(quotes, end=end).unionByName(base_rows(quotes, base=base, end=end))


def write_rate_table(rates: DataFrame, path: str) -> None:
    """Store the rate table laid out for (currency, date) lookups."""
    from ledgerloom.sources.layout import write_search_layout
    write_search_layout(rates, path, column_names=["currency", "date"], replace=True)
