"""Time dimensions: day, duration and hour-of-day tables.

Each dimension is generated from a one-row bounds DataFrame ``(start, end)``
(or ``(start, as_of)``), so the bounds can come from literals or from an
aggregate over a fact table without a driver round trip. The tables are small
by nature — one row per calendar day or per day of duration — so generating
them from a single row is cheap at any data volume; the fact tables only
contribute a min/max aggregate.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import (
    DAY_COLUMNS, DURATION_COLUMNS, before_columns, day_columns, duration_columns, hour_name,
)

def bounds(spark: SparkSession, start: _dt.date, end: _dt.date,
           names: tuple[str, str] = ("start", "end")) -> DataFrame:
    """A one-row DataFrame of two literal dates."""
    return spark.range(1).select(F.lit(start).cast("date").alias(names[0]),
                                 F.lit(end).cast("date").alias(names[1]))


def bounds_of(df: DataFrame, column: str, names: tuple[str, str] = ("start", "end")) -> DataFrame:
    """min/max of a date or timestamp column as a one-row DataFrame."""
    c = F.col(column).cast("date")
    return df.agg(F.min(c).alias(names[0]), F.max(c).alias(names[1]))


def calendar_days(bounds_df: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row ``_date`` per day from ``start - 1 day`` through ``end``."""
    first = F.date_sub(F.col(start), 1)
    return (
        bounds_df.where(F.col(end) >= first)
        .select(F.explode(F.sequence(first, F.col(end))).alias("_date"))
    )


def day_dimension(bounds_df: DataFrame, pad_day_names: bool = True,
                  start: str = "start", end: str = "end") -> DataFrame:
    """The 16-column day table for ``start - 1 day .. end``."""
    return calendar_days(bounds_df, start, end).select(*day_columns(F.col("_date"), pad_day_names))


def add_absent_days(existing: DataFrame | None, bounds_df: DataFrame,
                    pad_day_names: bool = True) -> DataFrame:
    """Rows for the days in range that ``existing`` lacks (anti join on _date)."""
    days = calendar_days(bounds_df)
    if existing is not None:
        days = days.join(existing.select("_date"), "_date", "left_anti")
    return days.select(*day_columns(F.col("_date"), pad_day_names))


def populate_days(existing: DataFrame | None, bounds_df: DataFrame,
                  pad_day_names: bool = True) -> DataFrame:
    """The day table after an incremental run: existing rows plus absent days."""
    new = add_absent_days(existing, bounds_df, pad_day_names)
    return new if existing is None else existing.select(*DAY_COLUMNS).unionByName(new)


def duration_dimension(bounds_df: DataFrame, start: str = "start", as_of: str = "as_of",
                       fix_labels: bool = False) -> DataFrame:
    """The 15-column duration table.

    Negative half: n from (start - as_of) to 0, id n - 1.  Non-negative half:
    n from 0 to (as_of - start + 2).  Plus the sentinel row -30000 'before'.
    The duration half depends on ``start`` and ``as_of`` (today in the
    original toolkit), not on the end of the day table.
    """
    s, a = F.col(start), F.col(as_of)
    lo = F.datediff(s, a)
    hi = F.datediff(a, s) + 2
    neg = (
        bounds_df.where(lo <= 0)
        .select(F.explode(F.sequence(lo, F.lit(0))).alias("n"))
        .select(*duration_columns(F.col("n"), negative=True, fix_labels=fix_labels))
    )
    pos = (
        bounds_df.where(hi >= 0)
        .select(F.explode(F.sequence(F.lit(0), hi)).alias("n"))
        .select(*duration_columns(F.col("n"), negative=False))
    )
    spark = bounds_df.sparkSession
    before = spark.range(1).select(*before_columns())
    both = neg.unionByName(pos)
    # where a real row has the sentinel's id, the sentinel gives way
    before = before.join(both.select("duration_id"), "duration_id", "left_anti").select(*both.columns)
    return both.unionByName(before)


def insert_if_absent(existing: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing`` (ON CONFLICT DO NOTHING).

    Rows of ``new`` that share a key keep the least one, in the order of the
    columns.
    """
    rest = [c for c in new.columns if c not in keys]
    fresh = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(
        *[c if c in keys else F.col("_row").getField(c).alias(c) for c in new.columns]) if rest else new.distinct()
    if existing is not None:
        fresh = fresh.join(existing.select(*keys), keys, "left_anti")
    return fresh


def extend_durations(existing: DataFrame | None, bounds_df: DataFrame,
                     start: str = "start", as_of: str = "as_of",
                     fix_labels: bool = False) -> DataFrame:
    """The duration table after a run: existing rows plus absent ids."""
    new = insert_if_absent(existing, duration_dimension(bounds_df, start, as_of, fix_labels), ["duration_id"])
    return new if existing is None else existing.select(*DURATION_COLUMNS).unionByName(new)


def hour_of_day(spark: SparkSession) -> DataFrame:
    """24 rows ``(hour_of_day_id smallint, hour_of_day_name)``: 3 -> '3-4'."""
    h = F.col("id")
    return spark.range(24).select(h.cast("smallint").alias("hour_of_day_id"),
                                  hour_name(h).alias("hour_of_day_name"))


def hours_of(df: DataFrame, ts_column: str) -> DataFrame:
    """Hour-of-day rows for the hours that occur in a timestamp column."""
    h = F.col("h")
    return (
        df.select(F.hour(F.col(ts_column)).alias("h")).where(h.isNotNull()).distinct()
        .select(h.cast("smallint").alias("hour_of_day_id"), hour_name(h).alias("hour_of_day_name"))
    )


# Fixed value: by default the dimensions cover the last 365 days up to today.
DEFAULT_LOOKBACK_DAYS = 365


def default_range(today: _dt.date | None = None) -> tuple[_dt.date, _dt.date]:
    """(first, last) date of the dimensions when none are given: a year back to today."""
    today = today or _dt.date.today()
    return today - _dt.timedelta(days=DEFAULT_LOOKBACK_DAYS), today


def time_dimensions(spark: SparkSession, start: _dt.date | None = None, end: _dt.date | None = None,
                    as_of: _dt.date | None = None, existing_days: DataFrame | None = None,
                    existing_durations: DataFrame | None = None,
                    pad_day_names: bool = True) -> dict[str, DataFrame]:
    """The three time tables in one call: ``day``, ``duration`` and ``hour_of_day``.

    ``start``/``end`` default to a year back to today; ``as_of`` (today in the
    original, which made reruns on different days differ) defaults to ``end``.
    With existing tables, only absent rows are added and the full tables are
    returned."""
    d0, d1 = default_range()
    start, end = start or d0, end or d1
    as_of = as_of or end
    days = populate_days(existing_days, bounds(spark, start, end), pad_day_names)
    durations = extend_durations(existing_durations, bounds(spark, start, as_of, names=("start", "as_of")))
    return {"day": days, "duration": durations, "hour_of_day": hour_of_day(spark)}


def write_time_dimensions(spark: SparkSession, database: str, start: _dt.date | None = None,
                          end: _dt.date | None = None, as_of: _dt.date | None = None,
                          pad_day_names: bool = True) -> dict[str, str]:
    """Create or extend ``<database>.day``, ``.duration`` and ``.hour_of_day``.

    Existing tables keep their rows; only absent days and durations are
    appended (the hour table is written once). Returns the table names."""
    from ledgerloom.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    names = {t: f"{database}.{t}" for t in ("day", "duration", "hour_of_day")}
    have = {t: spark.catalog.tableExists(n) for t, n in names.items()}
    d0, d1 = default_range()
    start, end = start or d0, end or d1
    as_of = as_of or end
    new_days = add_absent_days(spark.table(names["day"]) if have["day"] else None,
                               bounds(spark, start, end), pad_day_names)
    new_durations = insert_if_absent(
        spark.table(names["duration"]) if have["duration"] else None,
        duration_dimension(bounds(spark, start, as_of, names=("start", "as_of"))), ["duration_id"])
    # materialise before appending: the new rows are computed against the
    # table they are appended to
    for t, rows in (("day", new_days), ("duration", new_durations)):
        rows = rows.checkpoint(eager=True)
        rows.write.format("parquet").mode("append" if have[t] else "overwrite").saveAsTable(names[t])
    if not have["hour_of_day"]:
        hour_of_day(spark).write.format("parquet").saveAsTable(names["hour_of_day"])
    return names
