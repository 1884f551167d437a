"""Sparse rate series made dense: last value carried forward.

Quotes arrive for some days only (bank working days). ``gap_fill`` adds, for
every key and every day after its first quote up to ``end``, the last known
value; days before a key's first quote stay absent, original rows are kept.
Several quotes for one key and day: the smallest one is carried.

Plan (``gap_fill``): partial+final ``min`` per (key, date) — the only shuffle
of raw rows, combined map-side — then ``lead(date)`` over the *sparse* quotes
per key, then ``explode(sequence(date + 1, next - 1))`` row by row. The dense
rows are produced after the window, never sorted or shuffled; a key's window
group holds at most one row per quoted day, whatever its share of raw rows.

``gap_fill_windowed`` is the formulation with a dense calendar, a right join
and running windows; same result, kept to measure against.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _end_column(quotes: DataFrame, date: str, end: _dt.date | str | None) -> Column:
    if end is None:
        # Last day with any quote, as a scalar subquery (one small job).
        return quotes.agg(F.max(F.col(date).cast("date"))).scalar()
    return F.lit(end).cast("date")


def _clean(quotes: DataFrame, key: str, date: str, value: str) -> DataFrame:
    return quotes.select(
        F.col(key), F.col(value).cast("double").alias(value), F.col(date).cast("date").alias(date)
    ).where(F.col(value).isNotNull() & F.col(date).isNotNull() & F.col(key).isNotNull())


def gap_fill(quotes: DataFrame, key: str = "currency", date: str = "date",
             value: str = "exchange_rate", end: _dt.date | str | None = None,
             include_quotes: bool = True, one_per_day: bool = False) -> DataFrame:
    """Quotes plus carried-forward rows ``(key, value, date)`` through ``end``.

    ``end`` defaults to the last quoted day. Original quotes are returned as
    they are, including any after ``end``, which create no filled rows; with
    ``include_quotes=False`` only the added rows are returned.
    ``one_per_day=True`` promises at most one quote per key and day (e.g. an
    aggregated quote table) and skips the per-day minimum.
    """
    q = _clean(quotes, key, date, value)
    daily = q if one_per_day else q.groupBy(key, date).agg(F.min(value).alias(value))
    # The end comes from the daily quotes, whose shuffle the fill branch also
    # reads: adaptive execution runs that stage once for both.
    stop_at = _end_column(daily, date, end)
    nxt = F.lead(F.col(date)).over(Window.partitionBy(key).orderBy(date))
    stop = F.least(F.coalesce(F.date_sub(nxt, 1), stop_at), stop_at)
    fills = (
        daily.withColumn("_stop", stop)
        .where(F.col("_stop") > F.col(date))
        .select(key, value, F.explode(F.sequence(F.date_add(F.col(date), 1), F.col("_stop"))).alias(date))
    )
    if not include_quotes:
        return fills
    return q.select(key, value, date).unionByName(fills)


def gap_fill_windowed(quotes: DataFrame, key: str = "currency", date: str = "date",
                      value: str = "exchange_rate", end: _dt.date | str | None = None,
                      include_quotes: bool = True, one_per_day: bool = False) -> DataFrame:
    """Same result as :func:`gap_fill`, via a dense calendar and running windows.

    The calendar of each key runs from its own first quote to ``end`` (rows
    before the first quote could never be filled), so no key x day cross
    product is built. The daily quotes are right-joined onto it; a running
    ``max`` gives the date of the last quote (W1) and the last non-NULL daily
    minimum its value (W2). Quotes are reduced to one per key and day first,
    so that value equals the minimum over the last quote's group, and both
    windows share one sort.
    """
    q = _clean(quotes, key, date, value)
    daily = q if one_per_day else q.groupBy(key, date).agg(F.min(value).alias(value))
    stop_at = _end_column(daily, date, end)
    firsts = daily.groupBy(key).agg(F.min(date).alias("_first"))
    calendar = (
        firsts.where(F.col("_first") <= stop_at)
        .select(key, F.explode(F.sequence(F.col("_first"), stop_at)).alias(date))
    )
    joined = daily.join(calendar, [key, date], "right")
    running = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = joined.select(
        key, date, value,
        F.max(F.when(F.col(value).isNotNull(), F.col(date))).over(running).alias("_last"),
        F.last(F.col(value), ignorenulls=True).over(running).alias("_carried"),
    )
    fills = (
        filled.where(F.col(value).isNull() & F.col("_last").isNotNull())
        .select(key, F.col("_carried").alias(value), date)
    )
    if not include_quotes:
        return fills
    return q.select(key, value, date).unionByName(fills)


def with_base_rows(series: DataFrame, base: str = "EUR", key: str = "currency",
                   date: str = "date", value: str = "exchange_rate") -> DataFrame:
    """Add ``(base, 1.0, date)`` for every date present, to simplify joins."""
    dates = series.select(date).distinct()
    base_rows = dates.select(F.lit(base).alias(key), F.lit(1.0).alias(value), F.col(date))
    return series.select(key, value, date).unionByName(base_rows)


def base_rows(quotes: DataFrame, base: str = "EUR", key: str = "currency", date: str = "date",
              value: str = "exchange_rate", end: _dt.date | str | None = None) -> DataFrame:
    """``(base, 1.0, date)`` for every date of the gap-filled series, from the
    sparse quotes alone.

    From the first quote of all to ``end`` the filled series has every day (the
    key of that quote does), after ``end`` only the quoted days."""
    days = quotes.select(F.col(date).cast("date").alias(date), F.col(key).alias("_k"), F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & F.col(date).isNotNull() & F.col("_k").isNotNull()).select(date).distinct()
    stop = _end_column(days, date, end)
    first = days.agg(F.min(date).alias("_first"))
    filled = first.where(F.col("_first") <= stop).select(F.explode(F.sequence(F.col("_first"), stop)).alias(date))
    later = days.where(F.col(date) > stop)
    return filled.unionByName(later).select(F.lit(base).alias(key), F.lit(1.0).alias(value), F.col(date))


def attach_rate(fact: DataFrame, rates: DataFrame, fact_key: str, fact_date: str,
                key: str = "currency", date: str = "date", value: str = "exchange_rate",
                how: str = "inner", rates_unique: bool = False, strategy: str = "merge",
                out: str | None = None) -> DataFrame:
    """Join each fact row to the rate of its key on its date.

    Several quotes for one key and day collapse to the smallest first, so a
    fact row never multiplies; pass ``rates_unique=True`` when the rate table
    has one row per key and day already (a gap fill of one-per-day quotes
    does) to skip that aggregation and its shuffle.

    ``strategy``: the rate table grows with keys x days, and when it comes
    out of a gap fill the planner's size estimate ignores the ``explode`` (it
    sees the sparse quotes), so a plain join may broadcast a table ten or a
    thousand times larger than estimated. The default ``"merge"`` shuffles
    both sides on (key, date) — safe at any size, and a hot key spreads over
    its days. ``"auto"`` leaves the choice to the planner and to adaptive
    execution. ``out`` names the rate column (``value`` by default); a fact
    column of that name is an error.
    """
    out = out or value
    if out in fact.columns:
        raise ValueError(f"the fact has a column {out} already; pass out with another name")
    r = rates.select(F.col(key).alias("_rk"), F.col(date).cast("date").alias("_rd"), F.col(value).alias(out))
    if not rates_unique:
        r = r.groupBy("_rk", "_rd").agg(F.min(out).alias(out))
    if strategy == "merge":
        r = r.hint("merge")
    elif strategy != "auto":
        raise ValueError("strategy must be 'merge' or 'auto'")
    cond = (F.col(fact_key) == F.col("_rk")) & (F.col(fact_date).cast("date") == F.col("_rd"))
    return fact.join(r, cond, how).drop("_rk", "_rd")
