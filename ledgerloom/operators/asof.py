"""As-of lookups on sparse quotes, in date ranges of a key.

The last value known on a day is carried along a key's days. Doing that in one
window per key makes a key with most of the rows one task, and doing it on a
dense key x day table makes rows nobody asks for. Here a key's days are cut into
ranges of ``range_days`` days:

* the *boundary table* has one row per key and range: what the last quote before
  the range was (a window over these few rows, not over facts or quotes);
* inside a range, the boundary, the range's quotes and the facts are one union,
  sorted once by day, and the last quote is carried forward.

A window group is therefore one range of one key. Ranges that hold more than
``rows_per_group`` facts are dealt into that many groups, each with a copy of
the range's few quotes.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.operators.attributes import quote_name
from ledgerloom.operators.series import _clean, _end_column

# Days of a range, and facts of a range that one window group takes.
RANGE_DAYS = 32
ROWS_PER_GROUP = 1 << 20


def range_start(date: Column, range_days: int = RANGE_DAYS) -> Column:
    """The first day of the range that holds ``date``, as days since 1970."""
    day = F.unix_date(date)
    return day - F.pmod(day, F.lit(range_days))


def boundaries(quotes: DataFrame, asked: DataFrame) -> DataFrame:
    """``(_k, _r, rows, before, since)``: for every range in ``asked (_k, _r,
    rows)`` the last quote of an earlier range and its day. ``quotes`` is ``(_k,
    _r, _d, _q)``, one number a day. Day and number are aggregated apart: a
    struct of them would have all quotes sorted instead of hashed."""
    last = quotes.groupBy("_k", "_r").agg(F.max_by("_q", "_d").alias("last"), F.max("_d").alias("day"))
    nothing = F.lit(None)
    ranges = asked.withColumns({"last": nothing.cast(last.schema["last"].dataType), "day": nothing.cast("date")}).unionByName(
        last.withColumn("rows", F.lit(0).cast("long")).select(*asked.columns, "last", "day"))
    one = ranges.groupBy("_k", "_r").agg(F.sum("rows").alias("rows"), F.max("last").alias("last"), F.max("day").alias("day"))
    earlier = Window.partitionBy("_k").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    return one.withColumns({"before": F.last("last", ignorenulls=True).over(earlier),
                            "since": F.last("day", ignorenulls=True).over(earlier)}).drop("last", "day")


def _hash_of(df: DataFrame) -> Column:
    fit = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()
           and "variant" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(quote_name(c)) for c in fit]) if fit else F.lit(0).cast("long")


def as_of_join(fact: DataFrame, quotes: DataFrame, fact_key: str, fact_date: str, key: str = "currency",
               date: str = "date", value: str = "exchange_rate", out: str | None = None, how: str = "inner",
               end: _dt.date | str | None = None, tolerance_days: int | None = None, one_per_day: bool = False,
               range_days: int = RANGE_DAYS, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Each fact row with the last value of its key on or before its day.

    The result equals a join with the gap-filled (dense) series: several quotes
    of a key and day count as the smallest, facts before their key's first quote
    find none, and with ``end`` facts after that day find none either ("last"
    means the last quoted day). ``tolerance_days`` limits the age of a quote.
    ``how`` is "inner" or "left"; a left join keeps facts that find none,
    rows with a null key or day among them. ``one_per_day=True`` promises at
    most one quote per key and day and skips the per-day minimum. ``out`` names
    the added column."""
    out = out or value
    if out in fact.columns:
        raise ValueError(f"the fact has a column {out} already; pass out with another name")
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    q = _clean(quotes, key, date, value).select(F.col(key).alias("_k"), F.col(date).alias("_d"), F.col(value).alias("v"))
    if not one_per_day:
        q = q.groupBy("_k", "_d").agg(F.min("v").alias("v"))
    limit = None if end is None else _end_column(q, "_d", None if end == "last" else end)
    numbers = q.select("_k", "_d", range_start(F.col("_d"), range_days).alias("_r"), F.col("v").alias("_q"))
    q = numbers.select("_k", "_d", "_r", F.struct(F.col("_d").alias("day"), F.col("_q").alias("value")).alias("_q"))
    day = F.col(quote_name(fact_date)).cast("date")
    rows = fact.select(
        F.col(quote_name(fact_key)).alias("_k"), day.alias("_d"), range_start(day, range_days).alias("_r"),
        _hash_of(fact).alias("_h"), F.struct(*[F.col(quote_name(c)) for c in fact.columns]).alias("_row"))
    known = rows.where(F.col("_k").isNotNull() & F.col("_d").isNotNull())
    asked = known.groupBy("_k", "_r").agg(F.count(F.lit(1)).alias("rows"))
    bounds = boundaries(numbers, asked).withColumn("groups", F.ceil(F.col("rows") / rows_per_group)).where("rows > 0")
    full = bounds.where("groups > 1").select("_k", "_r", "groups")
    several = F.coalesce("groups", F.lit(1))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), several.cast("long") - 1)).alias("_g")
    nothing = F.lit(None)
    facts = known.join(full, ["_k", "_r"], "left").select(
        "_k", "_r", F.pmod(F.col("_h"), several).alias("_g"), "_d", F.lit(1).alias("_side"),
        nothing.cast(q.schema["_q"].dataType).alias("_q"), "_row")
    told = q.join(full, ["_k", "_r"], "left").select(
        "_k", "_r", copies, "_d", F.lit(0).alias("_side"), "_q", nothing.cast(rows.schema["_row"].dataType).alias("_row"))
    carried = bounds.where("before is not null").select(
        "_k", "_r", copies, nothing.cast("date").alias("_d"), F.lit(0).alias("_side"),
        F.struct(F.col("since").alias("day"), F.col("before").alias("value")).alias("_q"),
        nothing.cast(rows.schema["_row"].dataType).alias("_row"))
    running = (Window.partitionBy("_k", "_r", "_g").orderBy(F.col("_d").asc_nulls_first(), "_side")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (facts.unionByName(told).unionByName(carried)
             .withColumn("_q", F.last("_q", ignorenulls=True).over(running)).where("_side = 1"))
    answer = F.col("_q.value")
    if limit is not None:
        answer = F.when(F.col("_d") <= limit, answer)
    if tolerance_days is not None:
        answer = F.when(F.date_diff("_d", F.col("_q.day")) <= tolerance_days, answer)
    result = found.select("_row.*", answer.alias(out))
    if how == "inner":
        return result.where(F.col(quote_name(out)).isNotNull())
    lost = rows.where(F.col("_k").isNull() | F.col("_d").isNull()).select("_row.*", nothing.cast("double").alias(out))
    return result.unionByName(lost)


def gap_fill_in_ranges(quotes: DataFrame, key: str = "currency", date: str = "date", value: str = "exchange_rate",
                       end: _dt.date | str | None = None, include_quotes: bool = True, one_per_day: bool = False,
                       range_days: int = RANGE_DAYS) -> DataFrame:
    """The rows of :func:`ledgerloom.operators.series.gap_fill`, with a window
    group per key and range instead of one per key.

    A range starts with what the boundary table carries into it; within it each
    quote holds until the next one or the end of the range."""
    q = _clean(quotes, key, date, value)
    daily = q if one_per_day else q.groupBy(key, date).agg(F.min(value).alias(value))
    stop = _end_column(daily, date, end)
    d = daily.select(F.col(key).alias("_k"), F.col(date).alias("_d"), F.col(value).alias("_q"),
                     range_start(F.col(date), range_days).alias("_r"))
    # every range of a key from its first quote to the end, found from one row per key
    first = d.groupBy("_k").agg(F.min("_r").alias("from")).withColumn("to", range_start(stop, range_days)).where("from <= to")
    ranges = first.select("_k", F.explode(F.sequence("from", "to", F.lit(range_days))).alias("_r"), F.lit(1).cast("long").alias("rows"))
    before = boundaries(d, ranges).where("rows > 0 and before is not null").select(
        "_k", F.date_from_unix_date("_r").alias("_d"), F.col("before").alias("_q"), "_r", F.lit(True).alias("_fill"))
    known = d.withColumn("_fill", F.lit(False))
    inside = Window.partitionBy("_k", "_r").orderBy("_d", F.col("_fill").desc())
    until = F.least(F.coalesce(F.lead("_d").over(inside), F.date_from_unix_date(F.col("_r") + range_days)), F.date_add(stop, 1))
    held = before.unionByName(known).withColumn("_until", until)
    since = F.when(F.col("_fill"), F.col("_d")).otherwise(F.date_add("_d", 1))
    fills = held.where(since < F.col("_until")).select(
        F.col("_k").alias(key), F.col("_q").alias(value), F.explode(F.sequence(since, F.date_sub("_until", 1))).alias(date))
    return q.select(key, value, date).unionByName(fills) if include_quotes else fills
