import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions.calendar import DAY_COLUMNS, DURATION_COLUMNS
from ledgerloom.operators import timedim as td


def _day(spark, d, pad=True):
    b = td.bounds(spark, d, d)
    rows = {r["_date"]: r for r in td.day_dimension(b, pad_day_names=pad).collect()}
    return rows[d]


def test_readme_day_row(spark):
    r = _day(spark, dt.date(2019, 8, 15), pad=False)
    assert list(r.asDict().keys()) == DAY_COLUMNS
    assert (r.day_id, r.day_name, r.year_id, r.year_name, r.iso_year_id, r.iso_year_name) == \
        (20190815, "Thu, Aug 15 2019", 2019, "2019", 2019, "2019")
    assert (r.quarter_id, r.quarter_name, r.month_id, r.month_name) == (20193, "2019 Q3", 201908, "2019 Aug")
    assert (r.week_id, r.week_name, r.day_of_week_id, r.day_of_week_name, r.day_of_month_id) == \
        (201933, "2019 - CW 33", 4, "Thursday", 15)


def test_day_name_padding(spark):
    assert _day(spark, dt.date(2019, 8, 15)).day_of_week_name == "Thursday "
    assert _day(spark, dt.date(2019, 8, 14)).day_of_week_name == "Wednesday"


def test_iso_year_edges(spark):
    r = _day(spark, dt.date(2018, 12, 31))
    assert (r.year_id, r.iso_year_id, r.week_id, r.week_name, r.day_of_week_id) == (2018, 2019, 201901, "2019 - CW 01", 1)
    r = _day(spark, dt.date(2021, 1, 3))
    assert (r.year_id, r.iso_year_id, r.week_id, r.day_of_week_id) == (2021, 2020, 202053, 7)


def test_range_starts_day_before_and_rerun_adds_nothing(spark, tmp_out):
    b = td.bounds(spark, dt.date(2020, 1, 10), dt.date(2020, 1, 20))
    days = td.day_dimension(b)
    dates = sorted(r._date for r in days.select("_date").collect())
    assert dates[0] == dt.date(2020, 1, 9) and dates[-1] == dt.date(2020, 1, 20) and len(dates) == 12
    path = tmp_out("days")
    days.write.parquet(path)
    assert td.add_absent_days(spark.read.parquet(path), b).count() == 0
    wider = td.bounds(spark, dt.date(2020, 1, 5), dt.date(2020, 1, 20))
    assert td.add_absent_days(spark.read.parquet(path), wider).count() == 5  # 01-04 .. 01-08


def test_empty_and_descending_range(spark):
    b = td.bounds(spark, dt.date(2020, 1, 10), dt.date(2020, 1, 5))
    assert td.day_dimension(b).count() == 0


def _dur(spark, start, as_of):
    b = td.bounds(spark, start, as_of, names=("start", "as_of"))
    return {r.duration_id: r for r in td.extend_durations(None, b).collect()}


def test_duration_readme_rows(spark):
    rows = _dur(spark, dt.date(2020, 1, 1), dt.date(2020, 3, 1))
    r = rows[7]
    assert list(r.asDict().keys()) == DURATION_COLUMNS
    assert (r.days, r.days_name, r.weeks, r.weeks_name) == (7, "7 days", 1, "7-13 days")
    assert (r.four_weeks, r.four_weeks_name, r.months, r.months_name) == (0, "0-27 days", 0, "0-29 days")
    assert (r.sixth_years_name, r.half_years_name, r.years_name) == ("0-59 days", "0-179 days", "0-359 days")
    assert rows[0].days_name == "0 days" and rows[0].weeks_name == "0-6 days"


def test_duration_negative_and_sentinel(spark):
    rows = _dur(spark, dt.date(2020, 1, 1), dt.date(2020, 6, 1))
    r = rows[-1]
    assert (r.days, r.days_name, r.weeks, r.weeks_name) == (-1, "-0 days", -1, "-0 to -6 days")
    r = rows[-8]  # n = -7
    assert (r.days_name, r.weeks, r.weeks_name) == ("-7 days", -2, "-7 to -13 days")
    r = rows[-62]  # n = -61: the sixth-year lower bound uses n % 90
    assert r.sixth_years_name == "-0 to -119 days"
    s = rows[-30000]
    assert s.days == -30000 and s.years_name == "before" and s.half_years_name == "before"
    # ids cover (start - as_of - 1) .. (as_of - start + 2), plus the sentinel
    span = (dt.date(2020, 6, 1) - dt.date(2020, 1, 1)).days
    assert min(k for k in rows if k != -30000) == -span - 1
    assert max(rows) == span + 2
    assert len(rows) == (span + 1) + (span + 3) + 1


def test_duration_fix_labels(spark):
    b = td.bounds(spark, dt.date(2020, 1, 1), dt.date(2020, 6, 1), names=("start", "as_of"))
    rows = {r.duration_id: r for r in td.duration_dimension(b, fix_labels=True).collect()}
    assert rows[-62].sixth_years_name == "-60 to -119 days"


def test_duration_rerun_adds_nothing(spark, tmp_out):
    b = td.bounds(spark, dt.date(2020, 1, 1), dt.date(2020, 2, 1), names=("start", "as_of"))
    path = tmp_out("dur")
    td.extend_durations(None, b).write.parquet(path)
    existing = spark.read.parquet(path)
    assert td.insert_if_absent(existing, td.duration_dimension(b), ["duration_id"]).count() == 0


def test_long_day_spans(spark):
    b = td.bounds(spark, dt.date(1900, 1, 1), dt.date(2020, 1, 1))
    assert td.day_dimension(b).count() == (dt.date(2020, 1, 1) - dt.date(1900, 1, 1)).days + 2


def test_hour_of_day(spark):
    rows = {r.hour_of_day_id: r.hour_of_day_name for r in td.hour_of_day(spark).collect()}
    assert len(rows) == 24 and rows[3] == "3-4" and rows[23] == "23-24"
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = {r.hour_of_day_id: r.hour_of_day_name for r in td.hours_of(ev, "ts").collect()}
    assert all(rows[h] == n for h, n in got.items())


def test_time_dimensions_bundle(spark):
    t = td.time_dimensions(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 31))
    assert set(t) == {"day", "duration", "hour_of_day"}
    assert t["day"].count() == 32 and t["hour_of_day"].count() == 24
    assert t["duration"].count() == 31 + 33 + 1
    again = td.time_dimensions(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 31),
                               existing_days=t["day"], existing_durations=t["duration"])
    assert again["day"].count() == 32 and again["duration"].count() == 65


def test_write_time_dimensions_incrementally(spark, tmp_out):
    from ledgerloom.session import unique_name
    db = unique_name("time")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_out(db)}'")
    names = td.write_time_dimensions(spark, db, dt.date(2020, 1, 10), dt.date(2020, 1, 20))
    assert spark.table(names["day"]).count() == 12
    assert spark.table(names["hour_of_day"]).count() == 24
    n_dur = spark.table(names["duration"]).count()
    td.write_time_dimensions(spark, db, dt.date(2020, 1, 5), dt.date(2020, 1, 25))
    assert spark.table(names["day"]).count() == 22  # 01-04 .. 01-25, no duplicates
    assert spark.table(names["day"]).select("_date").distinct().count() == 22
    assert spark.table(names["duration"]).count() > n_dur
    assert spark.table(names["duration"]).select("duration_id").distinct().count() == \
        spark.table(names["duration"]).count()


def test_default_range_is_a_year_to_today():
    first, last = td.default_range(dt.date(2024, 3, 1))
    assert (first, last) == (dt.date(2023, 3, 2), dt.date(2024, 3, 1))
    first, last = td.default_range()
    assert last == dt.date.today() and (last - first).days == 365
