"""Random small inputs checked against brute force in plain Python."""

import datetime as dt
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.functions.chunking import chunk_of_text
from ledgerloom.operators import series as ser

D0 = dt.date(2020, 1, 1)
quotes_st = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 20), st.integers(1, 9)),
    min_size=1, max_size=25,
)


def brute_gap_fill(rows, end):
    by_key = {}
    for k, day, v in rows:
        by_key.setdefault(k, {}).setdefault(day, []).append(v)
    out = []
    for k, days in by_key.items():
        first = min(days)
        carried = None
        for day in range(first, end + 1):
            if day in days:
                carried = min(days[day])
            else:
                out.append((k, float(carried), D0 + dt.timedelta(days=day)))
    return sorted(out)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=quotes_st, end=st.integers(0, 25))
def test_gap_fill_matches_brute_force(spark, rows, end):
    df = spark.createDataFrame(
        [(k, float(v), D0 + dt.timedelta(days=d)) for k, d, v in rows],
        "currency string, exchange_rate double, date date")
    want = brute_gap_fill(rows, end)
    end_date = D0 + dt.timedelta(days=end)
    for fill in (ser.gap_fill, ser.gap_fill_windowed):
        got = sorted(tuple(r) for r in fill(df, end=end_date, include_quotes=False).collect())
        assert got == want, fill.__name__


def brute_chunk(text, n=7):
    if text is None:
        return 0
    h = int(hashlib.md5(text.encode("utf-8")).hexdigest()[:8], 16)
    signed = h - 2**32 if h >= 2**31 else h
    return abs(signed) % n


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.one_of(st.none(), st.text(max_size=30)), min_size=1, max_size=40),
       n=st.integers(1, 11))
def test_text_chunk_matches_md5(spark, texts, n):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", chunk_of_text("t", n).alias("c")).collect()}
    assert got == {i: brute_chunk(t, n) for i, t in enumerate(texts)}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(start=st.dates(dt.date(1950, 1, 1), dt.date(2090, 1, 1)), span=st.integers(0, 400))
def test_day_columns_match_python_calendar(spark, start, span):
    from ledgerloom.operators import timedim as td
    end = start + dt.timedelta(days=span)
    rows = td.day_dimension(td.bounds(spark, start, end)).collect()
    assert len(rows) == span + 2
    for r in rows:
        d = r._date
        iy, iw, idow = d.isocalendar()
        q = (d.month - 1) // 3 + 1
        assert r.day_id == int(d.strftime("%Y%m%d"))
        assert r.day_name == d.strftime("%a, %b %d %Y")
        assert (r.year_id, r.iso_year_id, r.iso_year_name) == (d.year, iy, str(iy))
        assert (r.quarter_id, r.quarter_name) == (d.year * 10 + q, f"{d.year} Q{q}")
        assert (r.month_id, r.month_name) == (d.year * 100 + d.month, d.strftime("%Y %b"))
        assert (r.week_id, r.week_name) == (iy * 100 + iw, f"{iy} - CW {iw:02d}")
        assert (r.day_of_week_id, r.day_of_week_name) == (idow, d.strftime("%A").ljust(9))
        assert r.day_of_month_id == d.day


def _tdiv(a, b):
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def _tmod(a, b):
    return a - b * _tdiv(a, b)


def brute_duration(n, negative):
    buckets = [("weeks", 7), ("four_weeks", 28), ("months", 30), ("sixth_years", 60),
               ("half_years", 180), ("years", 360)]
    if negative:
        row = {"duration_id": n - 1, "days": n - 1, "days_name": f"-{-n} days"}
        for name, size in buckets:
            lower = 90 if name == "sixth_years" else size
            row[name] = _tdiv(n - size, size)
            row[f"{name}_name"] = f"-{-n + _tmod(n, lower)} to -{-n + size - 1 + _tmod(n, size)} days"
    else:
        row = {"duration_id": n, "days": n, "days_name": f"{n} days"}
        for name, size in buckets:
            row[name] = n // size
            row[f"{name}_name"] = f"{n - n % size}-{n + size - 1 - n % size} days"
    return row


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(start=st.dates(dt.date(2000, 1, 1), dt.date(2030, 1, 1)), span=st.integers(0, 800))
def test_durations_match_integer_rules(spark, start, span):
    from ledgerloom.operators import timedim as td
    as_of = start + dt.timedelta(days=span)
    got = {r.duration_id: r.asDict() for r in
           td.duration_dimension(td.bounds(spark, start, as_of, names=("start", "as_of"))).collect()}
    want = {}
    for n in range(-span, 1):
        want.setdefault(n - 1, brute_duration(n, True))
    for n in range(0, span + 3):
        want.setdefault(n, brute_duration(n, False))
    assert got.pop(-30000)["years_name"] == "before"
    assert got == want
