"""As-of join and segmented carry-forward against the dense form and brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import asof, series

DAY = dt.date(1969, 11, 20)


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def quoted(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abcd"), rng.choice([None, 1.5, 2.0, 3.25, float(rng.randint(1, 9))]), rng.randint(0, 300)) for _ in range(120)]
    rows += [("late", 7.0, 290), ("once", 1.0, 3), (None, 2.0, 5), ("a", 4.0, None)]
    rows += [("hot", float(i), i) for i in range(0, 300, 2)]
    facts = [(i, rng.choice(["a", "b", "c", "d", "late", "once", "none", None]), rng.choice([None, *range(-5, 330)])) for i in range(400)]
    facts += [(1000 + i, "hot", rng.randint(0, 299)) for i in range(800)] + [(7, "a", 100)] * 3
    q = spark.createDataFrame([(k, v, day(d)) for k, v, d in rows], "currency string, exchange_rate double, date date")
    f = spark.createDataFrame([(i, k, day(d), "x") for i, k, d in facts], "id int, currency string, day date, _k string")
    return rows, facts, q.repartition(3), f.repartition(5)


def expected(rows, facts, how, end=None, tolerance=None):
    best = {}
    for k, v, d in rows:
        if None not in (k, v, d):
            best[k, d] = min(v, best.get((k, d), v))
    out = []
    for i, k, d in facts:
        days = [] if d is None or (end is not None and d > end) else [e for c, e in best if c == k and e <= d]
        value = best[k, max(days)] if days and (tolerance is None or d - max(days) <= tolerance) else None
        if value is not None or how == "left":
            out.append((i, k, day(d), "x", value))
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("end,tolerance,range_days,per_group", [(None, None, 32, 1 << 20), (290, None, 7, 10), ("last", 3, 1, 50),
                                                               (None, 0, 500, 3)])
def test_as_of_join(quoted, how, end, tolerance, range_days, per_group):
    rows, facts, q, f = quoted
    got = asof.as_of_join(f, q, "currency", "day", out="rate", how=how, end=day(end) if isinstance(end, int) else end,
                          tolerance_days=tolerance, range_days=range_days, rows_per_group=per_group)
    assert got.columns == [*f.columns, "rate"]
    last = max(d for k, v, d in rows if None not in (k, v, d))
    want = expected(rows, facts, how, last if end == "last" else end, tolerance)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_as_of_join_equals_the_dense_join(quoted):
    _, _, q, f = quoted
    dense = series.attach_rate(f, series.gap_fill(q), "currency", "day", out="rate")
    sparse = asof.as_of_join(f, q, "currency", "day", out="rate", end="last")
    assert sorted(map(tuple, dense.collect()), key=repr) == sorted(map(tuple, sparse.collect()), key=repr)


def test_as_of_join_makes_no_days_and_refuses_clashes(quoted):
    _, _, q, f = quoted
    plan = asof.as_of_join(f, q, "currency", "day", out="rate")._jdf.queryExecution().optimizedPlan().toString()
    made = [line for line in plan.splitlines() if "Generate explode" in line]
    assert made and all("_g#" in line for line in made)  # copies of quotes for full ranges, no days
    with pytest.raises(ValueError, match="already"):
        asof.as_of_join(f, q, "currency", "day", out="id")
    with pytest.raises(ValueError, match="how"):
        asof.as_of_join(f, q, "currency", "day", out="rate", how="outer")
    assert asof.as_of_join(f.where("false"), q, "currency", "day", out="rate").count() == 0
    assert asof.as_of_join(f, q.where("false"), "currency", "day", out="rate").count() == 0
    assert asof.as_of_join(f, q.where("false"), "currency", "day", out="rate", how="left").count() == f.count()


@pytest.mark.parametrize("end", [None, 150, 310, -10])
@pytest.mark.parametrize("range_days", [1, 7, 32, 400])
def test_gap_fill_in_ranges_equals_gap_fill(quoted, end, range_days):
    q = quoted[2]
    for include in (True, False):
        want = series.gap_fill(q, end=day(end), include_quotes=include)
        got = asof.gap_fill_in_ranges(q, end=day(end), include_quotes=include, range_days=range_days)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_window_groups_stay_small_when_one_key_holds_all_rows(spark):
    """The windows partition by range (and by group), so a single key over ten
    times the days has ten times the groups, each as large as before."""
    def most(days):
        q = spark.range(days).select(F.lit("k").alias("currency"), F.lit(1.0).alias("exchange_rate"),
                                     F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("date"))
        return q.groupBy("currency", asof.range_start(F.col("date"))).count().agg(F.max("count")).first()[0]
    assert most(300) == most(3000) == asof.RANGE_DAYS
    q = spark.range(3000).select(F.lit("k").alias("currency"), F.lit(1.0).alias("exchange_rate"),
                                 F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("date"))
    for df in (asof.gap_fill_in_ranges(q), asof.as_of_join(q.drop("exchange_rate"), q, "currency", "date", out="r")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        rows = [line for line in windows if "_r#" not in line.rsplit("], [", 2)[1]]
        # only the boundary table's window, one row per range, goes by key alone
        assert len(windows) == 2 and len(rows) == 1


def test_base_rows_have_the_dates_of_the_filled_series(quoted):
    q = quoted[2]
    for end in (None, 150, 310, -10):
        dense = series.with_base_rows(series.gap_fill(q, end=day(end))).where("currency = 'EUR'")
        sparse = series.base_rows(q, end=day(end))
        assert sorted(map(tuple, sparse.collect())) == sorted(map(tuple, dense.collect()))
    plan = series.base_rows(q)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_boundaries_are_hashed_and_days_are_not_reduced_twice(quoted):
    """a task holds no sort of all quotes for the boundary table, and quotes
    that are one per day are not aggregated again."""
    rows, facts, q, f = quoted
    one = q.where("currency is not null and date is not null and exchange_rate is not null").groupBy("currency", "date").agg(
        F.min("exchange_rate").alias("exchange_rate"))
    joined = asof.as_of_join(f, one, "currency", "day", out="rate", one_per_day=True)
    assert sorted(map(tuple, joined.collect()), key=repr) == expected(rows, facts, "inner")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    again = asof.as_of_join(f, one, "currency", "day", out="rate")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") < again.count("Aggregate [")
    assert "SortAggregate" not in joined._jdf.queryExecution().sparkPlan().toString()


def test_dealt_tables_keep_their_number_of_tasks(spark, tmp_path, monkeypatch):
    """rows, not compressed bytes, decide what a task of the line and quote tables takes."""
    from ledgerloom.plans import queries
    monkeypatch.setattr(queries, "ROWS_PER_TASK", 100)
    spark.createDataFrame([(i // 4, i % 4, i % 7, 10.0 + i, 2.0, day(i % 50)) for i in range(5000)],
                          "l_orderkey long, l_linenumber int, l_suppkey long, l_extendedprice double, l_quantity double, l_shipdate date"
                          ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(i, day(i % 60)) for i in range(1250)], "o_orderkey long, o_orderdate date"
                          ).write.parquet(str(tmp_path / "orders.parquet"))
    lines = queries._ordered_lines(spark, str(tmp_path))
    assert lines.count() == 5000 and lines.rdd.getNumPartitions() == 50
    quotes = queries._line_quotes(spark, str(tmp_path))
    assert quotes.rdd.getNumPartitions() == 50 and quotes.count() == 350
