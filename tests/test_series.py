import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import series as ser
from ledgerloom.sources import rates_csv as rc

D = dt.date


def _write(path, text):
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/rates.csv", "w") as f:
        f.write(text)


@pytest.fixture()
def f2(spark, tmp_out):
    path = tmp_out("f2")
    if path.startswith("file:"):
        path = path[5:]
    _write(path, "Date,USD,BGN,\n2020-01-03,1.1,N/A,\n2020-01-02,1.2,1.9,\n")
    return path


def test_wide_file_melt(spark, f2):
    long = rc.load_rates(spark, f2)
    assert long.columns == ["currency", "exchange_rate", "date"]
    got = sorted(tuple(r) for r in long.collect())
    assert got == sorted([("USD", 1.1, D(2020, 1, 3)), ("USD", 1.2, D(2020, 1, 2)), ("BGN", 1.9, D(2020, 1, 2))])


def test_generated_column_names_are_not_codes(spark, f2):
    wide = rc.read_rate_file(spark, f2)
    assert "_c3" in wide.columns
    assert rc.rate_columns(wide) == ["USD", "BGN"]


def test_no_rate_columns(spark):
    wide = spark.createDataFrame([("2020-01-01", "x")], "Date string, note string")
    out = rc.melt_rates(wide)
    assert out.count() == 0 and out.columns == ["currency", "exchange_rate", "date"]


def _f3(spark):
    rows = [("USD", 1.1, D(2020, 1, 3)), ("USD", 1.2, D(2020, 1, 2)), ("BGN", 1.9, D(2020, 1, 2)),
            ("CHF", 1.0, D(2020, 1, 5))]
    return spark.createDataFrame(rows, "currency string, exchange_rate double, date date")


@pytest.mark.parametrize("fill", [ser.gap_fill, ser.gap_fill_windowed])
def test_f3_gap_fill(spark, fill):
    out = ser.with_base_rows(fill(_f3(spark), end=D(2020, 1, 6)))
    got = sorted(tuple(r) for r in out.collect())
    exp = sorted(
        [("USD", 1.2, D(2020, 1, 2)), ("USD", 1.1, D(2020, 1, 3))]
        + [("USD", 1.1, D(2020, 1, d)) for d in (4, 5, 6)]
        + [("BGN", 1.9, D(2020, 1, d)) for d in (2, 3, 4, 5, 6)]
        + [("CHF", 1.0, D(2020, 1, 5)), ("CHF", 1.0, D(2020, 1, 6))]
        + [("EUR", 1.0, D(2020, 1, d)) for d in (2, 3, 4, 5, 6)]
    )
    assert got == exp and len(got) == 17


@pytest.mark.parametrize("fill", [ser.gap_fill, ser.gap_fill_windowed])
def test_gap_fill_edges(spark, fill):
    rows = [("A", 2.0, D(2020, 1, 1)), ("A", 1.5, D(2020, 1, 1)),   # two quotes one day: smaller carried
            ("A", 3.0, D(2020, 1, 9)),                               # quote after the end
            ("B", 7.0, D(2020, 1, 3))]                               # single-quote currency
    q = spark.createDataFrame(rows, "currency string, exchange_rate double, date date")
    fills = sorted(tuple(r) for r in fill(q, end=D(2020, 1, 4), include_quotes=False).collect())
    assert fills == [("A", 1.5, D(2020, 1, 2)), ("A", 1.5, D(2020, 1, 3)), ("A", 1.5, D(2020, 1, 4)),
                     ("B", 7.0, D(2020, 1, 4))]
    full = fill(q, end=D(2020, 1, 4))
    assert full.count() == len(rows) + 4   # original rows kept as they are


def test_gap_fill_property_no_holes(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    q = li.select(F.col("l_suppkey").cast("string").alias("currency"),
                  (F.col("l_extendedprice") / F.col("l_quantity")).alias("exchange_rate"),
                  F.col("l_shipdate").cast("date").alias("date"))
    out = ser.gap_fill(q).groupBy("currency", "date").agg(F.count(F.lit(1)).alias("n"))
    per = out.groupBy("currency").agg(F.min("date").alias("a"), F.max("date").alias("b"), F.count(F.lit(1)).alias("days"))
    end = q.agg(F.max("date")).first()[0]
    for r in per.collect():
        assert r.b == end and r.days == (r.b - r.a).days + 1


def test_gap_fill_plan_has_no_cross_join(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    q = li.select(F.col("l_suppkey").cast("string").alias("currency"),
                  (F.col("l_extendedprice") / F.col("l_quantity")).alias("exchange_rate"),
                  F.col("l_shipdate").cast("date").alias("date"))
    for fill in (ser.gap_fill, ser.gap_fill_windowed):
        plan = fill(q)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_attach_rate_never_multiplies(spark):
    rates = spark.createDataFrame([("A", 2.0, D(2020, 1, 1)), ("A", 1.0, D(2020, 1, 1))],
                                  "currency string, exchange_rate double, date date")
    fact = spark.createDataFrame([(1, "A", D(2020, 1, 1)), (2, "B", D(2020, 1, 1))], "id int, cur string, d date")
    got = [tuple(r) for r in ser.attach_rate(fact, rates, "cur", "d").collect()]
    assert got == [(1, "A", D(2020, 1, 1), 1.0)]


def test_build_rate_table_from_file(spark, f2, tmp_out):
    rates = rc.build_rate_table(spark, f2, end=D(2020, 1, 4))
    got = sorted(tuple(r) for r in rates.collect())
    assert ("BGN", 1.9, D(2020, 1, 4)) in got and ("EUR", 1.0, D(2020, 1, 2)) in got
    assert len(got) == 3 + 3 + 3  # USD, BGN and EUR each on 02..04
    path = tmp_out("rates")
    rc.write_rate_table(rates, path)
    assert spark.read.parquet(path).count() == len(got)


def test_attach_rate_strategies(spark):
    rates = spark.createDataFrame([("A", 2.0, D(2020, 1, 1)), ("B", 3.0, D(2020, 1, 1))],
                                  "currency string, exchange_rate double, date date")
    fact = spark.createDataFrame([(1, "A", D(2020, 1, 1)), (2, "B", D(2020, 1, 1))], "id int, cur string, d date")
    for strategy in ("merge", "auto"):
        j = ser.attach_rate(fact, rates, "cur", "d", strategy=strategy)
        assert sorted(r.exchange_rate for r in j.collect()) == [2.0, 3.0]
        if strategy == "merge":
            assert "SortMergeJoin" in j._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        ser.attach_rate(fact, rates, "cur", "d", strategy="nope")


@pytest.mark.parametrize("fill", [ser.gap_fill, ser.gap_fill_windowed])
def test_one_per_day_shortcut_same_result(spark, fill):
    q = _f3(spark)
    a = sorted(tuple(r) for r in fill(q, end=D(2020, 1, 6)).collect())
    b = sorted(tuple(r) for r in fill(q, end=D(2020, 1, 6), one_per_day=True).collect())
    assert a == b
