from pyspark.sql import functions as F

from ledgerloom.operators import enums as en
from ledgerloom.operators import sketches as sk
from ledgerloom.operators.ordinals import number_in_order


def test_enum_from_list_and_append(spark):
    e = en.create_enum(["a", "b", "c"], spark=spark)
    assert sorted(tuple(r) for r in e.collect()) == [("a", 1), ("b", 2), ("c", 3)]
    e2 = en.add_enum_values(e, ["d"])
    assert sorted(tuple(r) for r in e2.collect())[-1] == ("d", 4)
    e3 = en.add_enum_values(e2, ["a"])
    assert e3.count() == 4
    long = "x" * 64
    assert [r.chars for r in en.long_labels([long, "ok"], spark=spark).collect()] == [64]
    e4 = en.add_enum_values(e3, [long])
    assert sorted(tuple(r) for r in e4.collect())[-1] == (long, 5)


def test_enum_from_query_sorted(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    e = en.create_enum(o, "o_orderpriority").orderBy("ordinal").collect()
    assert [r.ordinal for r in e] == [1, 2, 3, 4, 5]
    assert [r.value for r in e] == sorted(r.value for r in e)
    assert en.outside_enum(o, "o_orderpriority", en.create_enum(["1-URGENT"], spark=spark)).count() == \
        o.where("o_orderpriority <> '1-URGENT'").count()


def test_numbering_is_consecutive_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 5000).alias("k"))
    out = number_in_order(df, ["k"]).collect()
    assert sorted(r.ordinal for r in out) == list(range(1, 5001))
    assert all(r.ordinal == r.k + 1 for r in out)


def test_hll_rollup_close_to_exact(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    detail = sk.hll_sketches(li.withColumn("m", F.date_trunc("month", "l_shipdate")), ["l_suppkey", "m"], "l_partkey")
    total = sk.hll_rollup(detail.withColumn("all", F.lit(1)), ["all"]).first().distinct_estimate
    exact = li.select("l_partkey").distinct().count()
    assert abs(total - exact) <= 0.03 * exact
    coarse = sk.hll_union(detail, ["l_suppkey"])
    assert coarse.count() == li.select("l_suppkey").distinct().count()


def test_enum_ordered_by_another_column(spark):
    df = spark.createDataFrame([("low", 3), ("high", 1), ("mid", 2), ("high", 9)], "label string, rank int")
    e = en.create_enum(df, "label", order_by="rank").orderBy("ordinal").collect()
    assert [r.value for r in e] == ["high", "mid", "low"]
