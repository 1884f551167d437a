"""One key holding a third of all rows: results stay exact and the plans
aggregate before they shuffle, so the hot key travels as one row per task."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import attributes as attr
from ledgerloom.operators import checks as ck
from ledgerloom.operators import series as ser


def _skewed_lines(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    n = li.count()
    # every third row is moved onto supplier 1 (a third of all rows on one key)
    return li.withColumn("_i", F.monotonically_increasing_id()) \
        .withColumn("l_suppkey", F.when(F.col("_i") % 3 == 0, F.lit(1)).otherwise(F.col("l_suppkey"))) \
        .drop("_i"), n


def _exchange_inputs(plan: str) -> list[str]:
    lines = plan.split("\n")
    return [lines[i + 1] for i, l in enumerate(lines) if "Exchange hashpartitioning" in l and i + 1 < len(lines)]


def test_gap_fill_hot_key(spark):
    li, _ = _skewed_lines(spark)
    q = li.select(F.col("l_suppkey").cast("string").alias("currency"),
                  (F.col("l_extendedprice") / F.col("l_quantity")).alias("exchange_rate"),
                  F.col("l_shipdate").cast("date").alias("date"))
    out = ser.gap_fill(q, end=dt.date(2001, 12, 31), include_quotes=False)
    hot = out.where("currency = '1'")
    first = q.where("currency = '1'").agg(F.min("date")).first()[0]
    # the hot key is filled on every day it has no quote, and only there
    quoted = q.where("currency = '1'").select("date").distinct().count()
    assert hot.count() == (dt.date(2001, 12, 31) - first).days + 1 - quoted
    plan = out._jdf.queryExecution().executedPlan().toString()
    inputs = _exchange_inputs(plan)
    # raw rows are shuffled only after a partial min; the window's shuffle
    # moves the final daily minima
    assert any("partial_min" in x for x in inputs)
    assert all("HashAggregate" in x for x in inputs)


def test_fk_check_hot_key(spark):
    li, n = _skewed_lines(spark)
    supplier = spark.read.parquet("/root/testdata/sf0.01/supplier.parquet").where("s_suppkey <> 1")
    row = ck.check_foreign_key("hot", li, "l_suppkey", supplier, "s_suppkey").first()
    assert row.left_value == li.where("l_suppkey = 1").count()  # every hot row is an orphan
    assert row.right_value == 1
    plan = ck.check_foreign_key("hot", li, "l_suppkey", supplier, "s_suppkey") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_attribute_counts_hot_value(spark):
    li, n = _skewed_lines(spark)
    df = li.select(F.col("l_suppkey").cast("string").alias("s"))
    got = {r.value: r.row_count for r in attr.attribute_counts(df).collect()}
    assert sum(got.values()) == n and got["1"] >= n // 3
    plan = attr.attribute_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_fk_check_counts_child_keys_before_the_join_shuffle(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    supplier = spark.read.parquet("/root/testdata/sf0.01/supplier.parquet")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a large parent table
    try:
        plan = ck.check_foreign_key("fk", li, "l_suppkey", supplier, "s_suppkey") \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    inputs = _exchange_inputs(plan)
    child = [x for x in inputs if "l_suppkey" in x]
    assert child and all("partial_count" in x for x in child)


def test_hot_key_bucket_is_written_by_several_tasks(spark, tmp_out):
    from ledgerloom.session import unique_name
    from ledgerloom.sources import layout as lay
    li, n = _skewed_lines(spark)
    db = unique_name("skb")
    root = tmp_out(db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    t = lay.write_hash_partitions(li, f"{db}.li", "l_suppkey", 4, f"{root}/li")
    per_file = t.where("l_suppkey = 1").groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(per_file) > 1  # the hot key's bucket spans several files
    assert sum(r["count"] for r in per_file) == li.where("l_suppkey = 1").count()
    assert t.count() == n
