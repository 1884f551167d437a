"""What the layouts save a reader: row groups skipped, exchanges left out."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans.queries import REGISTRY
from ledgerloom.session import unique_name
from ledgerloom.sources import layout as lay
from tests.scans import plain_plans, rows_read

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet(f"{SF01}/lineitem.parquet").withColumnsRenamed(
        {"l_orderkey": "order_fk", "l_partkey": "part_fk", "l_suppkey": "supplier_fk"})


def share_of_files(df, column, key):
    """The share of files whose range of ``column`` holds ``key``."""
    ranges = df.groupBy(F.col("_metadata.file_path")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return ranges.agg(F.avg(F.lit(key).between(F.col("low"), F.col("high")).cast("int"))).first()[0]


def test_space_filling_key_skips_on_every_foreign_key(spark, lines, tmp_out):
    path, first = tmp_out("z"), tmp_out("first")
    assert lay.write_foreign_key_layout(lines, path, files=64) == ["order_fk", "part_fk", "supplier_fk"]
    lines.repartitionByRange(64, "order_fk").sortWithinPartitions("order_fk").write.parquet(first)
    back, by_first = spark.read.parquet(path), spark.read.parquet(first)
    for c in ("order_fk", "part_fk", "supplier_fk"):
        for q in (0.2, 0.5, 0.8):
            key = lines.select(F.percentile_approx(c, q)).first()[0]
            assert share_of_files(back, c, key) < 0.7
            if c != "order_fk":  # sorted by the first key alone, the others skip nothing
                assert share_of_files(by_first, c, key) > 0.95
        found = back.where(F.col(c) == key)
        assert rows_read(found) < 60_000 and found.count() == lines.where(F.col(c) == key).count()


def test_interleaved_key_of_texts_nulls_and_hot_values(spark, tmp_out):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("a_fk"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 50).alias("b.c_fk"), F.lit(1).alias("_place"))
    path = tmp_out("odd")
    assert lay.write_foreign_key_layout(df, path) == ["a_fk", "b.c_fk"]
    back = spark.read.parquet(path)
    assert back.columns == df.columns and back.exceptAll(df).count() == 0 and back.count() == 4000
    key = lay.interleaved_key(df, ["a_fk", "b.c_fk"])
    spread = df.select(key.alias("z")).agg(F.count_distinct("z"), F.min("z")).first()
    assert spread[0] > 100 and spread[1] >= 0
    assert lay.write_foreign_key_layout(df, tmp_out("one"), excluded=["a_fk"]) == ["b.c_fk"]
    assert lay.write_foreign_key_layout(df.select("_place"), tmp_out("none")) == []
    assert lay.write_foreign_key_layout(df.where("false"), tmp_out("empty")) == ["a_fk", "b.c_fk"]
    with pytest.raises(ValueError, match="method"):
        lay.write_foreign_key_layout(df, tmp_out("m"), method="gin")


def test_bloom_filters_are_sized_and_skip(spark, tmp_out):
    df = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.col("id").alias("v"))
    options = lay.bloom_options(df, ["k", "v"])
    assert options["parquet.bloom.filter.enabled#k"] == "true"
    assert abs(int(options["parquet.bloom.filter.expected.ndv#k"]) - 20_000) < 2000
    assert int(options["parquet.bloom.filter.max.bytes"]) >= 1 << 20
    assert lay.bloom_options(df, []) == {}
    path = tmp_out("bloom")
    lay.write_search_layout(df.repartition(8), path, column_names=["k"], method="hash", replace=True)
    back = spark.read.parquet(path)
    there = back.select("k").first()["k"]
    assert 0 < rows_read(back.where(F.col("k") == there)) <= 5000
    assert rows_read(back.where(F.col("k") == there[:-1] + "g")) == 0
    assert lay.write_foreign_key_layout(df.withColumnRenamed("k", "k_fk"), tmp_out("bf"), method="hash") == ["k_fk"]


def test_bucket_count_follows_bytes(spark, tmp_out):
    path = tmp_out("bytes")
    spark.range(100_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    size = lay.planned_bytes(df)
    assert size > 1_000_000
    assert lay.bucket_count(df) == 1
    assert lay.bucket_count(df, bucket_bytes=size // 5) == 8
    assert lay.bucket_count(df, df.limit(1), bucket_bytes=size // 5) == 8
    assert lay.bucket_count(df, bucket_bytes=1) <= lay.MOST_BUCKETS


def test_co_bucketed_join_has_no_exchange(spark):
    with plain_plans(spark):
        plan = REGISTRY["bucketed_join"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount" in plan


def test_default_bucket_count(spark, lines, tmp_out):
    db = unique_name("buckets")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_out(db)}'")
    table = lay.write_hash_partitions(lines, f"{db}.t", "order_fk", None, tmp_out("t"))
    assert table.count() == lines.count()


def test_day_filter_prunes_partitions_while_the_query_runs(spark):
    plan = REGISTRY["list_partition_pruned_join"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


@pytest.mark.parametrize("method", ["btree", "brin"])
def test_sorted_layouts_skip(spark, lines, tmp_out, method):
    path = tmp_out(method)
    lay.write_search_layout(lines.repartition(16), path, column_names=["part_fk"], method=method, replace=True)
    back = spark.read.parquet(path)
    n = back.select(F.col("_metadata.file_path")).distinct().count()
    if n > 1:
        assert rows_read(back.where("part_fk = 77")) < 60_000
    assert back.where("part_fk = 77").count() == lines.where("part_fk = 77").count()


def test_unique_layout_on_a_dotted_name(spark, tmp_out):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "`a.b` int, c string")
    lay.write_search_layout(df, tmp_out("dotted"), column_names=["a.b"], unique=True, replace=True)


def test_absent_partitions_come_in_order_and_batches(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(lay, "PARTITIONS_PER_STATEMENT", 3)
    db = unique_name("batches")
    root = tmp_out(db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    lay.create_partitioned_table(spark, spark.createDataFrame([], "v int, k string"), f"{db}.t", f"{root}/t", "k")
    keys = spark.createDataFrame([(k,) for k in "hgfedcba"], "k string")
    assert lay.add_partitions(spark, f"{db}.t", "k", keys) == list("abcdefgh")
    assert spark.sql(f"SHOW PARTITIONS {db}.t").count() == 8
