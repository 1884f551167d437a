import pytest
from pyspark.sql import functions as F

from ledgerloom.session import unique_name
from ledgerloom.sources import catalog as cat
from ledgerloom.sources import layout as lay
from ledgerloom.sources import publish as pub

SF = "/root/testdata/sf0.001"


def test_like_semantics():
    assert cat.like_matches("customer_fk", "%_fk")
    assert cat.like_matches("xfk", "%_fk")  # underscore is a wildcard
    assert not cat.like_matches("xfk", "%\\_fk", escape="\\")


def test_list_partitions_keep_other_keys(spark, tmp_out):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("k", F.dayofmonth("ts"))
    path = tmp_out("lp")
    lay.write_list_partitions(ev.where("k <= 10"), path, "k")
    lay.write_list_partitions(ev.where("k > 5"), path, "k")
    assert spark.read.parquet(path).count() == ev.count()


def test_add_partitions_only_absent(spark, tmp_out):
    db = unique_name("parts")
    root = tmp_out(db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("k", F.dayofmonth("ts"))
    lay.create_partitioned_table(spark, ev, f"{db}.ev", f"{root}/ev", "k")
    lay.write_partition(ev.where("k = 1"), f"{db}.ev")
    keys = spark.range(1, 4).select(F.col("id").cast("int"))
    assert lay.add_partitions(spark, f"{db}.ev", "k", keys) == ["2", "3"]
    assert lay.add_partitions(spark, f"{db}.ev", "k", keys) == []
    assert spark.table(f"{db}.ev").count() == ev.where("k = 1").count()


def test_columnar_table_from_view(spark, tmp_out):
    db = unique_name("col")
    root = tmp_out(db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    o = spark.read.parquet(f"{SF}/orders.parquet")
    o.createOrReplaceTempView("orders_v_test")
    t = lay.create_columnar_table(spark, "orders_v_test", f"{db}.oc", f"{root}/oc")
    assert t.count() == 0 and t.columns == o.columns
    lay.append_rows(o, f"{db}.oc")
    assert spark.table(f"{db}.oc").count() == o.count()


def test_search_layout_prunes_row_groups(spark, tmp_out):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    path = tmp_out("sorted")
    lay.write_search_layout(li, path, column_names=["l_orderkey"], replace=True)
    back = spark.read.parquet(path)
    q = back.where("l_orderkey = 77")
    assert "PushedFilters: [IsNotNull(l_orderkey), EqualTo(l_orderkey,77)]" in \
        q._jdf.queryExecution().executedPlan().toString()
    assert q.count() == li.where("l_orderkey = 77").count()
    with pytest.raises(ValueError):
        lay.write_search_layout(li, path)
    with pytest.raises(Exception):
        lay.write_search_layout(li, tmp_out("u"), column_names=["l_orderkey"], unique=True)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    lay.write_search_layout(orders, tmp_out("p"), expression="o_orderkey * 10",
                            partial_condition="o_orderstatus = 'F'", unique=True, method="hash")


def test_fk_layout_columns(spark, tmp_out):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").withColumnsRenamed(
        {"l_orderkey": "order_fk", "l_suppkey": "supplier_fk"})
    assert lay.write_foreign_key_layout(li, tmp_out("fk"), excluded=["supplier_fk"]) == ["order_fk"]


def test_copy_and_publish(spark, tmp_out):
    src = unique_name("src")
    pub.create_database(spark, src, tmp_out(src))
    for t in ("region", "nation"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.option("path", f"{tmp_out(t)}").saveAsTable(f"{src}.{t}")
    spark.sql(f"CREATE VIEW {src}.not_copied AS SELECT 1 AS x")
    assert cat.copyable_tables(spark, src) == ["nation", "region"]
    live = unique_name("live")
    v1 = unique_name("v1")
    assert pub.copy_database(spark, src, v1, tmp_out(v1)) == ["nation", "region"]
    assert pub.publish(spark, live, v1, tmp_out(live)) is None
    assert spark.table(f"{live}.region").count() == 5
    v2 = unique_name("v2")
    pub.copy_database(spark, src, v2, tmp_out(v2), tables=["region"])
    assert pub.publish(spark, live, v2, tmp_out(live)) == v1
    assert not spark.catalog.databaseExists(v1)
    names = {t.name for t in spark.catalog.listTables(live) if not t.isTemporary}
    assert names == {"region"}


def test_analyze(spark, tmp_out):
    db = unique_name("st")
    root = tmp_out(db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    spark.read.parquet(f"{SF}/nation.parquet").write.option("path", f"{root}/n").saveAsTable(f"{db}.n")
    rows = {r.column_name: (r.null_count, r.row_count) for r in lay.analyze_table(spark, f"{db}.n").collect()}
    assert rows["n_name"] == (0, 25)


def test_buckets_one_file_each_and_join_without_shuffle(spark, tmp_out):
    db = unique_name("bk")
    root = tmp_out(db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    a = lay.write_hash_partitions(o, f"{db}.o", "o_orderkey", 8, f"{root}/o")
    b = lay.write_hash_partitions(li.withColumnRenamed("l_orderkey", "o_orderkey"), f"{db}.l", "o_orderkey", 8,
                                  f"{root}/l")
    files = a.select(F.input_file_name()).distinct().count()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 8 <= files <= 8 + tasks  # about one bucket per task, not tasks x buckets
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b, "o_orderkey")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == li.join(o, li.l_orderkey == o.o_orderkey).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_cluster_conf_scales_partitions():
    from ledgerloom.session import cluster_conf
    big = cluster_conf(100 * 1024**4, 8000)   # 100 TB on 1000 executors x 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    small = cluster_conf(10 * 1024**2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24


def test_add_partitions_normalises_key_spelling(spark, tmp_out):
    db = unique_name("parts2")
    root = tmp_out(db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("k", F.dayofmonth("ts"))
    lay.create_partitioned_table(spark, ev, f"{db}.ev", f"{root}/ev", "k")
    keys = spark.createDataFrame([("01",), ("1",), ("2",)], "k string")
    assert lay.add_partitions(spark, f"{db}.ev", "k", keys) == ["1", "2"]
