"""Cases found in review: full rewrites leave no stale partitions, a zero
quantity does not abort the rate queries, NULL timestamps are kept, and
partition keys with special characters register once."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import attributes as attr
from ledgerloom.operators import chunks as chk
from ledgerloom.plans.queries import REGISTRY
from ledgerloom.session import unique_name
from ledgerloom.sources import layout as lay


def test_attribute_rewrite_drops_gone_attributes(spark, tmp_out):
    path = tmp_out("attr_rewrite")
    first = spark.createDataFrame([("a", "x"), ("b", "y")], "c1 string, c2 string")
    attr.write_attributes(attr.attribute_counts(first), path)
    second = spark.createDataFrame([("a", None)], "c1 string, c2 string")
    attr.write_attributes(attr.attribute_counts(second), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("attribute", "value").collect()) == [("c1", "a")]


def test_chunk_rewrite_drops_gone_chunks(spark, tmp_out):
    path = tmp_out("chunk_rewrite")
    df = spark.range(20).withColumnRenamed("id", "k")
    chk.write_by_chunk(df, "k", path)
    chk.write_by_chunk(df.where("k % 7 = 0"), "k", path)
    assert spark.read.parquet(path).count() == 3


def test_catalog_attribute_table_rebuild_and_empty_partitioned_table(spark, tmp_out):
    db = unique_name("rebuild")
    root = tmp_out(db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    spark.createDataFrame([("a", "x")], "c1 string, c2 string").write.saveAsTable(f"{db}.t")
    attr.create_attributes_table(spark, f"{db}.t", path=f"{root}/t_attr")
    spark.sql(f"DROP TABLE {db}.t")
    spark.createDataFrame([("a", None)], "c1 string, c2 string").write.saveAsTable(f"{db}.t")
    name = attr.create_attributes_table(spark, f"{db}.t", path=f"{root}/t_attr")
    assert sorted(r.attribute for r in spark.table(name).collect()) == ["c1"]

    ev = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    lay.create_partitioned_table(spark, ev, f"{db}.p", f"{root}/p", "k")
    lay.write_partition(ev, f"{db}.p")
    assert lay.create_partitioned_table(spark, ev, f"{db}.p", f"{root}/p", "k").count() == 0


def _mini_dir(spark, tmp_out, tables: dict):
    d = tmp_out("mini")
    for name, df in tables.items():
        df.write.parquet(f"{d}/{name}.parquet")
    return d


def test_zero_quantity_gives_no_quote(spark, tmp_out):
    ts = dt.datetime(2020, 1, 1)
    li = spark.createDataFrame(
        [(1, 1, 7, 1, 0.0, 10.0, 0.0, 0.0, "N", "O", ts),
         (1, 1, 7, 2, 2.0, 10.0, 0.0, 0.0, "N", "O", ts + dt.timedelta(days=2))],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz")
    d = _mini_dir(spark, tmp_out, {"lineitem": li})
    rows = [tuple(r) for r in REGISTRY["rates_gap_fill"](spark, d).collect()]
    assert rows == [("7", 5.0, dt.date(2020, 1, 3))]


def test_events_without_timestamp_are_kept(spark, tmp_out):
    ts = dt.datetime(2024, 1, 1, 10)
    ev = spark.createDataFrame(
        [(1, ts, 1, "a", 1.0, "{}"), (2, None, 1, "a", 1.0, "{}"), (3, ts + dt.timedelta(days=3), 2, "b", 1.0, "{}")],
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    d = _mini_dir(spark, tmp_out, {"events": ev})
    got = sorted((r.day_key is None, r.row_count) for r in REGISTRY["list_partition_write"](spark, d).collect())
    assert got == [(False, 1), (False, 1), (True, 1)]


def test_partition_keys_with_special_characters(spark, tmp_out):
    db = unique_name("pk")
    root = tmp_out(db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    like = spark.createDataFrame([(1, "x")], "v int, k string")
    lay.create_partitioned_table(spark, like, f"{db}.t", f"{root}/t", "k")
    keys = spark.createDataFrame([("a/b",), ("o'k",)], "k string")
    assert lay.add_partitions(spark, f"{db}.t", "k", keys) == ["a/b", "o'k"]
    assert lay.add_partitions(spark, f"{db}.t", "k", keys) == []


def test_partition_loads_after_create_keep_each_other(spark, tmp_out):
    db = unique_name("loads")
    root = tmp_out(db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    ev = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    lay.create_partitioned_table(spark, ev, f"{db}.p", f"{root}/p", "k")
    lay.write_partition(ev.where("k = 'a'"), f"{db}.p")
    lay.write_partition(ev.where("k = 'b'"), f"{db}.p")
    assert sorted(tuple(r) for r in spark.table(f"{db}.p").collect()) == [(1, "a"), (2, "b")]


def test_duration_span_that_reaches_the_sentinel_keeps_the_real_row(spark):
    from ledgerloom.operators import timedim as td
    start = dt.date(2000, 1, 1)
    span = td.bounds(spark, start, start + dt.timedelta(days=30500), names=("start", "as_of"))
    rows = td.duration_dimension(span)
    assert rows.groupBy("duration_id").count().where("count > 1").count() == 0
    assert "before" not in list(rows.where("duration_id = -30000").first())


def test_enum_lists_skip_nulls_and_keep_long_labels(spark):
    from ledgerloom.operators import enums as en
    e = en.create_enum(["a", None, "b", "x" * 70, "x" * 71], spark=spark)
    assert sorted(tuple(r) for r in e.collect()) == [("a", 1), ("b", 2), ("x" * 70, 3), ("x" * 71, 4)]
    e2 = en.add_enum_values(e, ["c", None, "x" * 70])
    assert sorted(tuple(r) for r in e2.collect())[2:] == [("c", 5), ("x" * 70, 3), ("x" * 71, 4)]
    facts = spark.createDataFrame([("x" * 70,), ("x" * 72,)], "label string")
    assert [r.label for r in en.outside_enum(facts, "label", e2).collect()] == ["x" * 72]
    assert en.create_enum([None], spark=spark).count() == 0


def test_user_columns_are_not_replaced(spark, tmp_out):
    import pytest
    from ledgerloom.operators import chunks as chk, series as ser
    from ledgerloom.sources import layout as lay
    df = spark.createDataFrame([(1, 2, 3, {"a": 1})], "id long, chunk int, index_key int, m map<string,int>")
    with pytest.raises(ValueError):
        chk.write_by_chunk(df, "id", tmp_out("c"))
    chk.write_by_chunk(df, "id", tmp_out("c2"), out="part")
    with pytest.raises(ValueError):
        lay.write_search_layout(df, tmp_out("l"), expression="id + 1")
    with pytest.raises(ValueError):
        lay.write_search_layout(df, tmp_out("l"), column_names=["id"], analyze=True)
    path = tmp_out("l2")
    lay.write_search_layout(df, path, column_names=["id"], unique=True)
    assert spark.read.parquet(path).count() == 1
    fact = spark.createDataFrame([("A", 5.0, dt.date(2020, 1, 1))], "cur string, exchange_rate double, d date")
    rates = spark.createDataFrame([("A", 2.0, dt.date(2020, 1, 1))], "currency string, exchange_rate double, date date")
    with pytest.raises(ValueError):
        ser.attach_rate(fact, rates, "cur", "d")
    assert ser.attach_rate(fact, rates, "cur", "d", out="rate").first().rate == 2.0


def test_blank_rate_cells_and_dates_fail_loudly(spark):
    import pytest
    from ledgerloom.sources import rates_csv as rc
    wide = spark.createDataFrame([("2020-01-01", "1.5", ""), (" ", "N/A", "2")], "Date string, USD string, BGN string")
    assert sorted((tuple(r) for r in rc.blank_cells(wide).collect()), key=str) == [(" ", None), ("2020-01-01", "BGN")]
    for part in (wide.where("Date = '2020-01-01'"), wide.where("Date = ' '")):
        with pytest.raises(Exception, match="blank"):
            rc.melt_rates(part).collect()


def test_copy_keeps_partitions_and_buckets_and_refuses_itself(spark, tmp_out):
    import pytest
    from ledgerloom.sources import publish as pub
    src, dst = unique_name("src"), unique_name("dst")
    pub.create_database(spark, src, tmp_out(src))
    spark.range(20).selectExpr("id", "id % 3 AS p").write.partitionBy("p").saveAsTable(f"{src}.parts")
    spark.range(20).selectExpr("id", "id % 3 AS p").write.bucketBy(4, "id").sortBy("id").saveAsTable(f"{src}.buckets")
    with pytest.raises(ValueError):
        pub.copy_database(spark, src, src, tmp_out("x"))
    pub.copy_database(spark, src, dst, tmp_out(dst))
    for t in ("parts", "buckets"):
        assert pub.table_shape(spark, f"{dst}.{t}") == pub.table_shape(spark, f"{src}.{t}")
        assert spark.table(f"{dst}.{t}").count() == 20
    assert pub.table_shape(spark, f"{dst}.buckets")[2] == 4


def test_not_found_with_only_map_columns(spark):
    from ledgerloom.operators import checks as ck
    failing = spark.createDataFrame([({"a": 1},), ({"b": 2},)], "m map<string,int>")
    row = ck.check_not_found("nf", failing).first()
    assert row.passed is False and row.left_value == 2 and row.detail.count("\n") == 1


def test_publish_refuses_an_empty_version_and_analyze_handles_odd_columns(spark, tmp_out):
    import pytest
    from ledgerloom.sources import publish as pub
    empty = unique_name("empty")
    pub.create_database(spark, empty, tmp_out(empty))
    with pytest.raises(ValueError):
        pub.publish(spark, unique_name("live"), empty, tmp_out("live"))
    db = unique_name("odd")
    root = tmp_out(db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    spark.createDataFrame([(1, [1, 2], "x")], "`a b` int, arr array<int>, `select` string") \
        .write.option("path", f"{root}/t").saveAsTable(f"{db}.t")
    rows = {r.column_name: r.null_count for r in lay.analyze_table(spark, f"{db}.t").collect()}
    assert rows == {"a b": 0, "select": 0}


def test_fourth_review_cases(spark, tmp_out):
    import pytest
    from ledgerloom.functions.chunking import chunk_of_bigint
    from ledgerloom.sources.catalog import like_matches
    df = spark.createDataFrame([("x", "y", "z")], "`a.b` string, c string, `d``e` string")
    got = sorted(tuple(r) for r in attr.attribute_counts(df).collect())
    assert got == [("a.b", "x", 1), ("c", "y", 1), ("d`e", "z", 1)]
    maps = spark.createDataFrame([(1, {"a": 1}), (2, {"b": 2})], "k bigint, m map<string,int>")
    path = tmp_out("chunk_maps")
    chk.write_by_chunk(maps, "k", path)
    assert spark.read.parquet(path).count() == 2
    laid = spark.read.parquet(path)
    assert chk.select_chunk(laid, "k", 1, n=16).count() == 1  # computed from the key, not the stored column
    with pytest.raises(ValueError):
        chunk_of_bigint("k", 40000)
    with pytest.raises(ValueError):
        like_matches("abc", "abc\\", escape="\\")
