from pyspark.sql import functions as F

from ledgerloom.operators.attributes import (
    attribute_counts, autocomplete, similar_values, text_columns, write_attributes,
)


def test_docstring_example(spark):
    df = spark.createDataFrame([(1, "x", "i"), (2, "y", "i"), (3, "x", "i")], "a int, b string, c string")
    got = sorted(tuple(r) for r in attribute_counts(df).collect())
    assert got == [("b", "x", 2), ("b", "y", 1), ("c", "i", 3)]


def test_null_dropped_empty_kept(spark):
    df = spark.createDataFrame([("x",), (None,), ("",), ("",)], "b string")
    got = sorted(tuple(r) for r in attribute_counts(df).collect())
    assert got == [("b", "", 2), ("b", "x", 1)]


def test_no_text_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert text_columns(df) == []
    out = attribute_counts(df)
    assert out.columns == ["attribute", "value", "row_count"]
    assert out.count() == 0


def test_single_scan_plan(spark):
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    plan = attribute_counts(part)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan
    # only the text columns are read
    assert "p_size" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_partitioned_sink_and_lookup(spark, tmp_out):
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    path = tmp_out("attrs")
    write_attributes(attribute_counts(part), path)
    back = spark.read.parquet(path)
    assert sorted(r[0] for r in back.select("attribute").distinct().collect()) == ["p_brand", "p_name", "p_type"]
    top = autocomplete(back, "p_type", "me", k=3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "p_type" in plan
    rows = top.collect()
    assert rows[0]["value"] == "MEDIUM"
    pre = autocomplete(back, "p_name", "red", k=100, mode="prefix").collect()
    assert pre and all(r["value"].startswith("red") for r in pre)


def test_like_wildcards_are_literal(spark):
    df = spark.createDataFrame([("a_b",), ("axb",), ("50%",)], "v string")
    attrs = attribute_counts(df)
    assert [r.value for r in autocomplete(attrs, "v", "_").collect()] == ["a_b"]
    assert [r.value for r in autocomplete(attrs, "v", "%").collect()] == ["50%"]


def test_similarity_finds_typos(spark):
    df = spark.createDataFrame([("small gear",), ("small gear",), ("hot rod",), ("cold ring",)], "p string")
    rows = similar_values(attribute_counts(df), "p", "smal gere").collect()
    assert [r.value for r in rows] == ["small gear"]
    # word trigrams: "smal" has 5 ("  s"," sm","sma","mal","al "), "gere" 5; "small" 6, "gear" 5
    # shared: "  s"," sm","sma","mal","  g"," ge" = 6; union 10 + 11 - 6 = 15
    assert abs(rows[0].similarity - round(6 / 15, 6)) < 1e-9


def test_case_sensitive_prefix_is_pushed_down(spark, tmp_out):
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    path = tmp_out("attrs_cs")
    write_attributes(attribute_counts(part), path)
    q = autocomplete(spark.read.parquet(path), "p_name", "red", mode="prefix", case_sensitive=True)
    assert "StringStartsWith(value,red)" in q._jdf.queryExecution().executedPlan().toString()
    assert all(r.value.startswith("red") for r in q.collect())


def test_create_attributes_table_in_catalog(spark, tmp_out):
    from ledgerloom.operators.attributes import create_attributes_table
    from ledgerloom.session import unique_name
    db = unique_name("attrdb")
    root = tmp_out(db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}'")
    spark.read.parquet("/root/testdata/sf0.001/part.parquet").write.option("path", f"{root}/part") \
        .saveAsTable(f"{db}.part")
    name = create_attributes_table(spark, f"{db}.part")
    assert name == f"{db}.part_attributes"
    t = spark.table(name)
    assert set(t.columns) == {"attribute", "value", "row_count"}
    assert t.groupBy().sum("row_count").first()[0] == 3 * 200


def test_stored_trigrams_give_the_same_matches(spark, tmp_out):
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    attrs = attribute_counts(part)
    path = tmp_out("attrs_tri")
    write_attributes(attrs, path, with_trigrams=True)
    stored = spark.read.parquet(path)
    assert "value_trigrams" in stored.columns
    a = [tuple(r) for r in similar_values(stored, "p_name", "small gear").collect()]
    b = [tuple(r) for r in similar_values(attrs, "p_name", "small gear").collect()]
    assert a == b and len(a) == 10
