import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks as ck


def one(spark, v, t="bigint"):
    return spark.createDataFrame([(v,)], f"v {t}")


def passed(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]["passed"]


def test_equal(spark):
    assert passed(ck.check_equal("e", one(spark, 5), one(spark, 5))) is True
    assert passed(ck.check_equal("e", one(spark, 5), one(spark, 6))) is False


@pytest.mark.parametrize("l,r,exp", [(100, 109, True), (100, 110, False), (-100, -109, True), (0, 7, True)])
def test_almost_equal(spark, l, r, exp):
    assert passed(ck.check_almost_equal("a", 0.1, one(spark, l), one(spark, r))) is exp


def test_relations(spark):
    for rel, exp in [("<", True), ("<=", True), (">", False), (">=", False), ("!=", True), ("<>", True), ("=", False)]:
        assert passed(ck.check_relation("r", one(spark, 1), one(spark, 2), rel)) is exp
    with pytest.raises(ValueError):
        ck.check_relation("r", one(spark, 1), one(spark, 2), "like")


def test_boolean_null_does_not_fail(spark):
    res = ck.check_true("b", one(spark, None, "boolean"))
    assert passed(res) is None
    ck.enforce(res)  # no raise
    with pytest.raises(ck.CheckFailed):
        ck.enforce(res, strict=True)
    empty = spark.createDataFrame([], "v boolean")
    assert passed(ck.check_true("b", empty)) is None


def test_relation_with_null_fails(spark):
    res = ck.check_relation("r", one(spark, None), one(spark, 1), "=")
    row = res.first()
    assert row.passed is False and row.detail.startswith("NULL operand")
    with pytest.raises(ck.CheckFailed):
        ck.enforce(res)


def test_more_than_one_row_raises(spark):
    two = spark.createDataFrame([(1,), (2,)], "v bigint")
    with pytest.raises(Exception):
        ck.check_equal("e", two, one(spark, 1)).collect()


def test_arrays(spark):
    a = spark.createDataFrame([([1.0, 2.0, 3.0],)], "v array<double>")
    b = spark.createDataFrame([([1.0, 2.5, 3.0],)], "v array<double>")
    c = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    assert passed(ck.check_almost_equal_array("x", a, b, 0.1)) is False
    assert passed(ck.check_almost_equal_array("x", a, c, 0.1)) is True
    # a difference equal to delta passes (strict >)
    assert passed(ck.check_almost_equal_array("x", a, b, 0.5)) is True


def test_not_found_message(spark):
    failing = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    row = ck.check_not_found("nf", failing).first()
    assert row.passed is False and row.left_value == 2
    assert row.detail == "a = 1, b = null\na = 2, b = x"
    ok = ck.check_not_found("nf", failing.where("a > 5")).first()
    assert ok.passed is True and ok.detail is None
    many = spark.range(100).withColumnRenamed("id", "k")
    assert len(ck.check_not_found("nf", many).first().detail.split("\n")) == 20


@pytest.fixture()
def star(spark):
    foo = spark.createDataFrame([(1,), (2,), (3,)], "foo_id bigint")
    bar = spark.createDataFrame(
        [(1, 1, 10.0), (2, 2, -1.0), (2, 3, None), (None, None, 5.0), (5, 9, 1.0)],
        "bar_id bigint, foo_fk bigint, amount double")
    return foo, bar


def test_keys(spark, star):
    foo, bar = star
    assert passed(ck.check_primary_key("pk", foo, "foo")) is True
    pk = ck.check_primary_key("pk", bar, "bar").first()
    assert pk.passed is False and pk.left_value == 2  # id 2 twice, one NULL id
    fk = ck.check_foreign_key_by_name("fk", bar, foo, "foo").first()
    assert fk.passed is False and fk.left_value == 1 and fk.right_value == 1  # orphan 9; NULL passes
    checks = ck.check_expressions(bar, {"amount_positive": "amount > 0", "id_set": F.col("bar_id").isNotNull()})
    got = {r.check_name: (r.passed, r.left_value) for r in checks.collect()}
    assert got == {"amount_positive": (False, 1.0), "id_set": (False, 1.0)}  # NULL amount passes
    uq = ck.check_unique("u", bar, ["bar_id"]).first()
    assert uq.left_value == 1  # NULL key exempt
    assert passed(ck.check_unique("u", bar, ["bar_id"], where="amount > 0")) is True


def test_expression_checks_share_one_scan(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    plan = ck.check_expressions(li, {"a": "l_quantity > 0", "b": "l_tax <= l_discount"}) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_enforce_lists_failures(spark):
    res = ck.report(ck.check_equal("good", one(spark, 1), one(spark, 1)),
                    ck.check_equal("bad", one(spark, 1), one(spark, 2)))
    with pytest.raises(ck.CheckFailed, match="bad"):
        ck.enforce(res)


def test_aggregate_checks_share_one_scan(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    res = ck.check_aggregates(li, {
        "qty_positive": F.min("l_quantity") > 0,
        "disc_le_tenth": (F.max("l_discount"), "<=", F.lit(0.1)),
        "net_close": ("almost", 0.1, F.sum("l_extendedprice"),
                      F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))),
        "null_bool": F.max(F.lit(None).cast("boolean")),
    })
    assert res._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {r.check_name: r.passed for r in res.collect()}
    assert got == {"qty_positive": True, "disc_le_tenth": True, "net_close": True, "null_bool": None}


def test_not_found_with_map_column_and_empty_report(spark):
    failing = spark.createDataFrame([(1, {"a": "b"})], "k int, m map<string,string>")
    row = ck.check_not_found("nf", failing).first()
    assert row.passed is False and row.detail.startswith("k = 1, m = ")
    with pytest.raises(ValueError):
        ck.report()


def test_every_check_kind_can_fail(spark):
    assert passed(ck.check_true("b", one(spark, False, "boolean"))) is False
    df = spark.createDataFrame([(1, 10.0), (2, -1.0)], "k int, v double")
    res = {r.check_name: r.passed for r in ck.check_aggregates(df, {
        "positive": F.min("v") > 0,
        "sum_le": (F.sum("v"), "<=", F.lit(5.0)),
        "close": ("almost", 0.01, F.max("v"), F.sum("v")),
        "null_operand": (F.max(F.lit(None).cast("double")), "=", F.lit(1.0)),
    }).collect()}
    assert res == {"positive": False, "sum_le": False, "close": False, "null_operand": False}
    with pytest.raises(ck.CheckFailed, match="positive"):
        ck.enforce(ck.check_aggregates(df, {"positive": F.min("v") > 0}))


def test_sql_texts_are_run_and_quoted_in_the_detail(spark):
    spark.range(3).createOrReplaceTempView("three_ids")
    count = "SELECT count(*) FROM three_ids"
    made = ck.report(
        ck.check_true("t", "SELECT min(id) > 0 FROM three_ids", "ids are positive"),
        ck.check_equal("eq", count, "SELECT 4"),
        ck.check_at_most("le", count, spark.range(1).select(F.lit(9))),
        ck.check_almost_equal("near", 0.1, count, "SELECT 3.1"),
        ck.check_not_found("nf", "SELECT id FROM three_ids WHERE id > 1"),
        ck.check_almost_equal_array("arr", "SELECT array(1, 2)", "SELECT array(1, 3)", 0.5))
    rows = {r["check_name"]: r for r in made.collect()}
    assert {k: r["passed"] for k, r in rows.items()} == {
        "t": False, "eq": False, "le": True, "near": True, "nf": False, "arr": False}
    assert rows["t"]["detail"] == "ids are positive\nquery: SELECT min(id) > 0 FROM three_ids"
    assert rows["eq"]["detail"] == f"left = right\nleft: {count}\nright: SELECT 4"
    assert rows["le"]["detail"] == f"left <= right\nleft: {count}"
    assert rows["nf"]["detail"] == "query: SELECT id FROM three_ids WHERE id > 1\nid = 2"
    with pytest.raises(ck.CheckFailed, match="SELECT 4"):
        ck.enforce(made)
