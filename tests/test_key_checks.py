"""Uniqueness in two passes, and failing rows in one."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks as ck
from tests.scans import bytes_exchanged, plain_plans


@pytest.fixture(scope="module")
def keyed(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, *"abcdefgh"]), rng.choice([None, 1, 2, 3]), i) for i in range(60)]
    rows += [(f"own {i}", i, i) for i in range(40)]
    return rows, spark.createDataFrame(rows, "`a.b` string, `c``d` int, v int").repartition(4)


def test_both_ways_find_the_same_keys(keyed):
    rows, df = keyed
    pairs = [r[:2] for r in rows]
    for cols, keys in ((["a.b", "c`d"], pairs), (["a.b"], [(r[0],) for r in rows])):
        offending = {k for k in keys if keys.count(k) > 1 or None in k}
        repeated = {k for k in keys if keys.count(k) > 1 and None not in k}
        for two_pass in (True, False, None):
            row = ck.check_primary_key("pk", df, columns=cols, two_pass=two_pass).first()
            assert (row.passed, row.left_value) == (not offending, len(offending))
            row = ck.check_unique("u", df, cols, two_pass=two_pass).first()
            assert (row.passed, row.left_value) == (not repeated, len(repeated))


def test_unique_keys_pass_both_ways(spark, keyed):
    _, df = keyed
    for two_pass in (True, False):
        assert ck.check_unique("u", df, ["a.b"], where="`a.b` LIKE 'own%'", two_pass=two_pass).first().passed is True
        assert ck.check_primary_key("pk", df.where("false"), columns=["a.b"], two_pass=two_pass).first().passed is True
        assert ck.check_unique("u", df, ["upper(`a.b`)"], two_pass=two_pass).first().passed is False


def test_a_clean_wide_key_moves_little(spark):
    df = spark.range(4000).select(F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).alias("k")).repartition(4)
    with plain_plans(spark):
        whole, hashes = (bytes_exchanged(ck._repeated(df, two_pass, False)) for two_pass in (False, True))
        base = bytes_exchanged(df)  # what dealing out the input costs either way
    # the hash pass reads the input again: its repartition counts twice
    assert hashes - 2 * base < (whole - base) / 5


def test_failing_rows_in_one_pass(spark, keyed):
    _, df = keyed
    n, lines = ck.failing_rows(df.where("v >= 10"), shown=3)
    assert n == df.where("v >= 10").count() and len(lines) == 3
    assert ck.failing_rows(df.where("v > 1000")) == (0, [])
    assert ck.failing_rows(df, order_by=["v"], shown=1)[1][0].endswith("v = 0")
    assert ck.failing_rows(spark.range(0)) == (0, [])
    grouped = df.groupBy("`c``d`").agg(F.count("*").alias("n"))
    assert ck.failing_rows(grouped)[0] == grouped.count()
    row = ck.check_not_found("nf", df.where("v >= 10"), shown=3)
    assert "FileScan" not in row._jdf.queryExecution().executedPlan().toString() and row.first().left_value == n


def test_failing_rows_read_the_table_once(spark, tmp_out):
    """The rows that the only job's scan reads are the table's, once."""
    path = tmp_out("once")
    spark.range(5000).write.parquet(path)
    acc = spark.sparkContext.accumulator(0)
    table = spark.read.parquet(path)

    def count(batches):
        for b in batches:
            acc.add(b.num_rows)
            yield b
    assert ck.failing_rows(table.mapInArrow(count, table.schema).where("id % 2 = 0"))[0] == 2500
    assert acc.value == 5000
