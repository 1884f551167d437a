"""Lookups in the stored postings against the lookups that score every value."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import attributes as attr
from ledgerloom.operators import gram_index as gi
from tests.scans import plain_plans, rows_read


@pytest.fixture(scope="module")
def stored(spark):
    from ledgerloom.session import scratch_path
    rng = random.Random(2)
    words = ["small", "smart", "gear", "Gear", "rim", "100%", "a_b", "c\\d", "été", "ÉTÉ", "𐐀x", "x", "", " "]
    values = {" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(300)} | {"", "%", "_", "it's"}
    rows = [("name", v, rng.randint(1, 40)) for v in sorted(values)] + [("other", "small gear", 5), ("na/me", "gear", 1),
                                                                       ("name", None, 9), (None, "gear", 9)]
    df = spark.createDataFrame(rows, "attribute string, value string, row_count long")
    path = scratch_path(spark, "grams")
    gi.write_gram_index(df, path, kept=15)
    return df, path


@pytest.mark.parametrize("typed", ["", "s", "sm", "sma", "gear", "GEAR rim", "0%", "%", "_", "a_b", "c\\d", "Été", "it's", "zz", "zzzz",
                                   "𐐀", "l g", "  "])
@pytest.mark.parametrize("mode", ["substring", "prefix"])
def test_autocomplete(spark, stored, typed, mode):
    df, path = stored
    for k in (3, 60):
        want = attr.autocomplete(df, "name", typed, k, mode).collect()
        got = gi.indexed_autocomplete(spark, path, "name", typed, k, mode, kept=15).collect()
        assert got == want


@pytest.mark.parametrize("typed", ["small gear", "Smart", "x", "", "!!", "été gear rim", "zzz", "gear gear small rim 100"])
def test_similarity(spark, stored, typed):
    df, path = stored
    for threshold in (0.05, 0.3, 0.7, 1.0):
        want = attr.similar_values(df, "name", typed, 200, threshold).collect()
        assert gi.indexed_similar_values(spark, path, "name", typed, 200, threshold).collect() == want


def test_other_attributes_and_wrong_arguments(spark, stored):
    _, path = stored
    assert [r.value for r in gi.indexed_autocomplete(spark, path, "na/me", "gea").collect()] == ["gear"]
    assert gi.indexed_autocomplete(spark, path, "absent", "gear").collect() == []
    assert gi.indexed_similar_values(spark, path, "absent", "gear").collect() == []
    with pytest.raises(ValueError, match="mode"):
        gi.indexed_autocomplete(spark, path, "name", "x", mode="suffix")
    with pytest.raises(ValueError, match="threshold"):
        gi.indexed_similar_values(spark, path, "name", "x", threshold=0)


def test_asked_grams():
    sizes = {"a": 5, "b": 1, "c": 9}
    assert gi.asked_grams(sizes, ["a", "b", "c"], 1.0) == (["b"], 3, 3)
    assert gi.asked_grams(sizes, ["a", "b", "c", "d"], 0.5) == (["b", "a"], 2, 8)
    assert gi.asked_grams({}, ["a"], 0.3) == ([], 1, 3)


def test_rows_read_stay_flat_as_values_grow(spark):
    """Ten times the values: the lookups read what the asked grams have."""
    from ledgerloom.session import scratch_path

    def read(n):
        noise = spark.range(n).select(F.lit("name").alias("attribute"), F.concat(
            F.lit("v"), F.translate(F.md5(F.col("id").cast("string")), "abcdef", "mnopqr")).alias("value"), F.lit(1).cast("long").alias("row_count"))
        some = spark.createDataFrame([("name", f"small gear {i}", 7) for i in range(5)], noise.schema)
        path = scratch_path(spark, "flat")
        gi.write_gram_index(noise.unionByName(some), path, block=1 << 16)
        with plain_plans(spark):
            assert gi.indexed_autocomplete(spark, path, "name", "gear", 10).count() == 5
            return (rows_read(gi.indexed_autocomplete(spark, path, "name", "gear", 10)),
                    rows_read(gi.indexed_similar_values(spark, path, "name", "small gear", 10)),
                    rows_read(gi.indexed_autocomplete(spark, path, "name", "v", 10)),
                    spark.read.parquet(f"{path}/parts").count())
    few, many = read(2000), read(20_000)
    assert many[3] > 8 * few[3]
    for a, b in zip(few[:3], many[:3]):
        assert b <= 2 * a + 4000 and b < many[3] / 40
