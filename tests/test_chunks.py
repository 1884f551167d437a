from pyspark.sql import functions as F

from ledgerloom.functions.chunking import chunk_of, chunk_of_bigint, chunk_of_text
from ledgerloom.operators import chunks as chk


def test_bigint_chunks(spark):
    df = spark.createDataFrame([(-15,), (None,), (14,), (7,)], "x bigint")
    got = [r[0] for r in df.select(chunk_of_bigint("x")).collect()]
    assert got == [1, 0, 0, 0]
    assert dict(df.select(chunk_of(df, "x")).dtypes)  # dispatch by type works


def test_text_chunk_signed_md5(spark):
    df = spark.createDataFrame([("abc",), (None,)], "x string")
    # md5('abc') starts 90015098: as signed 32-bit -1878962024, abs % 7 = 2
    assert [r[0] for r in df.select(chunk_of_text("x")).collect()] == [2, 0]
    assert df.select(chunk_of(df, "x").alias("c")).schema["c"].dataType.simpleString() == "smallint"


def test_chunk_range_property(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = docs.select(chunk_of_text("text", 5).alias("c")).agg(F.min("c"), F.max("c")).first()
    assert 0 <= got[0] <= got[1] < 5


def test_all_chunks_and_sizes(spark):
    assert [r.chunk for r in chk.all_chunks(spark).collect()] == list(range(7))
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    sizes = chk.chunk_sizes(orders, "o_orderkey").collect()
    assert len(sizes) == 7 and sum(r.row_count for r in sizes) == orders.count()


def test_select_chunk_prunes_layout(spark, tmp_out):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    path = tmp_out("by_chunk")
    chk.write_by_chunk(orders, "o_orderkey", path)
    laid = spark.read.parquet(path)
    one = chk.select_chunk(laid, "o_orderkey", 3, layout_column="chunk")
    assert "PartitionFilters: [isnotnull(chunk" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == chk.select_chunk(orders, "o_orderkey", 3).count()
