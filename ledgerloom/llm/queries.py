"""One thin query per operator over its whole table, in the driver's form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (bpe, collocations, html_text, langid, license_scan, line_dedup, mixing, multi_index,
                            sharding, simhash, spelling, subspace_join, twins, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed_lines(spark, _read(spark, sf_dir, "documents"))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(spark, _read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, _read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark, _read(spark, sf_dir, "documents"))


@query
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(_read(spark, sf_dir, "pages"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(_read(spark, sf_dir, "documents"))


@query
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_join.near_duplicate_vectors(spark, _read(spark, sf_dir, "embeddings"))


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, archives = warc.convert_pages(spark, _read(spark, sf_dir, "pages"))
    return warc.read_warc(spark, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(_read(spark, sf_dir, "documents"))


@query
def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return multi_index.nearest_neighbours(spark, vectors, vectors.where("vec_id % 50 = 0"))


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_digest(spark, _read(spark, sf_dir, "documents"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, _read(spark, sf_dir, "documents"))


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spark, _read(spark, sf_dir, "documents"))


ORACLE["op13_spelling"] = twins.SPELLING

ORACLE["op11_license_scan"] = twins.licenses()

ORACLE["op12_collocations"] = twins.COLLOCATIONS

ORACLE["op8_warc"] = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS least FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.least < p.page_id OR (p.page_id IS NULL AND f.least IS NOT NULL)
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.least < p.page_id OR (p.page_id IS NULL AND f.least IS NOT NULL)
            THEN f.least END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

ORACLE["op7_embedding_dedup"] = """
WITH RECURSIVE ok AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
  SELECT a.r AS ar, b.r AS br, a.vec_id AS a, b.vec_id AS b
  FROM ok a JOIN ok b ON a.label = b.label AND a.r <> b.r
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach(a, b) AS (
  SELECT a, b FROM linked
  UNION
  SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a
), n AS (SELECT a AS vec_id, count(*) AS c FROM linked GROUP BY 1),
m AS (SELECT a AS vec_id, min(b) AS least FROM reach GROUP BY 1)
SELECT e.vec_id, CAST(coalesce(n.c, 0) AS BIGINT) AS n_links,
       least(e.vec_id, coalesce(m.least, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(m.least, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n USING (vec_id) LEFT JOIN m USING (vec_id)
"""
