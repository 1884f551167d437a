"""What the multi-index looks at, and vectors of several lengths."""

import numpy as np
import pytest

from ledgerloom.llm import multi_index as mi


@pytest.fixture(scope="module")
def embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], dtype=float)
    return np.array([r["vec_id"] for r in rows]), x


def test_probes_return_under_three_tenths_of_the_rows_at_nine_tenths_recall(embeddings):
    ids, x = embeddings
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    mean, matrix = mi.learn_rotations(unit)
    codes = mi.codes_of(unit, mean, matrix)
    asked = np.flatnonzero(ids % 50 == 0)
    rows = np.arange(len(ids))
    found = list(mi.search_block(mi.BlockIndex(codes), ids, x, ids[asked], x[asked], codes[asked], 5, mi.RECALL, rows, rows[asked]))
    cosine = unit[asked] @ unit.T
    cosine[np.arange(len(asked)), asked] = -2
    want = np.argsort(-cosine, axis=1)[:, :5]
    recall = np.mean([len(set(got) & set(want[q])) / 5 for q, got, _, _ in found])
    probed = np.mean([n for *_, n in found]) / len(ids)
    assert len(found) == len(asked) and recall >= 0.9 and probed < 0.3, (recall, probed)


def test_near_for():
    assert mi.near_for(1.0, 32, 0.99) == 0
    assert mi.near_for(-1.0, 32, 0.99) == 16
    nears = [mi.near_for(c, 32, 0.9) for c in (0.95, 0.7, 0.4, 0.1)]
    assert nears == sorted(nears) and 0 <= nears[0] < nears[-1] < 8


def test_a_wide_probe_returns_all_rows():
    codes = np.random.default_rng(1).integers(0, 1 << 16, (50, 32), dtype=np.uint16)
    index = mi.BlockIndex(codes)
    assert index.probe(codes[0], mi.ALL_FROM).tolist() == list(range(50)) and 0 in index.probe(codes[0], 0)


def test_vectors_of_other_lengths_take_no_part(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8 if i % 3 else 5)]) for i in range(60)] + [(100, []), (101, None)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = mi.nearest_neighbours(spark, table, table).collect()
    long = {i for i in range(60) if i % 3}
    assert {r["query_id"] for r in got} == long and {r["vec_id"] for r in got} <= long and len(got) == 5 * len(long)
