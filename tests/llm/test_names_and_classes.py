"""Columns of any name through the pipeline's stages; the tokenizer's classes."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, line_dedup, simhash

#: Names that the stages use inside, and names that need quoting.
NAMES = ["_id", "_removed", "_parts", "_t", "_fp", "_root", "_row_fp", "row_fp", "_row", "row", "of", "parts", "removed", "id",
         "key", "fp", "root", "kept_fp", "least", "component_id", "line", "line_no", "k1", "k2", "p", "first", "n", "a.b", "x`y", "_copies"]


@pytest.fixture(scope="module")
def named(spark):
    texts = ["one two three four five six\nseven eight nine ten", "one two three four five six", "alone here", None, "", "twin twin twin",
             "twin twin twin", "seven eight nine ten\nnew words stand here"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, "alone here"), (2, "other text of the same id"), (None, "twin twin twin"),
                                                   (None, "no id at all, once"), (None, "no id at all, once")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df, df.withColumns({n: F.lit(f"kept {n}") for n in NAMES})


def check(plain, wide):
    assert wide.columns[2:] == NAMES
    rows = [tuple(r) for r in wide.collect()]
    assert all(r[2:] == tuple(f"kept {n}" for n in NAMES) for r in rows)
    assert sorted((r[:2] for r in rows), key=repr) == sorted(map(tuple, plain.collect()), key=repr) and rows


def test_line_dedup_keeps_columns_of_any_name(spark, named):
    check(*(line_dedup.drop_similar_lines(spark, df) for df in named))


def test_simhash_dedup_keeps_columns_of_any_name(spark, named):
    check(*(simhash.simhash_dedup(spark, df) for df in named))


def test_bpe_splits_as_the_tokenizer_around_later_letters():
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    later = [chr(c) for c in (0x16EB0, 0x18F8A, 0x558, 0x11DE0, 0x323B0, 0x3FC3F)]
    rng = random.Random(7)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}'s 1{c}b {c}" for c in later] + [f"a{c}'s 1{c}b {c}" for c in every[::41]]
    texts += ["".join(rng.choice([*"ab 's1\n", *later, rng.choice(every)]) for _ in range(25)) for _ in range(3000)]
    got = bpe.Coder(bpe.Bpe(bpe.default_path())).encode(texts)
    for t, (n, ids, _) in zip(texts, got):
        e = library.encode(t, add_special_tokens=False)
        assert ids == ",".join(map(str, e.ids)) and n == len(e.ids), repr(t)
