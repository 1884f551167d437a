"""Licence scan, collocations and spelling variants against brute force, with
nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import collocations, kd_tree, license_scan, quotient_filter, spelling

WORDS = ["alpha", "alphas", "alphb", "Beta", "betas", "gamma", "gama", "été", "étés", "ete", "of", "the"]
random.seed(11)
LICENSE = ["Licensed under CC BY-NC 4.0.", "All rights\nreserved", "GNU General Public License, version 3", "general public\tLICENSE",
           "GNU general public license version 2", "released under the MIT license", "Permission is hereby granted, free of charge"
           " to any person getting a copy of this software and associated documentation", "all rights were reserved", "cc by", "bY cc"]


def text(n):
    out = []
    for _ in range(n):
        out.append(random.choice(WORDS) if random.random() < 0.9 else random.choice([".", ",", "\n", "\t", "  ", "!?", "x\x0cy"]))
        if random.random() < 0.02:
            out.append(random.choice(LICENSE))
    return " ".join(out)


DOCS = [(i, text(random.randint(0, 120)), random.choice(["en", "de", None, "und"])) for i in range(60)]
DOCS += [(100, None, "en"), (101, "", "en"), (102, " \n\t.,", None), (None, text(50), "en"), (None, None, None), DOCS[0], DOCS[0],
         (103, "a" * 3000 + " " + "alpha beta " * 4000, "de"), (104, "×÷ ñandú ñandu " * 40, "es"), (105, "𐐀lpha étésİ ﬁn " * 9, "en"),
         (106, " ".join(LICENSE) * 3, "en"), (107, "public license", "en"), (108, "cc", "en")]


@pytest.fixture(scope="module")
def docs(spark):
    clash = {c: F.lit(7) for c in ("word", "n", "ws", "id", "f", "size", "shard", "matches", "n_words", "length", "leaf", "tile",
                                   "near", "form", "root", "rank", "phrase", "a", "cut", "at", "k")}
    return spark.createDataFrame(DOCS, "doc_id long, text string, lang string").repartition(3).withColumns(clash)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def phrase_brute(rows, least, top):
    f, n = Counter(), Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(t)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for s in range(1, 5):
                for i in range(len(ws) - s + 1):
                    f[lang, tuple(ws[i:i + s])] += 1
    out = {}
    often = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    for (lang, ws), a in often.items():
        score, k = min((2000000 * a // (f[lang, ws[:k]] + f[lang, ws[k:]]), k) for k in range(1, len(ws)))
        if any(o == lang and len(long) > len(ws) and 100 * b >= 80 * a and any(
                long[i:i + len(ws)] == ws for i in range(len(long) - len(ws) + 1)) for (o, long), b in often.items()):
            continue
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return sorted((lang, r, p.decode(), -a, l, rr, n[lang], -s) for lang, rows in out.items()
                  for r, (s, a, p, l, rr) in enumerate(sorted(rows)[:top], 1))


@pytest.mark.parametrize("least,top,bits", [(30, 2000, 26), (5, 10, 15), (3, 2000, 20)])
def test_collocations(spark, docs, least, top, bits):
    got = collocations.collocations(spark, docs, least, top, bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == phrase_brute(DOCS, least, top)


def test_collocations_without_rows(spark, docs):
    assert collocations.collocations(spark, docs.where("false")).collect() == []
    assert collocations.collocations(spark, docs.where("text is null")).collect() == []


def test_tokens_do_not_depend_on_the_chunk(monkeypatch):
    texts = [t.encode() for _, t, lang in DOCS if t]
    want = [w for p in collocations.tokens(texts) for w in p if w]
    for chunk in (1, 7, 100):
        monkeypatch.setattr(collocations, "CHUNK", chunk)
        assert [w for p in collocations.tokens(texts) for w in p if w.strip(b"\n")] == [w for w in want if w != b"\n"]


def test_chunks_and_full_filters_change_nothing(spark, docs):
    whole = collocations.phrase_counts(spark, docs, 3)[1]
    want = sorted((r.lang, tuple(r.ws), r.f) for r in whole.collect())
    few = docs.repartition(1)
    assert sorted((r.lang, tuple(r.ws), r.f) for r in collocations.phrase_counts(spark, few, 3)[1].collect()) == want


def test_ids_that_collide_take_another_seed(spark, docs, monkeypatch):
    seeds = []

    def vocabulary(spark, docs, seed, *cols):
        seeds.append(seed)
        return real(spark, docs, seed, *cols)
    real, check = collocations.vocabulary, collocations._distinct_ids
    monkeypatch.setattr(collocations, "vocabulary", vocabulary)
    monkeypatch.setattr(collocations, "_distinct_ids", lambda words: len(seeds) > 1 and check(words))
    got = collocations.collocations(spark, docs, 5, 10)
    assert seeds == [42, 43] and sorted(map(tuple, got.collect())) == phrase_brute(DOCS, 5, 10)


@pytest.mark.parametrize("size", [1, 2, 4])
@pytest.mark.parametrize("lead", [0, 3, 7])
def test_quotient_filter_is_lossless(size, lead):
    rng = np.random.default_rng(size)
    lanes = [rng.integers(0, 40, 9000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(size)]
    assert all((a == b).all() for a, b in zip(lanes, quotient_filter.restore(quotient_filter.permute(lanes))))
    counter, got = quotient_filter.Counter(size, pending=900, most=1500), Counter()
    for i in range(0, 9001, 500):
        full = counter.add([x[i:i + 500] for x in lanes])
        for row in counter.take(lead) if full or i == 9000 else ():
            stored = quotient_filter.unpack(size, row[1], row[0], lead, *row[2:])
            for *gram, n in zip(*quotient_filter.restore(stored[0]), stored[1]):
                got[tuple(map(int, gram))] += int(n)
    assert got == Counter(zip(*[map(int, x) for x in lanes]))


def test_quotient_filter_tells_equal_hashes_apart():
    same = np.array([5, 5, 5], dtype=np.uint64)
    lanes, counts = quotient_filter.merge([([same, np.array([2, 1, 2], dtype=np.uint64)], np.array([300, 1, 7]))])
    assert [x.tolist() for x in lanes] == [[5, 5], [1, 2]] and counts.tolist() == [1, 307]


def variants_brute(rows):
    n = Counter()
    for doc_id, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            n[w if h % 97 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    out, form = [], {}
    for w in n:
        others = [x for x in n if x != w and near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
        out.append([w, n[w], len(others), form[w], n[form[w]] if form[w] else None])
    for row in out:
        root = row[0]
        while form[root]:
            root = form[root]
        row.append(root)
    return sorted(map(tuple, out))


@pytest.fixture(scope="module")
def spellings():
    """Documents whose words come in long chains and crowds of variants."""
    rng = random.Random(3)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    rows = []
    for i in range(150):
        ws = []
        for _ in range(60):
            w = stems[min(int(rng.expovariate(0.12)), 59)]
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abÿ") + w[at:], w[:at] + rng.choice("abÿ") + w[at + 1:]])
            ws.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        rows.append((i, " ".join(ws), None))
    return rows


@pytest.mark.parametrize("cell,levels,sample", [(4096, 12, 40_000), (16, 3, 100), (8, 12, 1)])
def test_spelling_variants(spark, spellings, cell, levels, sample):
    rows = DOCS + spellings
    want = variants_brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = spelling.spelling_variants(spark, df, cell=cell, levels=levels, sample=sample)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert sorted(map(tuple, got.collect())) == want
    assert max(len(r[0]) for r in want) > 2000 or any(r[5] != r[3] for r in want if r[3])


def test_spelling_variants_of_little(spark, docs):
    assert spelling.spelling_variants(spark, docs.where("false")).collect() == []
    got = spelling.spelling_variants(spark, docs)
    assert sorted(map(tuple, got.collect())) == variants_brute(DOCS)


def test_runs_of_a_long_text_are_cut_between_words(monkeypatch):
    t = "abc défgh-ijk " * 50 + "x" * 400
    want = spelling.RUN.findall(t)
    monkeypatch.setattr(spelling, "CHUNK", 5)
    assert [w for part in spelling.runs(t) for w in part] == want


def test_box_search_reaches_every_word_one_edit_away():
    rng = random.Random(1)
    index = sorted({"".join(rng.choice("abc") for _ in range(7)) for _ in range(900)})
    for length in (6, 7):
        queries = sorted({"".join(rng.choice("abc") for _ in range(length)) for _ in range(300)})
        got = {(queries[i], index[j]) for a, b in kd_tree.near_rows(kd_tree.code_points(queries), kd_tree.code_points(index), 4, 50)
               for i, j in zip(a.tolist(), b.tolist())}
        want = {(q, x) for q in queries for x in index
                if (length == 7 and sum(c != d for c, d in zip(q, x)) == 1)
                or (length == 6 and any(x[:i] + x[i + 1:] == q for i in range(7)))}
        assert got == want


def licenses_brute(rows):
    out = []
    for doc_id, t, _ in rows:
        ws = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(t))
        found = []
        for tm in license_scan.default_templates():
            for s in range(len(ws) - len(tm.words) + 1):
                there = {j for j, w in enumerate(tm.words) if ws[s + j] == w}
                if len(there) >= tm.need and tm.must <= there:
                    found.append((tm.base, tm.label, s, len(there) / len(tm.words)))
        base = [x for x in found if x[0]]
        out.append((doc_id, len(ws), len(base), min((x[2] for x in base), default=None), max((x[2] for x in base), default=None),
                    ",".join(sorted({x[1] for x in base})), ",".join(sorted({x[1] for x in found})), max((x[3] for x in found), default=0.0)))
    return sorted(map(str, out))


def test_license_scan(spark, docs):
    got = license_scan.license_digest(spark, docs)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = licenses_brute(DOCS)
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert any("cc-by,cc-by-nc-4.0" in w for w in want) and any("mit" in w for w in want)
    assert license_scan.license_digest(spark, docs.where("false")).collect() == []


def test_license_places_across_the_pieces_of_a_text(monkeypatch):
    templates = license_scan.default_templates()
    index = license_scan.rare_word_index(templates, {})
    vocabulary = frozenset(w.encode() for t in templates for w in t.words)
    t = (" pad ".join(LICENSE) + " é ").encode() * 4
    whole = license_scan.places(t, templates, index, vocabulary)
    for chunk in (1, 13, 50):
        monkeypatch.setattr(license_scan, "CHUNK", chunk)
        assert license_scan.places(t, templates, index, vocabulary) == whole


def test_any_rarity_order_finds_the_same_places():
    templates = license_scan.default_templates()
    vocabulary = frozenset(w.encode() for t in templates for w in t.words)
    t = " ".join(LICENSE * 2).encode()
    want = license_scan.places(t, templates, license_scan.rare_word_index(templates, {}), vocabulary)
    for seed in range(5):
        rng = random.Random(seed)
        frequency = {w.decode(): rng.randrange(1000) for w in sorted(vocabulary)}
        index = license_scan.rare_word_index(templates, frequency)
        assert license_scan.places(t, templates, index, vocabulary) == want


@pytest.mark.parametrize("name", ["op11_license_scan", "op12_collocations", "op13_spelling"])
def test_twins_on_the_fixture(spark, docs, name):
    from ledgerloom.llm.queries import ORACLE

    own = {"op11_license_scan": license_scan.license_digest, "op12_collocations": collocations.collocations,
           "op13_spelling": spelling.spelling_variants}[name](spark, docs)
    con = duckdb.connect()
    documents = docs.select("doc_id", "text", "lang").toPandas().astype({"doc_id": "Int64"})  # noqa: F841
    con.register("documents", documents)
    got = con.sql(ORACLE[name])
    order = [got.columns.index(c) for c in own.columns]
    assert sorted(str(tuple(r[i] for i in order)) for r in got.fetchall()) == sorted(str(tuple(r)) for r in own.collect())
