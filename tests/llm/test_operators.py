"""Every operator against a brute-force version, with nulls, empty and long
texts, ties, repeated rows, empty tables and extra columns."""

import functools
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import (bpe, html_text, langid, line_dedup, mixing, multi_index, sharding, simhash,
                            subspace_join, warc)
from ledgerloom.llm.graph import components

random.seed(5)
VOCABULARY = ["w%d" % i for i in range(60)]


def sentence(n):
    return " ".join(random.choice(VOCABULARY) for _ in range(n))


@functools.cache
def documents():
    """Rows (doc_id, text, lang, source, n_chars), awkward ones included."""
    base = [sentence(random.randint(3, 40)) for _ in range(30)]
    texts = [*base, *base[:10], *[t + " extra" for t in base[5:12]], "\n".join(base[:3]), "a\n\nb\n a  b \tc\n",
             "", None, "   ", "\n", "one", "one two", "One TWO", "É é ß ñ", sentence(30_000),
             base[0] + "\n" + base[1] + " more", None, ""]
    rows = [(i, t, "en" if i % 2 else "fr", None if i % 7 == 0 else f"src{i % 4}", 0) for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[3], (None, "one two three four", None, "src1", None), (None, None, None, None, None),
            (None, base[2], "en", "src2", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long").withColumns(
        {"fp": F.lit(1), "size": F.lit("x"), "shard": F.lit(2), "_copies": F.lit(0)})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def least_roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


# -- 1 line dedup

def brute_lines(rows):
    """doc_id -> removed line numbers, comparing every line with every earlier one."""
    named = {i: t for i, t, *_ in rows if i is not None and t is not None}
    seen, out = [], {}
    for i in sorted(named):
        out[i] = []
        for n, line in enumerate(named[i].split("\n")):
            words = {w for w in line.replace("\t", " ").split(" ") if w}
            if words and any(5 * len(words & x) >= 4 * len(words | x) for x in seen):
                out[i].append(n)
            if words:
                seen.append(words)
    return out


def test_line_dedup_is_the_brute_force_result(spark, docs):
    got = {r["doc_id"]: r for r in line_dedup.removed_lines(spark, docs).collect()}
    want = brute_lines(documents())
    for i, removed in want.items():
        assert got[i]["removed"] == removed, i
        assert got[i]["n_removed"] == len(removed)
    assert got[next(r[0] for r in documents() if r[1] is None)]["n_lines"] == 0
    assert None in got and len(got) == len({r[0] for r in documents()})


def test_line_dedup_of_crowds_of_near_copies(spark):
    rng = random.Random(9)
    rows = []
    for length, edits in ((150, 4), (150, 16), (30, 2), (6, 1)):
        base = [f"b{length}x{edits}x{i}" for i in range(length)]
        for _ in range(30):
            words = list(base)
            for at in rng.sample(range(length), edits):
                words[at] = "z%d" % rng.randrange(500)
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["removed"] for r in line_dedup.removed_lines(spark, table).collect()}
    want = brute_lines(rows)
    assert got == want and sum(map(len, want.values())) > 50


def test_pairs_of_a_crowd_grow_with_its_lines(spark, monkeypatch):
    """Copies whose rarest words are their own changes find their crowd without a join of all with all."""
    rng = random.Random(4)
    rows = []
    for i in range(240):
        words = [f"t{k}" for k in range(60)]
        for at in rng.sample(range(60), 3):
            words[at] = "own%d" % rng.randrange(10**9)
        rows.append((i, " ".join(words)))
    made = Counter()
    stored = line_dedup.stored

    def counting(spark, df, name):
        made[name] += (got := stored(spark, df, name)).count()
        return got

    monkeypatch.setattr(line_dedup, "stored", counting)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["removed"] for r in line_dedup.removed_lines(spark, docs).collect()}
    want = brute_lines(rows)
    assert got == want and sum(map(len, want.values())) > 100
    assert made["hubs"] <= 3 * len(rows) and made["crowd"] <= line_dedup.TRIES * len(rows)
    assert made["candidates"] <= 5 * len(rows)


def test_line_dedup_drops_lines_and_emptied_documents(spark, docs, none):
    kept = {r["doc_id"]: r["text"] for r in line_dedup.drop_similar_lines(spark, docs).collect() if r["doc_id"] is not None}
    rows = {r[0]: r[1] for r in documents() if r[0] is not None}
    for i, removed in brute_lines(documents()).items():
        left = "\n".join(x for n, x in enumerate(rows[i].split("\n")) if n not in removed)
        if removed and not left.split():
            assert i not in kept
        else:
            assert kept[i] == left
    assert line_dedup.drop_similar_lines(spark, none).columns == docs.columns
    assert line_dedup.removed_lines(spark, none).count() == 0


def test_line_dedup_stays_in_dataframe_operations(spark, docs):
    plan = line_dedup.removed_lines(spark, docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_long_lines_that_share_a_rare_word_do_not_meet(spark):
    """The join's rows grow with similar lines, not with the square of the lines that share a rare word."""
    rng = random.Random(3)
    rows = [(i, " ".join(["shared%d" % (i % 2), *("w%d" % rng.randrange(10**9) for _ in range(149))])) for i in range(200)]
    rows += [(1000 + i, t + " more") for i, t in rows[:20]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = line_dedup.stored(spark, line_dedup.line_table(docs), "lines")
    none = spark.createDataFrame([], "l long")
    met = line_dedup.meetings(table, none).collect()
    assert 40 <= len(met) and len({(r["l"], r["e"]) for r in met}) <= 30
    assert line_dedup.candidate_pairs(table, none).count() == 20
    assert sum(r["n_removed"] for r in line_dedup.removed_lines(spark, docs).collect()) == 20


# -- 2 SimHash

def brute_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_golay_spheres_fill_the_space():
    table = simhash.error_table()
    words = np.random.default_rng(0).integers(0, 1 << 23, 3000)
    index = simhash.codeword_index(words, table)
    assert (simhash._syndromes(words ^ table[simhash._syndromes(words)]) == 0).all()
    near = np.stack([simhash.codeword_index(words ^ (1 << b), table) for b in range(23)], axis=1)
    sizes = {len(set(r) | {i}) for r, i in zip(near.tolist(), index.tolist())}
    assert sizes == {1, 6}


def test_golay_keys_find_every_pair_within_two_bits(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    fps = set(base.tolist())
    for f in base.tolist():
        for n in (1, 2, 2, 3):
            fps.add(f ^ sum(1 << int(b) for b in rng.choice(64, n, replace=False)))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2}
    got = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    assert {(r["u"], r["v"]) for r in got} == want and len(got) == len(want)


def test_simhash_groups(spark, docs, none):
    rows = documents()
    fp = {t: brute_fingerprint(t) for _, t, *_ in rows}
    links = [(a, b) for a in fp.values() for b in fp.values() if bin(a ^ b).count("1") <= 2]
    root = least_roots(set(fp.values()), links)
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[root[fp[t]]] = min(i, least.get(root[fp[t]], i))
    want = Counter((i, fp[t], least.get(root[fp[t]])) for i, t, *_ in rows)
    got = Counter((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"])
                  for r in simhash.simhash_groups(spark, docs).collect())
    assert got == want
    kept = simhash.simhash_dedup(spark, docs)
    assert kept.columns == docs.columns
    nameless = {root[fp[t]] for _, t, *_ in rows} - set(least)  # groups without any id keep one row
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([*set(least.values()), *[None] * len(nameless)])
    assert simhash.simhash_groups(spark, none).count() == 0 and simhash.simhash_dedup(spark, none).count() == 0


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(260, 200), (5, 5)]
    want = {n: r for n, r in least_roots({n for e in links for n in e}, links).items() if n != r}
    got = components(spark, spark.createDataFrame(links, "u long, v long"))
    assert {r["node"]: r["root"] for r in got.collect()} == want


# -- 3 mixing

def test_simhash_dedup_of_rows_that_share_an_id(spark):
    draw = random.Random(3)
    a, b, c = (" ".join(draw.choice(VOCABULARY) + draw.choice("abcdefgh") for _ in range(60)) for _ in range(3))
    rows = [(1, a), (1, b), (1, b), (2, a), (3, b), (4, c)]
    kept = simhash.simhash_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect())) == sorted([(1, a), (1, b), (4, c)])


def test_fit_counts_closes_the_budget():
    rng = np.random.default_rng(3)
    for _ in range(30):
        sizes = np.unique(rng.integers(1, 400, 40))
        counts = rng.integers(1, 9, len(sizes))
        budget = int(rng.integers(0, (sizes * counts).sum() + 5))
        chosen = mixing.fit_counts(sizes, counts, budget)
        assert (chosen >= 0).all() and (chosen <= counts).all()
        assert abs(int((sizes * chosen).sum()) - budget) <= max(1, budget - int((sizes * counts).sum()))


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    held, target = set(), {}
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in held)
        free = sum(weight[s] for s in names if s not in held)
        target = {s: 3.0 * sizes[s] if s in held else left * weight[s] / free for s in names}
        over = {s for s in names if s not in held and target[s] > 3 * sizes[s]}
        if not over:
            return target
        held |= over


def test_mixing(spark, docs, none):
    got = mixing.mix(spark, docs).collect()
    rows = documents()
    sizes = defaultdict(int)
    for _, t, _, s, _ in rows:
        sizes[s] += len((t or "").encode().split())
    target = brute_targets(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    assert all(abs(taken[s] - target[s]) <= 31_000 for s in target)
    again = mixing.mix(spark, docs.repartition(3)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    mixed = mixing.mixed_documents(spark, docs)
    assert mixed.columns == docs.columns
    assert mixed.select(F.sum(mixing.n_words())).first()[0] == sum(taken.values())
    assert mixing.mix(spark, none).count() == 0 and mixing.mixed_documents(spark, none).count() == 0


# -- 4 sharding

def test_sharding_is_balanced_and_gapless(spark, docs, none):
    rows = documents()
    got = sharding.shard_documents(spark, docs, shards=5).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(5)]
    assert max(counts) - min(counts) <= 1
    again = sharding.shard_documents(spark, docs.repartition(7), shards=5).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert sharding.shard_documents(spark, none).count() == 0


def test_sharding_of_one_row_repeated(spark):
    rows = spark.range(1000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    got = sharding.shard_documents(spark, rows, shards=7).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [142] + [143] * 6


def test_overflow_walks_clockwise():
    assert sharding.walk([0, 1, 0], [5, 0, 1], [3, 3]) == [(0, 0, 3, 0, 0), (0, 3, 2, 1, 0), (2, 0, 1, 1, 2)]


def test_one_more_shard_moves_few_rows(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    a = {r["doc_id"]: r["shard"] for r in sharding.shard_documents(spark, rows, shards=8).collect()}
    b = {r["doc_id"]: r["shard"] for r in sharding.shard_documents(spark, rows, shards=9).collect()}
    assert sum(a[i] != b[i] for i in a) < 0.6 * len(a)  # modulo placement would move 8 of 9


# -- 5 HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>x</article>";</script>
</head><body><header><a href="/">Site</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies, please agree.</p></div><div class="ad">Buy, now.</div>
%s<aside class="sidebar"><p>Other things, of which there are many. More.</p></aside>
<section id="comments"><p>First! I liked it, really.</p></section><form><p>Your mail, please.</p></form>
<footer><p>&copy; 2020 Somebody.</p></footer></body></html>"""
BODY = "<h1>Head  &amp; line</h1><p>First <b>bold</b>\n part, with &lt;marks&gt;.<p>Second, longer part. It goes on.</p><ul><li>One<li>Two</ul>"
TEXT = "Head & line\nFirst bold part, with <marks>.\nSecond, longer part. It goes on.\nOne\nTwo"


def test_html_text(spark):
    wrapped = [PAGE % f"<article>{BODY}</article>", PAGE % f"<main><div>{BODY}</div></main>",
               PAGE % f'<div id="content">{BODY}</div>', PAGE % f"<article>{BODY}<article class='comment'><p>No.</p></article></article>"]
    rows = [(i, f"u{i}", h) for i, h in enumerate(wrapped)] + [(9, None, None), (None, "u", ""), (9, None, None),
                                                                (10, "x", "<p>" * 3000 + "deep"), (11, "y", "a < b & c &#x41;")]
    got = html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")
                                      .withColumn("text", F.lit(1))).collect()
    assert len(got) == len(rows)
    texts = {r["page_id"]: r["text"] for r in got}
    assert [texts[i] for i in range(len(wrapped))] == [TEXT] * len(wrapped)
    assert texts[9] == "" == texts[None] and texts[10] == "deep" and texts[11] == "a < b & c A"
    assert all(r["n_chars"] == len(r["text"]) for r in got)


LONG = " ".join(["Long text of the matter, with many words in it, and more. It goes on, and on; then it ends here."] * 3)


def test_html_scores_choose_on_pages_with_article():
    teaser = (f'<body><nav><a href="/">Site</a></nav><div class="x"><h1>Head</h1><p>{LONG}</p><p>Short.</p></div>'
              '<article><h3>Teaser</h3><p>Read this.</p></article><footer>f.</footer></body>')
    assert html_text.main_text(teaser) == f"Head\n{LONG}\nShort."
    inside = (f'<body><article><header><h1>Head</h1></header><p>{LONG}</p><div class="q1">Buy now!</div><h2>Part</h2><p>Short.</p>'
              '<div class="z"><ul><li><a href="1">One link</a><li><a href="2">Two</a></ul></div><ul><li>One<li>Two</ul>'
              f'<p>{LONG}</p><div class="r"><p>Nice one.</p><p>First!</p></div></article></body>')
    assert html_text.main_text(inside) == f"Head\n{LONG}\nPart\nShort.\nOne\nTwo\n{LONG}"
    entry = f'<body><article><h1>Head</h1><div class="entry"><p>{LONG}</p></div></article><div class="n"><p>x</p></div></body>'
    assert html_text.main_text(entry) == f"Head\n{LONG}"
    assert html_text.main_text('<nav><a href="/">A</a></nav><footer>c. 2020.</footer>') == ""


@pytest.mark.parametrize("page, text", [
    (f'<div class="content no-sidebar"><p>{LONG}</p></div><div class="x"><p>Junk.</p></div>', LONG),
    (f'<div class="content sidebar-right"><p>{LONG}</p></div><div class="x"><p>Junk.</p></div>', LONG),
    (f'<div id="page-with-header"><nav><a href="/">A</a></nav><p>{LONG}</p></div>', LONG),
    (f'<body><form id="f"><nav><a href="/">A</a></nav><div><p>{LONG}</p><p>Short.</p></div><footer>c</footer></form></body>', f"{LONG}\nShort."),
    (f'<div class="sidebar-layout"><article><p>{LONG}</p></article></div><div><p>Other.</p></div>', LONG),
    (f'<article><h2 id="related-work">Related work</h2><p id="search">Search it.</p><p>{LONG}</p></article>', f"Related work\nSearch it.\n{LONG}"),
    (f"<html><head><title>T</title><body><p>{LONG}</p></body></html>", LONG),
    (f"<html><head><title>T</title><p>{LONG}</p></html>", LONG),
    (f"<head><title>T</title><style>p{{}}</style>{LONG}", LONG),
    (f'<div id="c"><p>{LONG}</p><p><a href="/">A linked sentence.</a></p></div>', f"{LONG}\nA linked sentence."),
    (f'<article><p>{LONG}</p></article><div id="comments">' + f'<article class="c"><p>{LONG}</p></article>' * 9 + "</div>", LONG),
    (f'<div id="c"><p>{LONG}</p><p hidden>{LONG}</p></div>', LONG),
])
def test_html_side_words_weigh_and_do_not_drop(page, text):
    assert html_text.main_text(page) == text


# -- 6 language id

def test_language_model_draws_and_keeps_per_language(spark):
    assert langid.even_share([5, 100, 1000], 305) == 200 and langid.even_share([5, 7], 12) == float("inf")
    rows = [(i, f"aab{i} bba abab", "big") for i in range(6000)]
    rows += [(10_000 + i, "zyx" + "xyz"[i % 3] + "qvw"[i // 3] + " zzz", "small") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, sample_rows=100)
    assert model.languages == ["big", "small"]
    assert all("w" + w in model.row for _, t, lang in rows if lang == "small" for w in t.split())  # seen once, too
    names, _ = langid.Scorer(model).predict(["zyxxq zzz", "abab bba"])
    assert names == ["small", "big"]
    # bounds hold per language: the words of the large one do not push out the small one's
    tight = langid.fit(docs, max_words=3, max_grams=10)
    assert "wzzz" in tight.row and {"waab", "wbba", "wabab"} <= set(tight.row)


def test_language_id_backs_off_and_says_und(spark):
    rows = []
    for i in range(300):
        word = "".join(random.choice("abcde") for _ in range(6)) if i % 2 else "".join(random.choice("vwxyz") for _ in range(6))
        rows.append((i, f"{word} {word[:3]} {word[2:]}", "low" if i % 2 else "high"))
    rows += [(400, None, "low"), (401, "", "low"), (402, "123 ... !", "high"), (None, "abc", "low"), (404, "abcab", None),
             (404, "abcab", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(0))
    got = langid.predict_languages(docs).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    assert all(by[i][0]["lang_pred"] == rows[i][2] for i in range(300))
    assert {by[i][0]["lang_pred"] for i in (400, 401, 402)} == {"und"} and by[404][0]["lang_pred"] == "low"
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    unlabelled = langid.predict_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}
    assert langid.predict_languages(docs.where("false")).count() == 0


def test_language_model_holds_no_table_of_strings():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)})
    model = langid.Model(["x", "y"], [1, 2], ["w" + w for w in words] + ["1a", "2ab"], np.ones((len(words) + 2, 2)))
    model.vectors(words[:10] + ["ab-zz", "..."])
    assert not [k for k, v in model.__dict__.items() if isinstance(v, dict | list) and len(v) > 2]
    assert model._index is not None and model.__getstate__()["_index"] is None
    assert [x.tolist() for x in model.rows_of([words[7], "zab", "zz", "ya"])] == [[7, len(words) + 1, len(words)], [1, 1, 0, 1]]


def test_language_tasks_drop_what_a_worker_keeps():
    from ledgerloom.llm import workers
    first = workers.kept("a", lambda: [1])
    assert workers.kept("a", lambda: [2]) is first
    assert workers.kept("b", lambda: [3]) == [3] and list(workers._KEPT) == ["b"]
    coder = bpe._coder(bpe.Bpe(bpe.default_path()))
    assert list(workers._KEPT.values()) == [coder]
    workers.release()
    assert not workers._KEPT


def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    assert got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


# -- 7 vectors

def vectors():
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(6, 16))
    rows = [(i, (centre[i % 6] + rng.normal(size=16) * rng.choice([0.02, 0.2, 1])).tolist(), int(i % 3)) for i in range(240)]
    rows += [(300 + i, rows[i][1], rows[i][2]) for i in range(20)]
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] + [1.0] * 15, 1), (403, rows[0][1], None),
             (404, [float("inf")] + [1.0] * 15, 1), (405, [None] + [1.0] * 15, 1)]
    return rows


def test_vector_dedup(spark):
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n", F.lit(1))
    x = {i: np.array(v, dtype=np.float32).astype(float) for i, v, lab in rows[:260]}
    lab = {i: label for i, _, label in rows}
    links = [(a, b) for a in x for b in x if a != b and lab[a] == lab[b]
             and x[a] @ x[b] / np.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= 0.93]
    n = Counter(a for a, _ in links)
    root = least_roots([i for i, *_ in rows], links)
    got = subspace_join.near_duplicate_vectors(spark, table, tile=16).collect()
    assert sorted(map(tuple, got)) == sorted((i, n[i], root[i], root[i] == i) for i, *_ in rows)
    assert subspace_join.near_duplicate_vectors(spark, table.where("false")).count() == 0
    assert subspace_join.near_duplicate_vectors(spark, table.where("vec_id >= 400")).count() == 6


# -- 8 WARC

@pytest.mark.parametrize("version", [1, 2])
def test_arc_to_warc_and_back(spark, version):
    awkward = "é\r\n\r\nWARC/1.1\r\n\n" * 20
    rows = [(1, "http://a b/é", "x" * 200), (5, None, "x" * 200), (None, "u", "x" * 200), (2, "", None), (3, "u", "short"),
            (4, "u", "short"), (-7, "w", awkward), (-6, "w", awkward), (9, "big", "y" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("n", F.lit(1))
    arc, out = warc.convert_pages(spark, pages, version, archive_bytes=1000)
    got = {r["page_id"]: r for r in warc.read_warc(spark, out, with_payload=True).collect()}
    assert len(got) == len(rows)
    first = {1: None, 5: 1, None: 1, 2: None, 3: None, 4: None, -7: None, -6: -7, 9: None}
    for i, _, h in rows:
        raw = (h or "").encode()
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert r["record_type"] == ("response" if first[i] is None else "revisit") and r["refers_to"] == first[i]
        assert r["payload"] == (raw if first[i] is None else None) and r["warc_date"] == "2020-01-01T00:00:00Z"
    assert got[5]["url"] is None and got[2]["url"] == "" and len({r["record_id"] for r in got.values()}) == len(rows)
    back = {r["page_id"]: bytes(r["payload"]) for r in warc.read_arc(spark, arc).collect()}
    assert back == {i: (h or "").encode() for i, _, h in rows}
    _, empty = warc.convert_pages(spark, pages.where("false"), version)
    assert warc.read_warc(spark, empty).count() == 0


def test_damaged_archives_are_refused():
    block = b"1 0 x\n" + warc.ARC_FIELDS[1].encode() + b"\n"
    head = b"filedesc://x 0.0.0.0 20200101000000 text/plain %d\n" % len(block) + block + b"\n"
    record = b"http://u 0.0.0.0 20200101000000 text/html 5\nabcde\n"
    assert [r["block"] for r in warc.parse_arc(head + record)] == [b"abcde"]
    for bad in (head + record[:-4], record, head.replace(b"1 0 x", b"7 0 x") + record, head + b"u 5\nabcde\n"):
        with pytest.raises(ValueError):
            list(warc.parse_arc(bad))
    with pytest.raises(ValueError):
        list(warc.parse_warc(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nab\r\n\r\n"))


# -- 9 BPE

def test_bpe_coder_holds_few_words_at_once(monkeypatch):
    """A worker process keeps its coder between tasks: what it holds, and learns at once, is bounded."""
    monkeypatch.setattr(bpe, "CACHE_WORDS", 60)
    monkeypatch.setattr(bpe, "LEARNED_AT_ONCE", 7)
    model = bpe.Bpe(bpe.default_path())
    whole, sizes = bpe.Coder(model), []
    rng = random.Random(5)
    texts = [" ".join("word%d" % min(rng.randrange(400), rng.randrange(400)) for _ in range(20)) for _ in range(60)]
    encode = model.encode_words
    monkeypatch.setattr(model, "encode_words", lambda words: sizes.append(len(words)) or encode(words))
    for t in texts:
        ids = [i for w in encode([p.encode() for p in whole.pieces(t)]) for i in w.tolist()]
        assert whole.encode([t]) == [(len(ids), ",".join(map(str, ids)), t)]
        assert len(whole.known) + len(whole.old) <= 60
    assert max(sizes) <= 7


def test_bpe_equals_the_library(spark, docs, none):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    odd = ["a<|endoftext|>b", "<|endoftext|>", "  a \n b  ", "aaaaaaaaaaaaaaa", "it's we'll", "½ ² Ⅷ 漢字 x", "\x1c \x1d a　 b",
           "".join(random.choice("abc") for _ in range(5000)), "the" * 3000, "🙂🙂 é́", "­\u0085  z"]
    rows = [(i, t) for i, t in enumerate([*[r[1] for r in documents()], *odd])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in bpe.bpe_digests(table, with_ids=True).collect()}
    for i, t in rows:
        e = library.encode(t or "", add_special_tokens=False)
        assert got[i]["token_ids"] == e.ids and got[i]["n_tokens"] == len(e.ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, e.ids)).encode()).hexdigest()
        plain = library.decode(e.ids, skip_special_tokens=False)
        assert got[i]["decoded_sha256"] == hashlib.sha256(plain.encode()).hexdigest()
    back = bpe.bpe_decode(bpe.bpe_digests(table, with_ids=True)).collect()
    assert {r["doc_id"]: r["text"] for r in back} == {i: t or "" for i, t in rows}
    assert bpe.bpe_digests(none).count() == 0


# -- 10 nearest neighbours

def test_multi_index_probes_are_complete():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 1 << 16, (600, 16), dtype=np.uint16)
    codes[300:] = codes[:300] ^ (rng.random((300, 16)) < 0.3).astype(np.uint16)
    index = multi_index.BlockIndex(codes)
    for radius in (0, 3, 15, 31, 60, 100, 256):
        for q in range(0, 600, 60):
            far = np.bitwise_count(codes ^ codes[q]).sum(axis=1)
            assert index.within(codes[q], radius).tolist() == np.flatnonzero(far <= radius).tolist()


def test_nearest_neighbours(spark):
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = multi_index.nearest_neighbours(spark, table, table.where("vec_id % 20 = 0")).collect()
    x = {i: np.array(v, dtype=np.float32).astype(float) for i, v, _ in [*rows[:260], rows[263]]}
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = total = 0
    for q in (i for i in x if i % 20 == 0):
        score = {i: x[i] @ x[q] / np.sqrt((x[i] @ x[i]) * (x[q] @ x[q])) for i in x if i != q}
        want = sorted(score, key=lambda i: (-round(score[i], 12), i))[:5]
        assert len(found[q]) == 5 and all(abs(s - score[i]) < 1e-12 for i, s in found[q])
        assert [s for _, s in found[q]] == sorted((s for _, s in found[q]), reverse=True)
        hits += len({i for i, _ in found[q]} & set(want))
        total += 5
    assert hits / total >= 0.9 and set(found) == {i for i in x if i % 20 == 0}
    few = multi_index.nearest_neighbours(spark, table.where("vec_id < 3"), table.where("vec_id = 0")).collect()
    assert len(few) == 2
    assert multi_index.nearest_neighbours(spark, table.where("false"), table).count() == 0


def test_nearest_neighbours_of_repeated_rows(spark):
    rows = [(i, v) for i, v, _ in vectors()[:240]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")

    def found(data, queries):
        return sorted(map(tuple, multi_index.nearest_neighbours(spark, data, queries).collect()))

    asked = table.where("vec_id % 40 = 0")
    want = found(table, asked)
    assert len(want) == 6 * 5
    many = functools.reduce(lambda a, b: a.unionAll(b), [asked] * 6)
    assert found(table, many) == want
    assert found(table.unionAll(many), many) == want
    # the same id with another vector is another row, on both sides
    other = spark.createDataFrame([(0, rows[41][1])], table.schema)
    got = multi_index.nearest_neighbours(spark, table.unionAll(other), other.unionAll(other)).collect()
    assert len(got) == 5 and got[0]["vec_id"] == 41


def test_recall_on_the_embeddings_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = defaultdict(set)
    for r in multi_index.nearest_neighbours(spark, table, table.where("vec_id % 50 = 0")).collect():
        found[r["query_id"]].add(r["vec_id"])
    recall = []
    for q in np.flatnonzero(ids % 50 == 0):
        cosine = x @ x[q]
        cosine[q] = -2
        recall.append(len(found[ids[q]] & set(ids[np.argsort(-cosine)[:5]])) / 5)
    assert np.mean(recall) >= 0.9


# -- pipeline

def test_pipeline_stages_keep_the_rows_of_a_brute_force_chain(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    import corpus_pipeline
    draw = random.Random(11)
    letters = {"en": "abcde", "fr": "vwxyz"}
    line = lambda lang, n: " ".join("".join(draw.choice(letters[lang]) for _ in range(6)) for _ in range(n))
    texts = [(line(x, 24) + "\n" + line(x, 9), x) for x in ["en", "fr"] * 12]
    cut = [(" ".join(t.split()[:16]) + "\n" + " ".join(t.split()[16:]), x) for t, x in texts[:5]]  # same shingles, other lines
    more = [(line(x, 7) + "\n" + t.split("\n")[1], x) for t, x in texts[5:9]]  # a line met before
    texts += [*cut, *more, texts[9], ("123 ... !", "en"), ("", "fr"), (None, "en")]
    rows = [(i, t, x, f"src{i % 3}", len(t or "")) for i, (t, x) in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def step(name, rows):
        return Counter(map(tuple, stages[name](spark, spark.createDataFrame(rows, schema), str(tmp_path)).collect()))

    want = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert step("language_id", rows) == Counter(want) and len(want) == len(rows) - 3
    removed, rows = brute_lines(want), want
    want = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in removed[i]), *rest) for i, t, *rest in rows]
    want = [r for r in want if r[1].split()]
    assert step("line_dedup", rows) == Counter(want) and sum(map(len, removed.values())) >= 6
    rows, fp = want, {r[0]: brute_fingerprint(r[1]) for r in want}
    root = least_roots(fp, [(a, b) for a in fp for b in fp if bin(fp[a] ^ fp[b]).count("1") <= 2])
    want = [r for r in rows if root[r[0]] == r[0]]
    assert step("simhash_near_dedup", rows) == Counter(want) and len(rows) - len(want) >= 5
    rows = want
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix(spark, spark.createDataFrame(rows, schema)).collect()}
    want = [r for r in rows for _ in range(plan[r[0]])]
    assert step("mixing", rows) == Counter(want) and len(plan) == len(rows)
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    digests = Counter()
    for r in want:
        ids = library.encode(r[1], add_special_tokens=False).ids
        digests[r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()] += 1
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in got) == digests
