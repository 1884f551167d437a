"""Language identification with word-first backoff.

A model holds, per learned language, log frequencies of words and of character
n-grams (four down to one letter, word ends marked). A known word scores by
its own frequencies; an unseen one is covered by its longest known n-grams,
falling back to shorter ones where none of a length is known. A text's score
for a language is the sum over all its words.

The model is fitted on a bounded sample of labelled rows (``sample_rows``,
chosen by a hash of the id and text): small languages give all their rows, the
others share the rest evenly, at least about ``LEAST_ROWS`` rows each. It holds
every word and n-gram of the sample, down to those seen once, as long as a
language has at most ``max_words`` words and ``max_grams`` n-grams; of more, its
most frequent ones. All bounds are parameters. Every text is scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.graph import stored
from ledgerloom.llm.workers import ready, release

SAMPLE_ROWS, MAX_WORDS, MAX_GRAMS = 20_000, 100_000, 100_000
LEAST_ROWS = 20
LONGEST = 4
UNKNOWN = "und"
CACHE_TOKENS = 150_000
#: Rows scored at a time: their words are held at once.
ROWS_AT_ONCE = 250
_LETTERS = re.compile(r"[^\W\d_]+").findall


def grams(word: str, n: int) -> list[str]:
    marked = f" {word} " if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text has remainder 2 by 4 (null id: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Model:
    """Fitted tables: gram -> row of log frequencies, one column a language.

    A gram is found by binary search for its 64-bit string hash, which is made
    where the model is used: no table of strings is held in a worker."""

    def __init__(self, languages: list[str], prior: list[int], names: list[str], table: np.ndarray):
        self.languages = languages
        self.prior = np.log(np.array(prior, dtype=float) / max(1, sum(prior))) if languages else np.zeros(0)
        self.names, self._index = pa.array(names, pa.string()), None
        kind = np.array([0 if g[0] == "w" else int(g[0]) for g in names], dtype=int)
        totals = np.zeros((LONGEST + 1, len(languages)))
        np.add.at(totals, kind, table)
        self.log = np.log((table + 0.5) / (totals[kind] + 0.5 * max(1, len(names))))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_index": None}

    @property
    def row(self) -> dict[str, int]:
        """Every gram and its row, to look into a model."""
        return {g: i for i, g in enumerate(self.names.to_pylist())}

    def index(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the grams and their rows. String hashes differ between processes, so it does not travel."""
        if self._index is None:
            parts = (self.names[at:at + 10_000].to_pylist() for at in range(0, len(self.names), 10_000))
            hashes = np.fromiter((hash(g) for part in parts for g in part), dtype=np.int64, count=len(self.names))
            rows = np.argsort(hashes, kind="stable")
            self._index = hashes[rows], rows
        return self._index

    def rows(self, names: list[str]) -> np.ndarray:
        """Row of each gram, -1 if unknown."""
        hashes, rows = self.index()
        if not len(hashes) or not names:
            return np.full(len(names), -1)
        wanted = np.fromiter(map(hash, names), dtype=np.int64, count=len(names))
        at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
        return np.where(hashes[at] == wanted, rows[at], -1)

    def rows_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows that score the words, word after word, and how many each has: its
        own, or those of its longest known n-grams."""
        found = self.rows(["w" + w for w in words])
        of, got = np.flatnonzero(found >= 0), found[found >= 0]
        left = np.flatnonzero(found < 0).tolist()
        for n in range(LONGEST, 0, -1):
            cut = [grams(words[i], n) for i in left]
            found = self.rows([f"{n}{g}" for gs in cut for g in gs])
            owner = np.repeat(np.array(left, dtype=np.int64), [len(gs) for gs in cut])[found >= 0]
            of, got = np.append(of, owner), np.append(got, found[found >= 0])
            left = sorted(set(left).difference(owner.tolist()))
        order = np.argsort(of, kind="stable")
        return got[order], np.bincount(of, minlength=len(words))

    def vectors(self, tokens: list[str]) -> np.ndarray:
        """Scores of white-space tokens, one row each; all zero without letters known."""
        cut = [_LETTERS(t) for t in tokens]
        rows, per_word = self.rows_of([w for ws in cut for w in ws])
        sums = np.zeros((len(rows) + 1, len(self.languages)))
        if len(rows):
            np.cumsum(self.log[rows], axis=0, out=sums[1:])
        ends = np.append(0, np.cumsum(per_word))  # of the words' rows
        at = ends[np.append(0, np.cumsum([len(ws) for ws in cut], dtype=np.int64))]
        return sums[at[1:]] - sums[at[:-1]]


class Scorer:
    """Predictions with a bounded cache of the tokens met so far."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.table = np.zeros((0, len(model.languages)))

    def _learn(self, tokens: set[str]) -> None:
        fresh = list(tokens.difference(self.known))
        if len(self.known) + len(fresh) > CACHE_TOKENS:
            self.known, self.table, fresh = {}, self.table[:0], list(tokens)
        start = len(self.table)
        self.table = np.concatenate([self.table, self.model.vectors(fresh)])
        self.known.update(zip(fresh, range(start, start + len(fresh))))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        cut = [t.lower().split() if t else [] for t in texts]
        if self.model.languages:
            self._learn(set().union(*cut) if cut else set())
        names, scores = [], []
        for text, tokens in zip(texts, cut):
            if not self.model.languages or not text or not _has_letter(text):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            ids = np.fromiter(map(self.known.__getitem__, tokens), dtype=np.int64, count=len(tokens))
            total = self.table[ids].sum(axis=0) + self.model.prior
            p = np.exp(total - total.max())
            best = int(total.argmax())
            names.append(self.model.languages[best])
            scores.append(float(p[best] / p.sum()))
        return names, scores


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def even_share(sizes: list[int], rows: int) -> float:
    """Rows a language may give so that all give ``rows`` together: those with
    fewer give all, the others as many each; no bound if all fit."""
    left = float(rows)
    for i, n in enumerate(sorted(sizes)):
        share = left / (len(sizes) - i)
        if n > share:
            return share
        left -= n
    return float("inf")


def _most_frequent(counted: DataFrame, max_words: int, max_grams: int) -> DataFrame:
    """Per language at most about ``max_words`` words and ``max_grams`` n-grams
    of ``counted``, the most frequent; of those as frequent as the last, some by hash."""
    word = F.col("gram").startswith("w")
    found = counted.groupBy("lang", word.alias("word"), "n").agg(F.count("*").alias("k")).collect()
    keep = F.lit(True)
    for lang, is_word in {(x["lang"], x["word"]) for x in found}:
        left = max_words if is_word else max_grams
        for x in sorted((x for x in found if (x["lang"], x["word"]) == (lang, is_word)), key=lambda x: -x["n"]):
            if x["k"] > left:
                some = F.pmod(F.xxhash64("gram"), F.lit(1 << 30)) < int((1 << 30) * left / x["k"])
                keep = F.when((F.col("lang") == lang) & (word == is_word),
                              (F.col("n") > x["n"]) | ((F.col("n") == x["n"]) & some)).otherwise(keep)
                break
            left -= x["k"]
    return counted.where(keep)


def fit(docs: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, max_words: int = MAX_WORDS,
        max_grams: int = MAX_GRAMS) -> Model:
    """A model from the rows with a label (and for which ``usable`` holds)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                       (usable if usable is not None else F.lit(True)).alias("use"))
    rows = rows.where("use and lang is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.count("text").alias("texts")).orderBy("lang").collect()
    per = {r["lang"]: r["n"] for r in sizes}
    languages = sorted(per)
    if not languages:
        return Model([], [], [], np.zeros((0, 0)))
    rows = rows.where("text is not null")
    share = max(LEAST_ROWS, even_share([r["texts"] for r in sizes], sample_rows))
    rates = [x for r in sizes if r["texts"] > share
             for x in (F.lit(r["lang"]), F.lit(int((1 << 30) * share / r["texts"])))]
    if rates:
        rate = F.coalesce(F.try_element_at(F.create_map(*rates), F.col("lang")), F.lit(1 << 30))
        rows = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < rate)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, Counter] = {}
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got.setdefault(lang, Counter()).update(_LETTERS(text.lower()))
        for lang, words in got.items():
            out: Counter = Counter()
            for w, c in words.items():
                out["w" + w] += c
                for k in range(1, LONGEST + 1):
                    for g in grams(w, k):
                        out[f"{k}{g}"] += c
            keys = list(out)
            for at in range(0, len(keys), 50_000):
                some = keys[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array([lang] * len(some)), pa.array([out[g] for g in some], pa.int64())],
                    names=["gram", "lang", "n"])

    counted = (ready(rows).select("text", "lang").mapInArrow(count, "gram string, lang string, n long")
               .groupBy("gram", "lang").agg(F.sum("n").alias("n")))
    counted = _most_frequent(stored(docs.sparkSession, counted, "grams"), max_words, max_grams)
    got = counted.select("gram", "lang", "n").toArrow()
    names = pc.unique(got["gram"])
    table = np.zeros((len(names), len(languages)))
    table[pc.index_in(got["gram"], names).to_numpy(), pc.index_in(got["lang"], pa.array(languages)).to_numpy()] = got["n"].to_numpy()
    return Model(languages, [per[x] for x in languages], names.to_pylist(), table)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """``(*keep, lang_pred, score)`` per row (``keep``: the id column unless
    given). ``und`` with score 0 for a null text, one without letters, or a
    model fitted on nothing; else score is the share of the best language."""
    keep = keep or [id_col]

    def run(batches):
        release()
        scorer = Scorer(model)
        for b in batches:
            texts = b.column(len(keep))
            for at in range(0, b.num_rows, ROWS_AT_ONCE):
                names, scores = scorer.predict(texts.slice(at, ROWS_AT_ONCE).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).slice(at, ROWS_AT_ONCE) for i in range(len(keep))] + [pa.array(names), pa.array(scores)],
                    names=[*keep, "lang_pred", "score"])

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()),
                                                            T.StructField("score", T.DoubleType())])
    return ready(docs).select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def predict_languages(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``docs``,
    learned from its own labelled rows that are not held out."""
    usable = F.col(id_col).isNotNull() & ~held_out(id_col)
    model = fit(docs, usable, id_col=id_col, **options)
    return identify(docs, model, id_col).select(
        F.col(id_col), held_out(id_col).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose language is identified (``und`` goes)."""
    usable = F.col("doc_id").isNotNull() & ~held_out("doc_id")
    model = fit(docs, usable, **options)

    def run(batches):
        release()
        scorer = Scorer(model)
        for b in batches:
            for at in range(0, b.num_rows, ROWS_AT_ONCE):
                part = b.slice(at, ROWS_AT_ONCE)
                names, _ = scorer.predict(part.column("text").to_pylist())
                yield part.filter(pa.array([n != UNKNOWN for n in names]))

    return ready(docs).mapInArrow(run, docs.schema)
