"""Byte-level BPE by batched numpy merge rounds.

The words of a batch of documents lie in one flat array of symbols. A round
looks every neighbouring pair up in the sorted pair keys by binary search,
takes each word's lowest rank, and merges all its places at once, left to
right where places overlap; words without a mergeable pair drop out. Words met
lately come from a bounded cache.

Words of more than ``LONG_WORD`` = 1,024 bytes leave that method for a heap of
pairs in plain Python, with the same ids: a round merges one rank per word, so
a word of n bytes can take on the order of n rounds, each a pass over all of
it, while the heap touches only the neighbours of a merge.

The vocabulary file's path is a parameter;
the file is read on the driver and its merge table (bounded by the vocabulary)
travels with the tasks.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.workers import kept, ready

DEFAULT = "byte_bpe_50k.json"
#: Words a worker process keeps between tasks, and words learned at a time.
CACHE_WORDS, LEARNED_AT_ONCE = 300_000, 20_000
LONG_WORD = 1024
#: Rows taken from a batch at a time: their texts are held at once.
ROWS_AT_ONCE = 1_000
# Fixed value: white space as the pattern's \s means it (Unicode White_Space).
SPACE = r"\x09-\x0D\x20\x85\xA0  -     　"
# Fixed value: the pattern that splits a text before any merge.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|["
           + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")

# Letters and numbers that Unicode has got since version 16, which the
# tokenizer's classes follow: it splits around them as around signs.
LATER = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D "
    "107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F "
    "12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 "
    "18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 "
    "1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F "
    "2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F")
_LATER = "".join("-".join(f"\\U{int(x, 16):08X}" for x in r.split("-")) for r in LATER.split())
#: The pattern for texts that hold some of them.
PATTERN_LATER = (r"'s|'t|'re|'ve|'m|'ll|'d| ?(?:(?![" + _LATER + r"])\p{L})+| ?(?:(?![" + _LATER + r"])\p{N})+"
                 + r"| ?(?:[^" + SPACE + r"\p{L}\p{N}]|[" + _LATER + r"])+|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(DEFAULT)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary:
    itself if printable, else the next free letter from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Bpe:
    """A byte-level vocabulary: ``encode_words`` and ``decode``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        of = {c: b for b, c in enumerate(letters)}
        self.first = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(of[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.text = [str(i) for i in range(size)]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair = (left << 32) | right
        at = np.searchsorted(self.keys, pair)
        at[at == len(self.keys)] = 0
        return at, np.where(self.keys[at] == pair, self.rank[at], np.iinfo(np.int64).max)

    def _rounds(self, words: list[bytes]) -> list[np.ndarray]:
        never = np.iinfo(np.int64).max
        symbols = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        done: list[np.ndarray | None] = [None] * len(words)
        at, rank = self._ranks(symbols[:-1], symbols[1:])
        rank[word[:-1] != word[1:]] = never
        at, rank = np.append(at, 0), np.append(rank, never)
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lengths = np.diff(np.append(starts, len(symbols)))
            least = np.minimum.reduceat(rank, starts)
            over = np.flatnonzero(least == never)
            for w, s, e in zip(word[starts[over]].tolist(), starts[over].tolist(),
                               (starts[over] + lengths[over]).tolist()):
                done[w] = symbols[s:e]
            live = np.repeat(least != never, lengths)
            places = np.flatnonzero((rank == np.repeat(least, lengths)) & live)
            if len(places) == 0:
                break
            # of hits that overlap in a row, every other one counts, from the left
            run = np.flatnonzero(np.append(True, np.diff(places) != 1))
            begin = np.repeat(places[run], np.diff(np.append(run, len(places))))
            places = places[(places - begin) % 2 == 0]
            symbols = symbols.copy()
            symbols[places] = self.made[at[places]]
            live[places + 1] = False
            moved = np.cumsum(live)[places] - 1
            symbols, word, at, rank = symbols[live], word[live], at[live], rank[live]
            # only the pairs beside a merged symbol have changed
            beside = np.zeros(len(symbols), dtype=bool)
            beside[moved] = True
            beside[moved[moved > 0] - 1] = True
            near = np.flatnonzero(beside)
            last = near == len(symbols) - 1
            inner = near[~last]
            at[inner], new = self._ranks(symbols[inner], symbols[inner + 1])
            rank[inner] = np.where(word[inner] == word[inner + 1], new, never)
            rank[near[last]] = never
        return done  # type: ignore[return-value]

    def _long(self, word: bytes) -> np.ndarray:
        """One very long word: a heap of pairs instead of a round per merge."""
        import heapq
        sym = self.first[np.frombuffer(word, dtype=np.uint8)].tolist()
        table = self._table()
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*table[p], i, p) for i in range(n - 1) if (p := (sym[i], sym[i + 1])) in table]
        heapq.heapify(heap)
        while heap:
            _, made, i, pair = heapq.heappop(heap)
            j = after[i]
            if sym[i] != pair[0] or j >= n or sym[j] != pair[1]:
                continue
            sym[i], sym[j] = made, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (p := (made, sym[after[i]])) in table:
                    heapq.heappush(heap, (*table[p], i, p))
            if before[i] >= 0 and (p := (sym[before[i]], made)) in table:
                heapq.heappush(heap, (*table[p], before[i], p))
        return np.array([s for s in sym if s >= 0], dtype=np.int64)

    def _table(self) -> dict:
        if not hasattr(self, "_pairs"):
            self._pairs = {(int(k) >> 32, int(k) & 0xFFFFFFFF): (int(r), int(m))
                           for k, r, m in zip(self.keys, self.rank, self.made)}
        return self._pairs

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each word (a piece of the split pattern, in bytes)."""
        out: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(words)
        short = [i for i, w in enumerate(words) if 0 < len(w) <= LONG_WORD]
        for i, ids in zip(short, self._rounds([words[i] for i in short])):
            out[i] = ids
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = self._long(w)
        return out

    def decode_bytes(self, ids) -> bytes:
        return b"".join([self.bytes[i] for i in ids])

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


# The same pattern for ``re``, whose classes agree with those above on the
# characters that _ODD does not find; texts with other characters go through ``regex``.
_PLAIN = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
_ODD = re.compile("[^\t-\r -~\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]").search
_ANY = regex.compile(PATTERN).findall
_ANY_LATER = regex.compile(PATTERN_LATER).findall
_HAS_LATER = re.compile(f"[{_LATER}]").search


class Coder:
    """Texts to tokens with a bounded cache of the words met lately.

    Words are learned into the young half; when that is full it becomes the old
    half, whose words return to the young one as they are met again."""

    def __init__(self, model: Bpe):
        self.model = model
        names = sorted(model.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        self.known: dict[str, tuple[int, str, bytes]] = {}
        self.old: dict[str, tuple[int, str, bytes]] = {}

    def pieces(self, text: str) -> list[str]:
        """A text's words in order; the strings of special tokens are pieces."""
        if self.marks is not None and any(s in text for s in self.model.special):
            out: list[str] = []
            for i, part in enumerate(self.marks(text)):
                out.extend([part] if i % 2 else self.pieces(part))
            return out
        if not text.isascii() and _HAS_LATER(text):
            return _ANY_LATER(text)
        return _ANY(text) if _ODD(text) else _PLAIN(text)

    def learn(self, words: set[str]) -> None:
        fresh = words.difference(self.known)
        if len(self.known) + len(fresh) > CACHE_WORDS // 2:
            # what the current documents need is kept or learned in any case
            self.old, self.known = self.known, {}
            fresh = words
        met = [w for w in fresh if w in self.old]
        self.known.update(zip(met, map(self.old.pop, met)))
        new = [w for w in fresh if w not in self.known]
        for at in range(0, len(new), LEARNED_AT_ONCE):
            self._learn(new[at:at + LEARNED_AT_ONCE])

    def _learn(self, new: list[str]) -> None:
        special, known = self.model.special, self.known
        token, text = self.model.bytes, self.model.text
        ids = self.model.encode_words([b"" if w in special else w.encode("utf-8", "surrogatepass") for w in new])
        for w, got in zip(new, map(np.ndarray.tolist, ids)):
            got = got if w not in special else [special[w]]
            known[w] = (len(got), ",".join([text[i] for i in got]), b"".join([token[i] for i in got]))

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of tokens, decimal ids joined by commas, decoded text)."""
        cut = [self.pieces(t) for t in texts]
        self.learn(set().union(*cut) if cut else set())
        out = []
        find = self.known.__getitem__
        for words in cut:
            n, ids, raw = zip(*map(find, words)) if words else ((), (), ())
            out.append((sum(n), ",".join(ids), b"".join(raw).decode("utf-8", "replace")))
        return out


def _coder(model: Bpe) -> Coder:
    """The worker process's coder for this vocabulary (kept between tasks, until another operator's come)."""
    key = ("bpe", len(model.keys), int(model.keys.sum()), int((model.keys * model.rank).sum()), tuple(model.special))
    return kept(key, lambda: Coder(model))


def _groups(texts: list[str], most: int = 1_000_000) -> Iterator[list[str]]:
    """Runs of texts of about ``most`` characters; a longer text stands alone."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > most:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def bpe_digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` per row, with
    ``token_ids`` (array of int) as well if ``with_ids``.

    Null and empty texts have no tokens: the digests are those of the empty
    string. Repeated rows come out once each; other columns are ignored."""
    model = Bpe(path or default_path())

    def run(batches):
        coder = _coder(model)
        for b in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            texts = [t or "" for t in b.column(1).to_pylist()]
            at = 0
            for some in _groups(texts):
                got = coder.encode(some)
                cols = [b.column(0).slice(at, len(some)), pa.array([g[0] for g in got], pa.int64()),
                        pa.array([hashlib.sha256(g[1].encode()).hexdigest() for g in got]),
                        pa.array([hashlib.sha256(g[2].encode()).hexdigest() for g in got])]
                if with_ids:
                    cols.append(pa.array([[int(i) for i in g[1].split(",")] if g[1] else [] for g in got],
                                         pa.list_(pa.int32())))
                at += len(some)
                yield pa.RecordBatch.from_arrays(cols, names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["token_ids"] * with_ids
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())]
                          + [T.StructField("token_ids", T.ArrayType(T.IntegerType()))] * with_ids)
    return ready(docs).select(id_col, text_col).mapInArrow(run, schema)


def bpe_decode(tokens: DataFrame, path: str | None = None, id_col: str = "doc_id",
               ids_col: str = "token_ids") -> DataFrame:
    """``(doc_id, text)`` from arrays of token ids (null: empty text)."""
    model = Bpe(path or default_path())

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([model.decode(x or []) for x in b.column(1).to_pylist()], pa.string())],
                names=["doc_id", "text"])

    schema = T.StructType([T.StructField("doc_id", tokens.schema[id_col].dataType),
                           T.StructField("text", T.StringType())])
    return ready(tokens).select(id_col, ids_col).mapInArrow(run, schema)
