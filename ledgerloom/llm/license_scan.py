"""Licence scan by a positional index of rare words.

Texts are lower-cased (A-Z) and read as words of digits, letters a to z and all
characters beyond ASCII, numbered from 0. A template is a licence's wording, the
share of its words that must stand at their places, and key phrases that must
stand in full.

1. Over all documents, the number of documents with each licence word gives its
   inverse document frequency; the licence words are a fixed vocabulary.
2. A template of n words of which m must stand is filed under its n - m + 1
   words of highest frequency, with their positions: any place where it stands
   has one of them (a phrase demanded in full has one, its rarest).
3. Each document looks up its words among these. A hit at word i of a template's
   position p proposes the start i - p; the positions of the document's licence
   words are intersected there with the template's, and the key phrases verified.

All occurrences are found; nothing is shuffled but the word statistics.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.workers import ready

#: Share of a wording's words that must stand at their places.
COVERAGE = 0.8
#: Bytes of text cut into words at a time.
CHUNK = 1 << 20
# The bytes of a word, after lower-casing.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

# Phrases and their labels.
BASE = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]

# Label, wording (from the licences' own texts and notices), key phrases.
WORDINGS = [
    ("agpl", "GNU Affero General Public License", ["affero general public license"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license", "2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the License", ["in compliance with the license"]),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0", ["identifier apache 2 0"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
            " the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause", ["identifier bsd 3 clause"]),
    ("cc-by-4.0", "Licensed under CC BY 4.0", ["cc by 4 0"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ["cc by nc", "4 0"]),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ["cc by sa", "4 0"]),
    ("cc0", "CC0 1.0 Universal", ["cc0 1 0 universal"]),
    ("epl-2.0", "made available under the terms of the Eclipse Public License 2.0", ["eclipse public license", "2 0"]),
    ("gpl-2.0", "GNU General Public License, version 2", ["general public license", "version 2"]),
    ("gpl-3.0", "GNU General Public License, version 3", ["general public license", "version 3"]),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
                   " Public License as published by the Free Software Foundation", ["free software", "general public license"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
            " granted", ["permission to use copy modify", "hereby granted"]),
    ("lgpl", "GNU Lesser General Public License", ["lesser general public license"]),
    ("mit", "Released under the MIT license", ["mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files", ["permission is hereby granted free of charge"]),
    ("mit", "SPDX-License-Identifier: MIT", ["identifier mit"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ["mozilla public license", "2 0"]),
    ("no-warranty", "the software is provided as is, without warranty of any kind", ["without warranty"]),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ["unencumbered software", "public domain"]),
]


def words_of(text: str) -> tuple[str, ...]:
    return tuple(w.decode() for w in WORD.findall(text.encode().lower()))


@dataclass(frozen=True)
class Template:
    label: str
    base: bool
    words: tuple[str, ...]
    need: int  # words that must stand at their places
    must: frozenset[int]  # places of the key phrases


def template(label: str, wording: str, keys: list[str], base: bool = False, coverage: float = COVERAGE) -> Template:
    words = words_of(wording)
    must: set[int] = set()
    for key in map(words_of, keys):
        at = [i for i in range(len(words) - len(key) + 1) if words[i:i + len(key)] == key]
        if not at:
            raise ValueError(f"the wording of {label} lacks its key phrase {' '.join(key)!r}")
        must.update(i + j for i in at for j in range(len(key)))
    return Template(label, base, words, math.ceil(coverage * len(words) - 1e-9), frozenset(must))


def default_templates() -> list[Template]:
    return ([template(label, phrase, [phrase], base=True, coverage=1.0) for label, phrase in BASE]
            + [template(label, wording, keys) for label, wording, keys in WORDINGS])


def document_frequency(docs: DataFrame, templates: list[Template], text_col: str = "text") -> dict[str, int]:
    """Documents with each licence word, at most one row per such word."""
    vocabulary = frozenset(w.encode() for t in templates for w in t.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for text in b.column(0).cast(pa.binary()).to_pylist():
                seen: set[bytes] = set()
                for _, part in parts_of(text):
                    seen |= vocabulary.intersection(part)
                counts.update(seen)
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()),
                                          pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    found = (ready(docs).select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long")
             .groupBy("word").agg(F.sum("n").alias("n")))
    return {r["word"]: r["n"] for r in found.collect()}


def rare_word_index(templates: list[Template], frequency: dict[str, int]) -> dict[bytes, list[tuple[int, int]]]:
    """Word to ``(template, position)``: each template under its rarest words."""
    index: dict[bytes, list[tuple[int, int]]] = {}
    for k, t in enumerate(templates):
        by_rarity = sorted(range(len(t.words)), key=lambda p: (frequency.get(t.words[p], 0), t.words[p], p))
        for p in by_rarity[:len(t.words) - t.need + 1]:
            index.setdefault(t.words[p].encode(), []).append((k, p))
    return index


def parts_of(text: bytes | None) -> Iterator[tuple[int, list[bytes]]]:
    """The words of a text, those of about CHUNK bytes at a time, with the
    number of the first."""
    at = first = 0
    text = text or b""
    while at < len(text):
        end = min(len(text), at + CHUNK)
        while end < len(text) and (text[end] >= 128 or chr(text[end]).isalnum()):
            end += 1
        words = WORD.findall(text[at:end].lower())
        yield first, words
        first += len(words)
        at = end


def places(text: bytes | None, templates: list[Template], index: dict[bytes, list[tuple[int, int]]],
           vocabulary: frozenset[bytes]) -> tuple[int, list[tuple[int, int, int]]]:
    """The number of words, and ``(template, start, words in place)`` of every
    place where a template stands."""
    longest = max((len(t.words) for t in templates), default=1)
    found: list[tuple[int, int, int]] = []
    before: list[bytes] = []
    total = 0
    for first, part in parts_of(text):
        words = before + part
        offset = first - len(before)
        total = first + len(part)
        hits = [(i, w) for i, w in enumerate(words) if w in index]
        if hits:
            at: dict[bytes, set[int]] = {}
            for i, w in enumerate(words):
                if w in vocabulary:
                    at.setdefault(w, set()).add(i)
            starts = {(k, i - p) for i, w in hits for k, p in index[w]}
            for k, s in starts:
                t = templates[k]
                # places that end in what was carried over have been looked at
                if s < 0 or s + len(t.words) > len(words) or s + len(t.words) <= len(before):
                    continue
                there = [j for j, w in enumerate(t.words) if s + j in at.get(w.encode(), ())]
                if len(there) >= t.need and t.must.issubset(there):
                    found.append((k, s + offset, len(there)))
        before = words[max(0, len(words) - longest + 1):]
    return total, sorted(found, key=lambda x: (x[1], x[0]))


MATCHES = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("base", T.BooleanType()), T.StructField("start", T.LongType()),
    T.StructField("n_words", T.IntegerType()), T.StructField("coverage", T.DoubleType())]))


def license_matches(docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, matches)`` per row: every place of a template as
    ``(label, base, start, n_words, coverage)``, by start. A place lies within
    the document. Null and empty texts have no words; rows that repeat come out
    as often; an empty table gives none. Other columns are ignored."""
    templates = default_templates() if templates is None else templates
    index = rare_word_index(templates, document_frequency(docs, templates, text_col))
    vocabulary = frozenset(w.encode() for t in templates for w in t.words)
    kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("n_words", pa.int32()),
                               ("coverage", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, matches = [], []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                n, found = places(text, templates, index, vocabulary)
                counts.append(n)
                matches.append([{"label": templates[k].label, "base": templates[k].base, "start": s,
                                 "n_words": len(templates[k].words), "coverage": c / len(templates[k].words)} for k, s, c in found])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(matches, kind)],
                                             names=["doc_id", "n_words", "matches"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("matches", MATCHES)])
    return ready(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def license_digest(spark: SparkSession, docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score)`` per row: places of the base phrases, their smallest and largest
    start (null: none), distinct labels in order, and the largest share of a
    template's words in place (0: no template stands)."""
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    labels = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    return license_matches(docs, templates).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["coverage"])), F.lit(0.0)).alias("score"))
