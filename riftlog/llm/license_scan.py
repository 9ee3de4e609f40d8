"""License scans: exact phrases, and an exact set-similarity join with templates.

A block of a text is any run of as many words as a template's length divided by the
threshold. A block meets a template if it holds at least ``threshold`` of the template's
distinct words. The join is exact:

* template words are ordered by their frequency in the whole corpus, rarest first;
* prefix filter: a block that holds ``o`` of the ``n`` words holds one of the first
  ``n - o + 1``; only blocks around such a word are looked at;
* length filter: a text with fewer than ``o`` words has no such block;
* positional filter: of the template's words, those before the prefix word in the order
  are already known to be missing, so ``n`` minus its place must still reach ``o``;
* what remains is counted word by word.

Templates are few and given; they travel with the task. The corpus counts are sums over
all documents, of template words only. Nothing is shuffled but these sums.

Defined results: null and empty texts have no words and no labels, score 0; a template
without words is ignored; repeated rows are scanned each; very long texts are whole."""

from __future__ import annotations

import math
from collections import Counter, defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from riftlog.llm.text import Words, carried, hash_words, words_of

PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
TEMPLATES = {
    "mit": ("released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    "apache-2": ("licensed under the apache license version 2 0",),
    "cc-by-nc": ("licensed under cc by nc 4 0",),
    "gpl-3": ("this work is licensed under the gnu general public license version 3",),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted",),
    "mpl-2": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
}
THRESHOLD = 0.9


class Vocabulary:
    """Numbers of some words, found in arrays of word hashes."""

    def __init__(self, texts: list[str]):
        found = [hash_words(t) for t in texts]
        self.words = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.words & np.uint64(0xFFFF)).astype(np.int64)] = True

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """For each hash its number, or -1."""
        out = np.full(len(h), -1, np.int32)
        at = np.flatnonzero(self.maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
        if len(at) and len(self.words):
            n = np.minimum(np.searchsorted(self.words, h[at]), len(self.words) - 1)
            real = self.words[n] == h[at]
            out[at[real]] = n[real]
        return out


def word_frequencies(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> np.ndarray:
    """How often each word of the vocabulary occurs in all documents."""
    payload, texts_of = carried(docs, text_col, [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary.words), np.int64)
        for batch in batches:
            for words in words_of(texts_of(batch)):
                n = vocabulary.numbers(words.hash)
                total += np.bincount(n[n >= 0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["word", "n"])

    sums = payload.select("text").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    out = np.zeros(len(vocabulary.words), np.int64)
    for r in sums.collect():  # one row per word of the templates
        out[r["word"]] = r["n"]
    return out


class Template:
    def __init__(self, label: str, text: str, vocabulary: Vocabulary, frequency: np.ndarray, threshold: float):
        numbers = vocabulary.numbers(hash_words(text))
        self.label, self.size = label, math.ceil(len(numbers) / threshold - 1e-9)
        self.words = sorted(set(numbers.tolist()), key=lambda w: (frequency[w], w))
        self.needed = math.ceil(threshold * len(self.words) - 1e-9)
        self.prefix = np.array([w for place, w in enumerate(self.words) if len(self.words) - place >= self.needed])
        self.member = np.zeros(len(vocabulary.words), bool)
        self.member[self.words] = True

    def best(self, number: np.ndarray, places: np.ndarray) -> int:
        """The most distinct template words in any block that holds one of ``places``
        (ascending positions of prefix words); ``number`` are the row's words."""
        most, n, k = 0, len(number), 0
        while k < len(places):
            a = max(places[k] - self.size + 1, 0)
            b = min(places[k] + self.size, n)
            while k + 1 < len(places) and places[k + 1] < b:  # overlapping surroundings are walked once
                k += 1
                b = min(places[k] + self.size, n)
            k += 1
            window, inside = deque(), Counter()
            at = a + np.flatnonzero((number[a:b] >= 0) & self.member[number[a:b]])
            for i in at.tolist():
                w = int(number[i])
                window.append((i, w))
                inside[w] += 1
                while window[0][0] <= i - self.size:
                    old = window.popleft()[1]
                    inside[old] -= 1
                    if not inside[old]:
                        del inside[old]
                most = max(most, len(inside))
        return most


def scan(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None, phrases: dict[str, str] = PHRASES,
         templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``row`` (the columns ``keep``, all by default), ``n_words``, ``n_base`` (places of
    phrases), ``first_word`` and ``last_word`` (of their starts, words from 0),
    ``base_labels``, ``labels`` (with those of met templates), ``score`` (the highest
    containment of a template in a block; 1 where a phrase stands)."""
    vocabulary = Vocabulary([*phrases, *(t for ts in templates.values() for t in ts)])
    frequency = word_frequencies(docs, vocabulary, text_col)
    exact = [(vocabulary.numbers(hash_words(p)), label) for p, label in phrases.items()]
    wanted = [Template(label, t, vocabulary, frequency, threshold) for label, ts in templates.items() for t in ts if len(hash_words(t))]
    payload, texts_of = carried(docs, text_col, keep)

    def piece(words: Words) -> dict[str, list]:
        number = vocabulary.numbers(words.hash)
        n_words = np.diff(words.row_start)
        starts, base, labels = defaultdict(list), defaultdict(set), defaultdict(set)
        score = np.zeros(words.rows)
        known = np.flatnonzero(number >= 0)
        for pattern, label in exact:
            at = known[number[known] == pattern[0]]
            at = at[at + len(pattern) <= len(number)]
            for j, w in enumerate(pattern):
                at = at[number[at + j] == w]
            at = at[words.row[at] == words.row[at + len(pattern) - 1]]
            for i in at.tolist():
                r = int(words.row[i])
                starts[r].append(i - int(words.row_start[r]))
                base[r].add(label)
                score[r] = 1.0
        for t in wanted:
            at = known[np.isin(number[known], t.prefix)]
            rows, first = np.unique(words.row[at], return_index=True)
            for r, a, b in zip(rows.tolist(), first, np.append(first[1:], len(at))):
                if n_words[r] < t.needed:
                    continue
                own = number[words.row_start[r] : words.row_start[r + 1]]
                found = t.best(own, at[a:b] - words.row_start[r])
                score[r] = max(score[r], found / len(t.words))
                if found >= t.needed:
                    labels[r].add(t.label)
        rows = range(words.rows)
        return {
            "n_words": n_words.tolist(),
            "n_base": [len(starts[r]) if r in starts else 0 for r in rows],
            "first_word": [min(starts[r]) if r in starts else None for r in rows],
            "last_word": [max(starts[r]) if r in starts else None for r in rows],
            "base_labels": [",".join(sorted(base[r])) if r in base else "" for r in rows],
            "labels": [",".join(sorted((base[r] if r in base else set()) | (labels[r] if r in labels else set()))) for r in rows],
            "score": score.tolist(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        for batch in batches:
            for words in words_of(texts_of(batch)):
                out = piece(words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(words.first, words.rows), *[pa.array(v, k) for v, k in zip(out.values(), kinds)]],
                    names=["row", *out],
                )

    added = T.StructType.fromDDL(
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    )
    return payload.mapInArrow(run, T.StructType(payload.select("row").schema.fields + added.fields))
