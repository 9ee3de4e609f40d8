"""Quality by histogram gradient-boosted trees over statistics of documents.

Each whole text gives a row of numbers (lengths, kinds of characters, repetition of
words, phrases and lines). Trees of fixed depth are grown on binned numbers, as sums
of gradients per (node, bin), and flattened into arrays in heap order, so that scoring
is one array operation per level for all trees and rows of a batch.

The statistics are computed once for all documents and kept as a slim table; the fit
takes ``SAMPLE_ROWS`` labelled rows of it at the most.

Defined results: a null text counts as empty, and an empty one has statistics of its
own (all 0) and is scored; rows with a null label, or without a document, teach
nothing; of several labels of a document the smallest counts; without labels every
score is 0.5; repeated rows are scored each."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riftlog.llm.labelled import bounded_sample
from riftlog.llm.text import BYTE_HASH, _POWERS, carried, mix, words_of
from riftlog.session import settle

SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, RIDGE = 120, 4, 64, 0.1, 1.0
STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper", "digits", "blanks", "stops", "marks", "symbols", "beyond_ascii",
    "log_lines", "line_length", "distinct_words", "top_word", "repeated_trigrams", "repeated_lines", "longest_line",
    "short_lines", "letters", "one_letter_words", "words_per_stop", "ends_with_stop",
)


def _kinds(*chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in "".join(chars)]] = True
    return table


_UPPER = _kinds("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _kinds("abcdefghijklmnopqrstuvwxyz")
_DIGIT, _BLANK, _STOP, _MARK = _kinds("0123456789"), _kinds(" \t\r\n"), _kinds(".!?"), _kinds(",;:'\"()-")
_BEYOND = np.arange(256) >= 128
_SYMBOL = ~(_LETTER | _DIGIT | _BLANK | _STOP | _MARK | _BEYOND)


def _share(a, b):
    return np.divide(a, b, out=np.zeros(len(a)), where=np.asarray(b) > 0)


def _distinct(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and how often its most frequent value occurs."""
    if not len(row):
        return np.zeros(rows), np.zeros(rows)
    key = np.sort((row.astype(np.uint64) << np.uint64(44)) | (value >> np.uint64(20)))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    run = np.diff(np.append(first, len(key)))
    owner = (key[first] >> np.uint64(44)).astype(np.int64)
    most = np.zeros(rows)
    np.maximum.at(most, owner, run)
    return np.bincount(owner, minlength=rows).astype(float), most


def statistics(words) -> np.ndarray:
    """The numbers of STATISTICS for the rows of one piece of a batch."""
    raw, off, rows = words.raw, words.off, words.rows
    size = np.diff(off).astype(float)

    def count(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[raw], dtype=np.int64)])
        return np.diff(total[off]).astype(float)

    n_words = np.diff(words.row_start).astype(float)
    length = words.end - words.start
    letters, stops = count(_LETTER), count(_STOP)
    distinct, top = _distinct(words.row, words.hash, rows)
    trigrams, at = words.ngrams(3)
    distinct3, _ = _distinct(words.row[at], trigrams, rows)
    n_trigrams = np.maximum(n_words - 2, 0)
    # Lines: every newline ends one, and so does the row.
    cut = np.unique(np.concatenate([off, np.flatnonzero(raw == 10) + 1]))
    begin = cut[:-1]
    line_length = np.diff(cut)
    line_row = np.searchsorted(off, begin, "right") - 1
    if len(begin):
        powers = _POWERS.upto(int(line_length.max()))
        with np.errstate(over="ignore"):
            place = np.arange(len(raw)) - np.repeat(begin, line_length)
            line_hash = mix(np.add.reduceat(BYTE_HASH[raw] * powers[place], begin))
    else:
        line_hash = np.empty(0, np.uint64)
    n_lines = np.bincount(line_row, minlength=rows).astype(float)
    distinct_lines, _ = _distinct(line_row, line_hash, rows)
    longest = np.zeros(rows)
    np.maximum.at(longest, line_row, line_length)
    ends = np.zeros(rows)
    filled = np.flatnonzero(size > 0)
    ends[filled] = _STOP[raw[off[filled + 1] - 1]]
    columns = [
        np.log1p(size), np.log1p(n_words), _share(np.bincount(words.row, length, rows), n_words), _share(count(_UPPER), letters),
        _share(count(_DIGIT), size), _share(count(_BLANK), size), _share(stops, size), _share(count(_MARK), size),
        _share(count(_SYMBOL), size), _share(count(_BEYOND), size), np.log1p(n_lines), _share(size, n_lines),
        _share(distinct, n_words), _share(top, n_words), _share(n_trigrams - distinct3, n_trigrams),
        _share(n_lines - distinct_lines, n_lines), _share(longest, size),
        _share(np.bincount(line_row, line_length < 40, rows), n_lines), _share(letters, size),
        _share(np.bincount(words.row, length == 1, rows), n_words), _share(n_words, stops + 1), ends,
    ]
    return np.stack(columns, 1)


def document_statistics(docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` and ``x``, the statistics, of every document."""
    payload, texts_of = carried(docs, text_col, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(texts_of(batch)):
                x = statistics(words).astype(np.float32)
                flat = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(words.first, words.rows), flat], names=["row", "x"])

    return payload.mapInArrow(run, payload.select("row").schema.add("x", T.ArrayType(T.FloatType())))


@dataclass
class Trees:
    """Trees in heap order: the children of node i are 2i + 1 and 2i + 2."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray
    value: np.ndarray  # (trees, leaves)

    def raw_scores(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))
        out = np.full(len(x), self.base)
        for a in range(0, len(x), 4096):
            part = x[a : a + 4096]
            node = np.zeros((len(part), len(trees)), np.int64)
            rows = np.arange(len(part))[:, None]
            for _ in range(DEPTH):
                right = part[rows, self.feature[trees, node]] > self.threshold[trees, node]
                node = 2 * node + 1 + right
            out[a : a + 4096] += self.value[trees, node - (2**DEPTH - 1)].sum(1)
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw_scores(x)))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosting on the logistic loss with second-order gains."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    empty = Trees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, leaves)))
    if not len(y):
        return empty
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    empty.base = float(np.log(mean / (1 - mean)))
    if y.min() == y.max():
        return empty
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    n_features, score = x.shape[1], np.full(len(y), empty.base)
    features, thresholds, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            width, first = 2**level, 2**level - 1
            best = np.zeros(width)
            cut = np.full(width, BINS)
            pick = np.zeros(width, np.int64)
            at = (node - first) * BINS
            for f in range(n_features):
                gs = np.bincount(at + binned[:, f], g, width * BINS).reshape(width, BINS).cumsum(1)
                hs = np.bincount(at + binned[:, f], h, width * BINS).reshape(width, BINS).cumsum(1)
                total_g, total_h = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + RIDGE) + (total_g - gs) ** 2 / (total_h - hs + RIDGE) - total_g**2 / (total_h + RIDGE)
                gain[(hs < 1) | (total_h - hs < 1)] = 0
                where = gain.argmax(1)
                most = gain[np.arange(width), where]
                better = most > best + 1e-9
                best[better], cut[better], pick[better] = most[better], where[better], f
            for i in range(width):
                feature[first + i] = pick[i]
                if cut[i] < len(edges[pick[i]]):
                    threshold[first + i] = edges[pick[i]][cut[i]]
            right = binned[np.arange(len(y)), pick[node - first]] > cut[node - first]
            node = 2 * node + 1 + right
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + RIDGE)
        score += value[leaf]
        features.append(feature), thresholds.append(threshold), values.append(value)
    return Trees(empty.base, np.array(features), np.array(thresholds), np.array(values))


def fit(stats: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality", where: Column | None = None) -> Trees:
    """Learn from a bounded sample; ``stats`` has (row.<id_col>, x)."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known if where is None else known.where(where)
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("_y"))
    known = bounded_sample(known, F.col("_id"), SAMPLE_ROWS)  # bounded, so that it can be broadcast
    rows = stats.select(F.col(f"row.{id_col}").alias("_id"), "x").join(F.broadcast(known), "_id").orderBy("_id").select("_y", "x").toArrow()
    y = rows.column("_y").to_numpy().astype(float)
    flat = rows.column("x").combine_chunks()
    x = flat.flatten().to_numpy(zero_copy_only=False) if len(flat) else np.empty(0, np.float32)
    return fit_trees(x.reshape(-1, len(STATISTICS)), y)


def score(stats: DataFrame, model: Trees) -> DataFrame:
    """``row`` and ``quality``, the probability of label 1, of every row of ``stats``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.scores(x), pa.float64())], names=["row", "quality"])

    return stats.mapInArrow(run, stats.select("row").schema.add("quality", "double"))


def classify(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", where: Column | None = None) -> DataFrame:
    """Statistics, fit and scores: (row.<id_col>, quality) of every document."""
    stats = settle(document_statistics(docs, text_col=text_col, keep=[id_col]), "statistics")
    return score(stats, fit(stats, labels, id_col=id_col, where=where))
