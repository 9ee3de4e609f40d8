"""Toxicity by multiple-instance learning: sentence scores under a noisy-or.

Only documents are labelled, while toxicity sits in sentences. A sentence holding
words of the learned vocabulary is toxic with probability sigmoid(b + sum of its
words' weights); one without any is not evidence. A document is toxic unless all its
sentences and a small constant leak stay silent:

    score = 1 - (1 - leak) * product over sentences of (1 - p)

Weights, bias and leak are fitted by the likelihood of the document labels, so that
blame falls on sentences although none was ever labelled. Scoring also returns the
offending sentences.

The fit takes ``SAMPLE_ROWS`` labelled documents at the most and about ``SAMPLE_BYTES``
of text; scoring is one narrow pass over whole texts without a shuffle.

Defined results: a null or empty text scores the leak; rows with a null label, or
without a document, teach nothing; a document with several labels counts as toxic if
any of them says so; without both kinds of labels every score is the leak, which is
then the share of toxic labels (0 without labels); repeated rows are scored each."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riftlog.llm.labelled import bounded_sample, fold
from riftlog.llm.text import Words, carried, words_of

SAMPLE_ROWS = 8_000
SAMPLE_BYTES = 24_000_000
#: A word enters the vocabulary if this many sampled toxic documents hold it, if this
#: share of its documents (with one more of either kind) is toxic, and if its shares
#: among toxic and other documents differ by this many standard errors; of these, the
#: words with the greatest differences are the features of the model.
LEAST_DOCS, LEAST_SHARE, LEAST_Z, MOST_WORDS = 5, 0.6, 5.0, 100
STEPS, RATE, RIDGE = 400, 0.05, 1e-4
OFFENDING = 0.5

_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


def sentence_numbers(words: Words) -> np.ndarray:
    """For each word the number of its sentence, counted over all rows."""
    stops = np.flatnonzero(_STOP[words.raw])
    at = words.off[words.row] + words.start
    new = np.ones(len(at), bool)
    if len(at):
        before = np.searchsorted(stops, at)
        new[1:] = (before[1:] != before[:-1]) | (words.row[1:] != words.row[:-1])
    return np.cumsum(new) - 1


@dataclass
class Model:
    words: np.ndarray  # sorted word hashes
    weights: np.ndarray
    bias: float
    leak: float

    def __post_init__(self) -> None:
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.words & np.uint64(0xFFFF)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the word hashes are in the vocabulary, and their numbers there."""
        at = np.flatnonzero(self.maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
        if not len(self.words) or not len(at):
            return at[:0], at[:0]
        number = np.minimum(np.searchsorted(self.words, h[at]), len(self.words) - 1)
        real = self.words[number] == h[at]
        return at[real], number[real]

    def sentences(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sentences with evidence: their rows, first and last words (within the row), p."""
        at, number = self.find(words.hash)
        if not len(at):
            none = np.empty(0, np.int64)
            return none, none, none, np.empty(0)
        sentence = sentence_numbers(words)
        pairs = np.unique(sentence[at] * np.int64(len(self.words)) + number)
        holders, first = np.unique(pairs // len(self.words), return_index=True)
        z = self.bias + np.add.reduceat(self.weights[pairs % len(self.words)], first)
        begin = np.searchsorted(sentence, holders)
        last = np.searchsorted(sentence, holders, "right") - 1
        row = words.row[begin]
        return row, begin - words.row_start[row], last - words.row_start[row], _sigmoid(z)


def _sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(z)))


def _softplus(z):
    return np.logaddexp(0, z)


def vocabulary(hashes: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Words that mark toxic documents; ``hashes`` lists the words of each document."""
    own = [np.unique(h) for h in hashes]
    h, doc = np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own])
    if not len(h):
        return h
    order = np.argsort(h, kind="stable")
    h, bad = h[order], toxic[doc[order]]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    word = h[first]
    yes = np.add.reduceat(bad, first)
    no = np.diff(np.append(first, len(h))) - yes
    n_yes, n_no = max(toxic.sum(), 1), max((1 - toxic).sum(), 1)
    p, q, both = yes / n_yes, no / n_no, (yes + no) / (n_yes + n_no)
    z = (p - q) / np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n_yes + 1 / n_no))
    fit_ = np.flatnonzero((yes >= LEAST_DOCS) & (z >= LEAST_Z) & ((yes + 1) / (yes + no + 2) >= LEAST_SHARE))
    return np.sort(word[fit_[np.argsort(-z[fit_], kind="stable")[:MOST_WORDS]]])


def fit_noisy_or(n_words: int, doc: np.ndarray, bag: np.ndarray, word: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Weights, bias and leak by Adam on the likelihood. ``bag`` numbers sentences with
    evidence, ``word`` is a word of that sentence, ``doc`` the document of each ``bag``."""
    n_bags = len(doc)
    theta = np.zeros(n_words + 2)
    theta[:n_words], theta[n_words], theta[n_words + 1] = 1.0, -3.0, -3.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, b, leak = theta[:n_words], theta[n_words], theta[n_words + 1]
        z = b + np.bincount(bag, w[word], n_bags)
        silent = _softplus(leak) + np.bincount(doc, _softplus(z), len(toxic))  # -log(1 - score)
        pull = np.where(toxic == 1, -1 / np.expm1(np.clip(silent, 1e-9, 50)), 1.0) / len(toxic)
        dz = pull[doc] * _sigmoid(z)
        grad = np.concatenate([np.bincount(word, dz[bag], n_words) + RIDGE * w, [dz.sum(), pull.sum() * _sigmoid(leak)]])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[:n_words], float(theta[n_words]), float(_sigmoid(theta[n_words + 1]))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        where: Column | None = None) -> Model:
    """Learn from the labelled documents (of those rows of ``labels`` that ``where`` keeps)."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known if where is None else known.where(where)
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    slim = docs.select(F.col(id_col).alias("_id"), F.octet_length(text_col).alias("_n"))
    known = bounded_sample(known, F.col("_id"), SAMPLE_ROWS)  # bounded, so that it can be broadcast
    total, rows = slim.join(F.broadcast(known), "_id").agg(F.sum("_n"), F.count(F.lit(1))).first()
    if total and total > SAMPLE_BYTES:
        known = bounded_sample(known, F.col("_id"), int(rows * SAMPLE_BYTES / total), seed=1)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t")).join(F.broadcast(known), "_id")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("_y").to_numpy(zero_copy_only=False)
            for words in words_of(batch.column("_t")):
                sentence = sentence_numbers(words).astype(np.int32)
                cut = words.row_start
                out = [(words.hash[a:b].tobytes(), (sentence[a:b] - (sentence[a] if a < b else 0)).tobytes()) for a, b in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(y[words.first : words.first + words.rows], pa.int32()), pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary())],
                    names=["y", "words", "sentences"],
                )

    # Copies of one text are one witness.
    rows = texts.select("_y", "_t").mapInArrow(bags, "y int, words binary, sentences binary").dropDuplicates(["y", "words"]).toArrow()
    toxic = rows.column("y").to_numpy().astype(float)
    if not len(toxic) or toxic.min() == toxic.max():
        return Model(np.empty(0, np.uint64), np.empty(0), 0.0, float(toxic.mean()) if len(toxic) else 0.0)
    hashes = [np.frombuffer(x, np.uint64) for x in rows.column("words").to_pylist()]
    sentences = [np.frombuffer(x, np.int32) for x in rows.column("sentences").to_pylist()]
    words = vocabulary(hashes, toxic)
    model = Model(words, np.zeros(len(words)), 0.0, 0.0)
    bag, number, doc, bags_before = [], [], [], 0
    for d, (h, sentence) in enumerate(zip(hashes, sentences)):
        at, n = model.find(h)
        bag.append(sentence[at].astype(np.int64) + bags_before)
        number.append(n)
        doc.append(np.full(len(n), d))
        bags_before += int(sentence[-1]) + 1 if len(sentence) else 0
    pairs = np.unique(np.stack([np.concatenate(x) for x in (bag, number, doc)], 1), axis=0)
    _, first, place = np.unique(pairs[:, 0], return_index=True, return_inverse=True)
    model.weights, model.bias, model.leak = fit_noisy_or(len(words), pairs[first, 2], place, pairs[:, 1], toxic)
    return model


def score(docs: DataFrame, model: Model, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, all by default), ``toxicity`` and ``offending``: the
    sentences with p of at least 0.5, as (first_word, last_word, score), words from 0."""
    payload, texts_of = carried(docs, text_col, keep)
    spans = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(texts_of(batch)):
                row, first, last, p = model.sentences(words)
                silent = np.bincount(row, -np.log1p(-np.minimum(p, 1 - 1e-12)), words.rows)
                found: list[list] = [[] for _ in range(words.rows)]
                for i in np.flatnonzero(p >= OFFENDING):
                    found[row[i]].append({"first_word": int(first[i]), "last_word": int(last[i]), "score": float(p[i])})
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(words.first, words.rows), pa.array(1 - (1 - model.leak) * np.exp(-silent)), pa.array(found, spans)],
                    names=["row", "toxicity", "offending"],
                )

    added = T.StructType.fromDDL("toxicity double, offending array<struct<first_word:bigint,last_word:bigint,score:double>>")
    return payload.mapInArrow(run, T.StructType(payload.select("row").schema.fields + added.fields))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the rows of ``labels`` whose fold isn't held out."""
    return fit(docs, labels, where=fold(F.col("doc_id")) != 1)
