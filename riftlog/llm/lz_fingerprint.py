"""Document fingerprints by Lempel-Ziv phrases.

Each text is parsed into dictionary phrases (the next phrase is the shortest run of
characters that is no phrase yet). Texts that compress each other well share phrases;
the fingerprint keeps the ``KEEP`` smallest hashes of the phrase set, and the share of
common hashes among the smallest of two fingerprints estimates the likeness of the sets.

``neighbours`` also fingerprints an edited text per document, whose end comes from the
next document by descending id. Documents are dealt to ranges of ids, sorted, and read
as a stream; each range also gets a copy of the document that follows it. So every text
is shuffled once, and a task holds a few texts at a time, whatever the range holds. The
edited text shares its first half with the text itself: the parse is kept up to there,
and the dictionary entries that the second half added are taken back.

Defined results: a null text is empty; an empty text has the empty fingerprint, which
is like another empty one (1) and unlike all else (0); documents without an id
have no next one (it counts as empty); equal ids are ordered by text; a single document is its own next."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riftlog.llm.text import mix

KEEP = 64
_ODD = 0x9FB21C651E98DF25
_INVERSE = pow(_ODD, -1, 1 << 64)


class _Powers:
    def __init__(self, base: int) -> None:
        self.base, self.table = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            steps = np.full(max(n, 2 * len(self.table)), self.base, np.uint64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                self.table = np.cumprod(steps, dtype=np.uint64)
        return self.table[:n]


_up, _down = _Powers(_ODD), _Powers(_INVERSE)


def phrase_hashes(text: str, ends: list[int]) -> np.ndarray:
    """Hashes of the phrases of ``text`` that end at ``ends`` (ascending)."""
    if not ends:
        return np.empty(0, np.uint64)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    to = np.array(ends)
    begin = np.append(0, to[:-1])
    with np.errstate(over="ignore"):
        total = np.append(np.uint64(0), np.cumsum(mix(code) * _up.upto(len(code)), dtype=np.uint64))
        return mix((total[to] - total[begin]) * _down.upto(len(code))[begin])


def smallest(hashes: np.ndarray) -> np.ndarray:
    """The fingerprint as numbers: the smallest distinct 32-bit hashes."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    if len(short) > 4 * KEEP:  # equal phrases don't occur, equal hashes hardly
        short = np.partition(short, 2 * KEEP)[: 2 * KEEP]
    return np.unique(short)[:KEEP]


def parse(text: str, half: int = 0, other: str = "") -> tuple[list[int], list[int]]:
    """Ends of the phrases of ``text``, and of ``text`` with its last ``half``
    characters replaced by ``other``."""
    root: dict = {}
    node, ends, keep = root, [], len(text) - half
    for i, c in enumerate(text[:keep], 1):
        child = node.get(c)
        if child is None:
            node[c] = {}
            ends.append(i)
            node = root
        else:
            node = child
    there, shared, added = node, ends.copy(), []
    for i, c in enumerate(text[keep:], keep + 1):
        child = node.get(c)
        if child is None:
            node[c] = {}
            added.append((node, c))
            ends.append(i)
            node = root
        else:
            node = child
    for node, c in reversed(added):
        del node[c]
    node = there
    for i, c in enumerate(other, keep + 1):
        child = node.get(c)
        if child is None:
            node[c] = {}
            shared.append(i)
            node = root
        else:
            node = child
    return ends, shared


def fingerprint(text: str) -> np.ndarray:
    return smallest(phrase_hashes(text, parse(text)[0]))


def as_text(kept: np.ndarray) -> str:
    return kept.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:KEEP]
    return float((np.isin(both, a) & np.isin(both, b)).sum() / len(both))


def edited(text: str, following: str) -> tuple[str, int, str]:
    """The edited text, the characters replaced, and what replaces them."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half], half, following[:half]


class _Stream:
    """Reads sorted documents; gives a row once its next and that one's fingerprint are known."""

    def __init__(self) -> None:
        self.out: list[tuple] = []
        self.held: tuple[str, str] | None = None
        self.waiting: tuple | None = None

    def settle(self, kept: np.ndarray) -> None:
        if self.waiting:
            *row, own = self.waiting
            self.out.append((*row, likeness(own, kept)))
            self.waiting = None

    def push(self, doc_id, text: str, tail: bool) -> None:
        if self.held is not None:
            last_id, last = self.held
            changed, half, other = edited(last, text)
            ends, ends2 = parse(last, half, other)
            own, theirs = smallest(phrase_hashes(last, ends)), smallest(phrase_hashes(changed, ends2))
            self.settle(own)
            digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
            self.waiting = (last_id, len(last), digest, as_text(own), as_text(theirs), likeness(own, theirs), own)
        self.held = (doc_id, text)
        if tail:
            self.settle(fingerprint(text))
            self.held = None


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def neighbours(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: SCHEMA."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # The first id of each range: one number per partition.
    firsts = slim.where("id IS NOT NULL").select("id").repartitionByRange(ranges, F.col("id").desc()).groupBy(F.spark_partition_id()).agg(F.max("id").alias("id"))
    firsts = np.array(sorted(r["id"] for r in firsts.collect()), np.int64)
    n = len(firsts)

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        """The range of a document, and that before it if it is its range's first;
        the copy for the range before is marked by a negative number."""
        known = ids.to_numpy(np.int64)
        below = np.searchsorted(firsts, known)
        own = np.clip(n - below - 1, 0, n - 1)
        is_first = (below < n) & (firsts[np.minimum(below, n - 1)] == known)
        return pd.Series([[p, -1 - (p - 1) % n] if f else [p] for p, f in zip(own.tolist(), is_first)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, closed = _Stream(), False
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                for doc_id, text, tail in zip(*(part.column(c).to_pylist() for c in ("id", "text", "tail"))):
                    if not closed:  # of several documents with one id the first is the next
                        stream.push(doc_id, text, tail)
                        closed = tail
                if stream.out:
                    yield _batch(stream.out)
                    stream.out = []

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                stream = _Stream()
                stream.push(None, text, False)
                stream.push(None, "", True)
                yield _batch(stream.out)

    unnumbered = slim.where("id IS NULL").mapInArrow(alone, SCHEMA)
    if not n:
        return unnumbered
    dealt = slim.where("id IS NOT NULL").withColumn("place", F.explode(places("id")))
    place = F.when(F.col("place") < 0, -1 - F.col("place")).otherwise(F.col("place"))
    dealt = dealt.select("id", "text", place.alias("range"), (F.col("place") < 0).alias("tail"))
    dealt = dealt.repartitionById(n, F.col("range")).sortWithinPartitions("tail", F.col("id").desc(), "text")
    return dealt.mapInArrow(run, SCHEMA).unionByName(unnumbered)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
