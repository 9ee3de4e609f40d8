"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words that ignores some of them, so that a
substituted word at an ignored place doesn't hide a match. Hashes of the kept words of
every place of the benchmark are joined with those of every place of the documents; each
hit names a document, an item and a shift between them. Around hits the aligned words
are compared, and the run with the best score (+1 for an equal word, -``PRICE`` for a
different one) must hold ``LEAST_WORDS`` equal words, or ``LEAST_SHARE`` of a shorter
item's words.

The documents are never shuffled: the benchmark is read in blocks of bounded size
(``BLOCK_BYTES``; copies of an item count once), each block travels to the tasks, and every
document passes every block. A larger benchmark means more blocks, not more memory: with
more than one, a block is read, run and its result written before the next is read, so that
driver and tasks hold one. That writes the documents once a block.

Defined results: null and empty texts match nothing; items with fewer than
``SHORTEST`` words are no evidence and match nothing; an empty benchmark matches
nothing; repeated items and rows are reported each; a document without an id is
reported with a null id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from riftlog.llm.text import Words, carried, mix, words_of
from riftlog.session import settle

#: Every overlap that ``verify`` accepts has one of these: the last words of a run, up to
#: the ``needed`` equal ones, score more than 0 from any of its words on, which leaves at
#: most 17 words and 851 patterns; these six masks meet each of them.
MASKS = ("10110111", "10010001111", "10100010111", "1101111", "110001111", "1110111")
LEAST_WORDS, LEAST_SHARE, SHORTEST, PRICE = 12, 0.8, 8, 2
BLOCK_BYTES = 4_000_000
ITEM_BYTES = 64  # what an item takes besides its text
HITS = "array<struct<item:long,matched_words:int,first_word:int,last_word:int>>"
_ODD = np.uint64(0x9FB21C651E98DF25)


def seeds(h: np.ndarray, row: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that the mask keeps at every place, and the places."""
    total = len(h) - len(mask) + 1
    if total <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        g = np.zeros(total, np.uint64)
        for j, kept in enumerate(mask):
            if kept == "1":
                g = g * _ODD + h[j : j + total]
    at = np.flatnonzero(row[:total] == row[len(mask) - 1 :])
    return mix(g[at]), at


class Index:
    """The seeds of one block of the benchmark."""

    def __init__(self, texts: list[str]):
        parts = list(words_of(pa.array(texts, pa.string())))
        self.hash = np.concatenate([p.hash for p in parts]) if parts else np.empty(0, np.uint64)
        self.item = np.concatenate([p.row + p.first for p in parts]) if parts else np.empty(0, np.int64)
        self.start = np.searchsorted(self.item, np.arange(len(texts) + 1))
        self.length = np.diff(self.start)
        self.needed = np.minimum(LEAST_WORDS, np.ceil(LEAST_SHARE * self.length)).astype(int)
        self.tables = []
        for mask in MASKS:
            g, at = seeds(self.hash, self.item, mask)
            good = self.length[self.item[at]] >= SHORTEST
            g, at = g[good], at[good]
            order = np.argsort(g, kind="stable")
            maybe = np.zeros(1 << 22, bool)
            maybe[(g & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
            self.tables.append((mask, g[order], at[order], maybe))

    def hits(self, words: Words) -> tuple[np.ndarray, ...]:
        """Verified overlaps: rows, items, equal words, first and last word in the row."""
        doc_at, item_at = [], []
        for mask, g, place, maybe in self.tables:
            own, at = seeds(words.hash, words.row, mask)
            if not len(own) or not len(g):
                continue
            likely = np.flatnonzero(maybe[(own & np.uint64((1 << 22) - 1)).astype(np.int64)])
            first = np.searchsorted(g, own[likely])
            many = np.searchsorted(g, own[likely], "right") - first
            doc_at.append(np.repeat(at[likely], many))
            item_at.append(place[np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)])
        if not doc_at:
            return (np.empty(0, np.int64),) * 5
        d, i = np.concatenate(doc_at), np.concatenate(item_at)
        # One candidate per row, item and shift.
        row, item = words.row[d], self.item[i]
        key = np.unique(np.stack([row, item, d - i], 1), axis=0) if len(d) else np.empty((0, 3), np.int64)
        parts = [self.verify(words, key[a : a + 20_000]) for a in range(0, len(key), 20_000)]
        if not parts:
            return (np.empty(0, np.int64),) * 5
        row, item, equal, first, last = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((first, -equal, item, row))
        row, item, equal, first, last = (x[order] for x in (row, item, equal, first, last))
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
        return row[new], item[new], equal[new], first[new], last[new]

    def verify(self, words: Words, key: np.ndarray) -> tuple[np.ndarray, ...]:
        row, item, shift = key.T
        a = np.maximum(self.start[item], words.row_start[row] - shift)
        b = np.minimum(self.start[item + 1], words.row_start[row + 1] - shift)
        score, equal, begin = np.zeros(len(key), int), np.zeros(len(key), int), a.copy()
        best, best_equal, best_a, best_b = score.copy(), equal.copy(), a.copy(), a.copy()
        for j in range(int((b - a).max()) if len(key) else 0):
            at = a + j
            live = at < b
            safe = np.where(live, at, a)
            same = live & (self.hash[safe] == words.hash[safe + shift])
            score = np.where(same, score + 1, score - PRICE)
            equal = equal + same
            lost = score < 0
            score[lost], equal[lost] = 0, 0
            begin = np.where(lost, at + 1, begin)
            better = live & (score > best)
            best = np.where(better, score, best)
            best_equal = np.where(better, equal, best_equal)
            best_a, best_b = np.where(better, begin, best_a), np.where(better, at, best_b)
        ok = best_equal >= self.needed[item]
        base = (shift - words.row_start[row])[ok]
        return row[ok], item[ok], best_equal[ok], best_a[ok] + base, best_b[ok] + base


def overlaps(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", keep: list[str] | None = None,
             item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, clean_only: bool = False) -> DataFrame:
    """``row`` (the columns ``keep``, all by default) and ``hits``: one (item,
    matched_words, first_word, last_word) per item that the document overlaps, at the
    place with most equal words; words from 0. With ``clean_only`` only rows without hits."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    # Copies of one item are one row with their number, so that hashing spreads all rows.
    items = items.groupBy("item", "text").agg(F.count(F.lit(1)).alias("copies"))
    size = items.agg(F.sum(F.octet_length("text") + F.lit(ITEM_BYTES))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    if blocks > 1:
        items = settle(items, "benchmark")
    payload, texts_of = carried(docs, text_col, keep)
    payload = payload.withColumn("hits", F.expr(f"cast(array() as {HITS})"))
    kind = pa.list_(pa.struct([("item", pa.int64()), ("matched_words", pa.int32()), ("first_word", pa.int32()), ("last_word", pa.int32())]))
    for block in range(blocks):
        # A block holds about block_bytes, however large the benchmark is.
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).orderBy("item", "text").collect()
        # Equal texts are compared once.
        ids: dict[str, list[tuple[int, int]]] = {}
        for r in own:
            ids.setdefault(r["text"], []).append((r["item"], r["copies"]))

        def run(batches: Iterator[pa.RecordBatch], ids=list(ids.values()), texts=list(ids)) -> Iterator[pa.RecordBatch]:
            index = Index(texts)
            for batch in batches:
                before = batch.column("hits").to_pylist()
                for words in words_of(texts_of(batch)):
                    found = before[words.first : words.first + words.rows]
                    for r, i, n, a, b in zip(*(x.tolist() for x in index.hits(words))):
                        found[r] = [*found[r], *({"item": item, "matched_words": n, "first_word": a, "last_word": b}
                                                 for item, copies in ids[i] for _ in range(copies))]
                    part = batch.slice(words.first, words.rows)
                    part = part.set_column(part.schema.get_field_index("hits"), "hits", pa.array(found, kind))
                    yield part.filter(pa.array([not f for f in found])) if clean_only else part

        payload = payload.mapInArrow(run, payload.schema)
        if blocks > 1:
            payload = settle(payload, "block")
    return payload.select("row", "hits")
