"""Near-duplicates by DartMinHash signatures, banded joins and an exact check.

Signatures. Every element of a weighted set owns a strip of a plane as wide as its
weight. Darts thrown by hashing land in unit cells (weight x rank, a Poisson number in
each); a set catches those within its strips and below a rank that lets about
``k (ln k + 2)`` through. Each dart names one of the k coordinates, and a coordinate
keeps its earliest dart, so two sets agree in a coordinate with the probability of
their weighted Jaccard similarity. Sets that leave a coordinate empty throw again, to
twice the rank. The work is the elements plus k ln k darts, not their product.

Duplicates. Elements are distinct five-word shingles (the whole text, if shorter). Texts
with equal shingle sets are one class, which collapses copies before anything is
compared. Classes that share one of ``BANDS`` bands of ``ROWS`` coordinates are
candidates (at similarity 0.8 two classes miss each other with probability 2e-5);
candidates are joined to neighbourhoods, and inside these all similarities are computed
exactly from the shingle sets, by blocks of ``BLOCK`` classes: a task sees two blocks at
the most, and returns a spanning forest of its links of 0.8 or more, so that no link
between different texts is lost and no list of pairs is made. Groups are the components
of the links.

Hot groups: copies are combined on the map side; a band shared by very many classes
gives one link per class to the smallest of them; neighbourhoods are split in blocks.
A neighbourhood of n different texts costs n / BLOCK copies of each of their sets, which
is the price of comparing all of them.

Defined results: a null text is like nothing, and so is a row without an id, and each
such row is its own group; texts without words are alike only if they are equal; repeated rows are copies; ties go to
the smallest id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riftlog.llm.components import components
from riftlog.llm.text import Words, mix, words_of
from riftlog.operators.lookups import lookup_join
from riftlog.session import settle

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 36, 6
BLOCK = 256
CELLS = 1_000_000  # thrown at once
COLUMNS = 4096  # of the incidence matrix at once

_U = np.uint64
_LOW44 = _U((1 << 44) - 1)
_POISSON = np.cumsum([np.exp(-1) / np.prod(np.arange(1, i + 1, dtype=float)) for i in range(20)])


def throw(element: np.ndarray, weight: np.ndarray, rank: np.ndarray, owner: np.ndarray, k: int, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """The earliest darts per (owner, coordinate): their names, and whether there is one.
    ``rank`` is the limit for each element's owner."""
    levels, widths = np.ceil(rank).astype(np.int64), np.ceil(weight).astype(np.int64)
    cells = levels * widths
    at = np.repeat(np.arange(len(element)), cells)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
    level, column = nth % levels[at], nth // levels[at]
    with np.errstate(over="ignore"):
        seed = mix(element[at] + mix((column.astype(_U) << _U(32)) | level.astype(_U)))
    many = np.searchsorted(_POISSON, (seed >> _U(11)).astype(float) / float(1 << 53))
    dart = np.repeat(np.arange(len(at)), many)
    nth = np.arange(len(dart)) - np.repeat(np.cumsum(many) - many, many)
    with np.errstate(over="ignore"):
        name = mix(seed[dart] + (nth.astype(_U) + _U(1)) * _U(0xD6E8FEB86659FD93))
    place = (level[dart].astype(_U) << _U(32)) | (name >> _U(32))
    own = at[dart]
    caught = place.astype(float) <= rank[own] * float(1 << 32)
    if (weight != widths).any():  # a strip may end inside a cell
        caught &= column[dart] + (mix(name) >> _U(11)).astype(float) / float(1 << 53) <= weight[own]
    name, place, own = name[caught], place[caught], own[caught]
    slot = owner[own] * k + ((name & _U(0xFFFFFFFF)) % _U(k)).astype(np.int64)
    first = np.full(owners * k, np.iinfo(np.uint64).max, _U)
    np.minimum.at(first, slot, place)
    winner = place == first[slot]
    names = np.zeros(owners * k, _U)
    names[slot[winner]] = mix(name[winner])
    return names.reshape(owners, k), (first != np.iinfo(np.uint64).max).reshape(owners, k)


def signatures(element: np.ndarray, weight: np.ndarray, start: np.ndarray, k: int) -> np.ndarray:
    """(sets, k) names of darts; the elements of set i are start[i] .. start[i + 1].
    Sets without elements have zeros."""
    sets = len(start) - 1
    out = np.zeros((sets, k), _U)
    size = np.diff(start)
    total = np.add.reduceat(np.append(weight, 0.0), start[:-1]) * (size > 0) if sets else np.zeros(0)
    left, factor = np.flatnonzero(size > 0), 1.0
    while len(left):
        rank = factor * k * (np.log(k) + 2) / total[left]
        work = np.cumsum(size[left] * np.ceil(rank))
        again = []
        a = 0
        while a < len(left):
            b = max(a + 1, int(np.searchsorted(work, (work[a - 1] if a else 0) + CELLS, "right")))
            own = left[a:b]
            which = np.repeat(np.arange(len(own)), size[own])
            at = np.arange(len(which)) - np.repeat(np.cumsum(size[own]) - size[own], size[own]) + np.repeat(start[own], size[own])
            names, full = throw(element[at], weight[at], rank[a:b][which], which, k, len(own))
            done = full.all(1)
            out[own[done]] = names[done]
            again.append(own[~done])
            a = b
        left, factor = np.concatenate(again), factor * 2
    return out


def shingle_sets(words: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, ascending (44-bit numbers), and where each row's begin."""
    g, at = words.ngrams(n)
    row = words.row[at]
    length = np.diff(words.row_start)
    for r in np.flatnonzero((length > 0) & (length < n)):
        with np.errstate(over="ignore"):
            own = words.hash[words.row_start[r] : words.row_start[r + 1]]
            h = mix(np.add.reduce(mix(own + np.arange(len(own), dtype=_U)), keepdims=True) + _U(len(own)))
        g, row = np.append(g, h), np.append(row, r)
    key = np.unique((row.astype(_U) << _U(44)) | (g >> _U(20)))
    owner = (key >> _U(44)).astype(np.int64)
    return key & _LOW44, np.searchsorted(owner, np.arange(words.rows + 1))


def set_hashes(words: Words, element: np.ndarray, start: np.ndarray) -> np.ndarray:
    """One number per row, equal for equal sets; rows without words go by their bytes."""
    with np.errstate(over="ignore"):
        total = np.append(_U(0), np.cumsum(mix(element + _U(0x5851F42D4C957F2D)), dtype=_U))
        h = mix(total[start[1:]] - total[start[:-1]] + np.diff(start).astype(_U))
        for r in np.flatnonzero(np.diff(start) == 0):
            raw = words.raw[words.off[r] : words.off[r + 1]]
            h[r] = mix(np.add.reduce(mix(raw.astype(_U) * _U(0x9FB21C651E98DF25) + np.arange(len(raw), dtype=_U)), keepdims=True) + _U(len(raw) + (1 << 40)))[0]
    return h


def band_keys(names: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = np.arange(bands, dtype=_U)[None, :] * _U(0xA0761D6478BD642F) + np.zeros((len(names), 1), _U)
        for j in range(rows):
            key = mix(key + names[:, j : bands * rows : rows])
    return key


def sketch(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """(id, text, class, bands) of every document with an id and a text, whose hash is given."""
    known = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).dropna()
    known = known.withColumn("hash", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text")):
                element, start = shingle_sets(words)
                names = signatures(element, np.ones(len(element)), start, bands * rows)
                keys = band_keys(names, bands, rows).view(np.int64)
                size = np.where(np.diff(start) > 0, bands, 0)  # texts without words have no bands
                flat = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(keys[size > 0].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(words.first, words.rows) for c in ("id", "hash")), pa.array(set_hashes(words, element, start).view(np.int64)), flat],
                    names=["id", "text", "class", "bands"],
                )

    return known.mapInArrow(run, "id long, text long, class long, bands array<long>")


def links_within(names: list[int], sets: list[np.ndarray], split: int, threshold: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with Jaccard similarity of at least ``threshold``.
    With ``split`` only pairs of one of the first ``split`` sets and one of the others."""
    n = len(names)
    if n < 2:
        return []
    size = np.array([len(s) for s in sets], np.int64)
    value, owner = np.concatenate(sets), np.repeat(np.arange(n), size)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    new = np.append(True, value[1:] != value[:-1])
    column = np.cumsum(new) - 1
    common = np.bincount(column)[column] > 1  # a shingle of one text alone joins nothing
    column, owner = column[common], owner[common]
    if len(column):
        column = np.cumsum(np.append(False, column[1:] != column[:-1]))
    both = np.zeros((n, n))
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, [a, a + COLUMNS])
        part = np.zeros((n, min(COLUMNS, int(column[-1]) + 1 - a)), np.float32)
        part[owner[lo:hi], column[lo:hi] - a] = 1
        both += part @ part.T
    union = size[:, None] + size[None, :] - both
    near = np.triu(both >= threshold * union - 1e-9, 1) & (both > 0)
    if split:
        near[:split, :split] = False
        near[split:, split:] = False
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for a, b in np.argwhere(near).tolist():
        x, y = find(a), find(b)
        if x != y:
            root[x] = y
            found.append((names[a], names[b]))
    return found


def grouped(docs: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD,
            bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """One row per document with an id and a text: id, text (its hash), copy_id, group_id
    and group_text, the smallest id of the group with the smallest of its texts there."""
    own = settle(sketch(docs, id_col, text_col, bands, rows), "sketch")
    classes = settle(own.groupBy("class").agg(F.min(F.struct("id", "text", "bands")).alias("first")).select("class", F.col("first.id").alias("id"), F.col("first.text").alias("text"), "first.bands"), "classes")
    banded = classes.select("class", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("class").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    candidates = banded.join(shared, "band").where("class <> least").select(F.col("class").alias("u"), F.col("least").alias("v"))
    hoods = settle(components(candidates), "hoods")
    sizes = hoods.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    members = hoods.join(sizes, "component").select(F.col("node").alias("class"), "component", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    members = members.join(classes.select("class", "id"), "class")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).dropna().join(members, "id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text")):
                element, start = shingle_sets(words)
                short = (element >> _U(12)).astype(np.uint32)
                part = batch.slice(words.first, words.rows)
                ok = pa.array(set_hashes(words, element, start).view(np.int64) == part.column("class").to_numpy())
                out = [short[a:b].tobytes() for a, b in zip(start[:-1], start[1:])]
                # A repeated id may stand for another text too; its own class counts.
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("class", "component", "blocks", "block")), pa.array(out, pa.binary())],
                                                 names=["class", "component", "blocks", "block", "shingles"]).filter(ok)

    found = texts.select("class", "component", "blocks", "block", "text").mapInArrow(sets, "class long, component long, blocks int, block int, shingles binary")
    # Every pair of blocks is a task's work; a neighbourhood of one block meets itself only.
    found = found.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    found = found.select("class", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "shingles")
    found = found.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "block", "class")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, held, split = None, [], [], 0
        out: list[tuple[int, int]] = []

        def close() -> None:
            if key is not None:
                out.extend(links_within(names, held, split if key[1] != key[2] else 0, threshold))

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in (0, 1)], names=["u", "v"])
            out.clear()
            return batch

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("component", "i", "j", "block", "class", "shingles"))
            for component, i, j, block_, name, shingles in zip(*columns):
                if (component, i, j) != key:
                    close()
                    key, names, held, split = (component, i, j), [], [], 0
                if names and names[-1] == name:
                    continue  # a repeated row
                names.append(name)
                held.append(np.frombuffer(shingles, np.uint32))
                split += block_ == i
            yield flush()
        close()
        yield flush()

    linked = components(found.mapInArrow(compare, "u long, v long"))
    groups = classes.select("class", "id", "text").join(linked.withColumnRenamed("node", "class"), "class", "left").select("class", "id", "text", F.coalesce("component", "class").alias("group"))
    groups = settle(groups, "groups")
    first = groups.groupBy("group").agg(F.min(F.struct("id", "text")).alias("first"))
    named = groups.join(first, "group").select("class", F.col("id").alias("copy_id"), F.col("first.id").alias("group_id"), F.col("first.text").alias("group_text"))
    return own.select("id", "text", "class").join(named, "class").select("id", "text", "copy_id", "group_id", "group_text")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, copy_id (smallest id with the same shingle set), group_id
    (smallest id among all linked, directly or not)."""
    found = grouped(docs, id_col, text_col, **options).select("id", "copy_id", "group_id")
    own_id = F.col(id_col).cast("long")
    alone = docs.where(own_id.isNull() | F.col(text_col).cast("string").isNull())
    return found.unionByName(alone.select(own_id.alias("id"), own_id.alias("copy_id"), own_id.alias("group_id")))


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without near-duplicates: of each group the row with the smallest id stays,
    of several texts under that id the one of the smallest hash, and of repeated rows one.
    Another text under a dropped id is judged by itself. Rows without an id or a text stay."""
    found = settle(grouped(docs, id_col, text_col, **options), "found")
    drop = found.where("id <> group_id OR text <> group_text").select(F.col("id").alias("_id"), F.col("text").alias("_text")).distinct()
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("_id"),
        F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("_text"), F.col(f"`{text_col}`").isNull().alias("_none"),
    )
    kept = lookup_join(own, settle(drop, "drop"), ["_id", "_text"], "left_anti", ["_id", "_text"])
    if found.groupBy("id", "text").count().where("count > 1").isEmpty():
        return kept.select("row.*")
    known = F.col("_id").isNotNull() & ~F.col("_none")
    one = kept.where(known).dropDuplicates(["_id", "_text"]).select("row.*")
    return one.unionByName(kept.where(~known).select("row.*"))
