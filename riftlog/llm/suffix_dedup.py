"""Repeated passages by sparse suffix arrays.

A suffix is retained where its first ``SEED`` words have the smallest hash of a window
of ``LENGTH - SEED + 1`` such places, so every run of ``LENGTH`` words holds exactly one
retained place of its own, the same wherever the run occurs. Retained suffixes carry the
words around them that a run of ``LENGTH`` words through them can reach, and are sorted
by their beginning (range-partitioned: a sparse suffix array in pieces). Neighbours with
the same beginning are extended to the left and to the right: for each way to share
``LENGTH`` words between both sides the extended contexts are compared, among all
neighbours of a piece at once. What two documents share is reported, as spans of words.

One pass over the texts gives the suffixes, one shuffle sorts them; texts don't move.
Places of one document that look alike all around (a word or a line repeated on and on)
are one row with a list of places.
The words around a suffix are compared by 24 bits each (of ten million pairs of different
words about one passes as equal, which can lengthen a span by a word), its beginning by 64.

Hot passages: suffixes whose beginning may go on in another piece (the first and the last
of each piece), and those of a beginning that ``GATHER`` suffixes of a piece share, are
given back. They are made classes: what agrees in beginning and contexts is one row with the
smallest and the largest id (combined on the map side). Sorted by either side, neighbours
show how far a class shares that side with another document at the most; what lies beyond
can't be part of a shared run and is cut off, so a passage in any surroundings that a third
of all documents hold is a handful of classes. The hashes of their runs are aggregated to
the smallest and the largest id, and each class gets two bit masks over its runs (repeated;
kept by its smallest id), which are joined back to its members.

Of the documents that share a run, the one with the smallest id keeps it. Ids that aren't
whole numbers are ordered by a 64-bit hash.

Defined results: null and empty texts, texts shorter than ``LENGTH`` words and rows
without an id share nothing and stay as they are; a run repeated inside one document
only is no repeat; rows with the same id count as one document, but spans belong to a text
(``text``, its hash), so another text under the same id is not cut by them; a text of any
length is read whole; other columns are carried, whatever they are called; an empty table
has no spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riftlog.llm.text import LOWER, Words, mix, words_of
from riftlog.session import settle

LENGTH, SEED = 50, 8
SIDE = LENGTH - SEED  # words that a run can reach on either side
GATHER = 40_000  # suffixes compared at once
BITS = 25  # log2 of the bits of the bitmap of texts with cuts
SUFFIX = "id long, text long, key long, after binary, before binary, at array<int>"
#: kind 0: words first .. last - 1 of id are repeated; 1: and another document keeps
#: them; 2: a suffix that is compared by classes.
FOUND = "kind byte, id long, text long, first int, last int, key long, after binary, before binary, at array<int>"
RUNS = "run long, key long, class long, offset int, least long, most long"
SPANS = "kind byte, id long, text long, first int, last int"

_U = np.uint64
_INDEX = _U((1 << 24) - 1)


def retained(words: Words) -> tuple[np.ndarray, ...]:
    """Places (words of the piece) where suffixes begin, the hashes of their seeds, and
    the fewest and the most words before them at which a run of theirs begins."""
    g, at = words.ngrams(SEED)
    window = SIDE + 1
    n = len(g) - window + 1
    out = [(np.empty(0, np.int64), np.empty(0, _U), np.empty(0, np.int64), np.empty(0, np.int64))]
    for a in range(0, n, 1 << 23):  # indexes have 24 bits
        part = g[a : min(a + (1 << 23), n) + window - 1]
        value = (part & ~_INDEX) | np.arange(len(part), dtype=_U)
        m = len(part) - window + 1
        padded = np.append(value, np.full(-len(value) % window, np.iinfo(np.uint64).max, _U)).reshape(-1, window)
        ahead = np.minimum.accumulate(padded, 1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
        least = np.minimum(behind[:m], ahead[window - 1 : window - 1 + m])
        first = at[a : a + m]
        inside = np.flatnonzero((words.row[first] == words.row[at[a + window - 1 : a + window - 1 + m]]))
        # The windows of which a place is the smallest follow each other.
        place, begin, many = np.unique((least[inside] & _INDEX).astype(np.int64), return_index=True, return_counts=True)
        out.append((at[a + place], g[a + place], place - inside[begin + many - 1], place - inside[begin]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _binary(codes: np.ndarray, inside: np.ndarray) -> pa.Array:
    """The 24-bit codes that are inside, as one binary value per row."""
    data = np.ascontiguousarray(codes[inside]).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
    offsets = np.append(0, np.cumsum(3 * inside.sum(1))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def contexts(words: Words, at: np.ndarray, fewest: np.ndarray, most: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Codes of the words after the seeds and before them (nearest first), as far as
    the suffixes' own runs reach."""
    code = (words.hash >> _U(16)).astype(np.uint32) & np.uint32(0xFFFFFF)
    step = np.arange(SIDE)
    after = np.minimum(at[:, None] + SEED + step, len(code) - 1)
    before = np.maximum(at[:, None] - 1 - step, 0)
    return _binary(code[after], step < (SIDE - fewest)[:, None]), _binary(code[before], step < most[:, None])


def alike(words: Words, at: np.ndarray, key: np.ndarray, fewest: np.ndarray, most: np.ndarray) -> np.ndarray:
    """A number per suffix, equal for those of one row with the same words around."""
    with np.errstate(over="ignore"):
        h = mix(key + mix(words.row[at].astype(_U) * _U(1 << 16) + fewest.astype(_U) * _U(1 << 8) + most.astype(_U)))
        for j in range(SIDE):
            after, before = np.minimum(at + SEED + j, len(words.hash) - 1), np.maximum(at - 1 - j, 0)
            h = h * _U(0x9FB21C651E98DF25) + np.where(j < SIDE - fewest, words.hash[after], _U(0))
            h = h * _U(0x9FB21C651E98DF25) + np.where(j < most, words.hash[before], _U(0))
        return mix(h)


def codes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Back from binary: (rows, SIDE) codes, and how many there are in each row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    many = np.diff(offsets) // 3
    out = np.zeros((len(column), SIDE), np.uint32)
    if many.sum():
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].reshape(-1, 3).astype(np.uint32)
        out[np.arange(SIDE) < many[:, None]] = raw[:, 0] | raw[:, 1] << 8 | raw[:, 2] << 16
    return out, many


def number_of(docs: DataFrame, id_col: str) -> Column:
    """The id as a long."""
    kind = docs.schema[id_col].dataType
    return F.col(f"`{id_col}`").cast("long") if isinstance(kind, T.IntegralType) else F.when(F.col(f"`{id_col}`").isNotNull(), F.xxhash64(f"`{id_col}`"))


def suffixes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    known = docs.select(number_of(docs, id_col).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).dropna()
    known = known.withColumn("hash", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id").to_numpy(), batch.column("hash").to_numpy()
            for words in words_of(batch.column("text")):
                at, key, fewest, most = retained(words)
                if len(at):
                    row = words.row[at]
                    look = alike(words, at, key, fewest, most)
                    order = np.argsort(look, kind="stable")
                    first = np.flatnonzero(np.append(True, look[order][1:] != look[order][:-1]))
                    places = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)), pa.int32()), pa.array((at - words.row_start[row])[order], pa.int32()))
                    one = order[first]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[words.first + row[one]]), pa.array(texts[words.first + row[one]]), pa.array(key[one].view(np.int64)), *contexts(words, at[one], fewest[one], most[one]), places],
                        names=["id", "text", "key", "after", "before", "at"],
                    )

    return known.mapInArrow(run, SUFFIX)


def _sides(codes: np.ndarray, many: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of the first 0 .. SIDE words of one side; 0 where there are fewer."""
    out = np.zeros((len(codes), SIDE + 1), _U)
    out[:, 0] = _U(salt)
    with np.errstate(over="ignore"):
        for j in range(SIDE):
            out[:, j + 1] = mix(out[:, j] * _U(0x9FB21C651E98DF25) + codes[:, j].astype(_U))
    out[:, 1:][np.arange(SIDE) >= many[:, None]] = 0
    return out


def runs_of(key: np.ndarray, right: np.ndarray, left: np.ndarray, a: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes (hashes of their sides given) with a run that begins a words before
    them, and its hash."""
    x, y = left[:, a], right[:, SIDE - a]
    at = np.flatnonzero((x != 0) & (y != 0))
    with np.errstate(over="ignore"):
        return at, mix(key[at] + x[at] * _U(0xA0761D6478BD642F) + mix(y[at] + _U(a)))


def compare(ids: np.ndarray, key: np.ndarray, right: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix (hashes of its sides given) and each a in 0 .. SIDE: whether another
    document has the run that begins a words before it too, and whether none smaller has."""
    n = len(ids)
    repeated, kept = np.zeros((n, SIDE + 1), bool), np.zeros((n, SIDE + 1), bool)
    for a in range(SIDE + 1):
        at, own = runs_of(key, right, left, a)
        if len(at) < 2:
            continue
        order = np.lexsort((ids[at], own))
        at, own, doc = at[order], own[order], ids[at[order]]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        size = np.diff(np.append(first, len(at)))
        low, high = np.repeat(doc[first], size), np.repeat(doc[first + size - 1], size)
        repeated[at, a] = low != high
        kept[at, a] = doc == low
    return repeated, kept


def _spans(places: pa.Array, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of words covered by the marked runs: suffixes, first words, last words + 1."""
    at, start = places.flatten().to_numpy().astype(np.int64), places.offsets.to_numpy().astype(np.int64)
    start = start - start[0]
    edge = np.diff(np.pad(marked.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, low = np.nonzero(edge == 1)
    _, high = np.nonzero(edge == -1)
    many = start[row + 1] - start[row]
    place = at[np.repeat(start[row], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
    return np.repeat(row, many), place - np.repeat(high - 1, many), place - np.repeat(low, many) + LENGTH


def _joined(ids: np.ndarray, texts: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping and touching spans of a text made one, among those given."""
    if not len(ids):
        return ids, texts, first, last
    order = np.lexsort((first, texts, ids))
    ids, texts, first, last = ids[order], texts[order], first[order], last[order]
    other = np.append(True, (ids[1:] != ids[:-1]) | (texts[1:] != texts[:-1]))
    base = np.cumsum(other) << 32  # texts one behind the other on a line
    reach = np.maximum.accumulate(base + last)
    begin = np.flatnonzero(np.append(True, base[1:] + first[1:] > reach[:-1]))
    end = np.append(begin[1:], len(ids)) - 1
    return ids[begin], texts[begin], first[begin], reach[end] - base[end]


def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the neighbours of one sorted piece; those that may go on in other pieces
    are given back."""
    names = [x.split()[0] for x in FOUND.split(", ")]
    kinds = [pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32())]

    def rows(kind: int, ids, texts, first=None, last=None, key=None, after=None, before=None, at=None) -> pa.RecordBatch:
        n = len(ids)
        given = [np.full(n, kind, np.int8), ids, texts, first, last, key, after, before, at]
        columns = [pa.nulls(n, k) if x is None else x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(given, kinds)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def piece(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        key = table.column("key").to_numpy()
        size = np.diff(np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key)))
        size = np.repeat(size, size)
        yield from give_back(table.filter(pa.array(size > GATHER)))
        use = (size > 1) & (size <= GATHER)
        if not use.any():
            return
        own = table.filter(pa.array(use)).combine_chunks()
        ids, texts, key = (own.column(c).to_numpy() for c in ("id", "text", "key"))
        key = key.view(_U)
        for a, b in _parts(key):
            sides = [_sides(*codes_of(own.column(c).slice(a, b - a)), salt) for salt, c in ((1, "after"), (2, "before"))]
            repeated, kept = compare(ids[a:b], key[a:b], *sides)
            places = own.column("at").slice(a, b - a).combine_chunks()
            for kind, marked in ((0, repeated), (1, repeated & ~kept)):
                row, first, last = _spans(places, marked)
                yield rows(kind, ids[a:b][row], texts[a:b][row], first, last)

    def give_back(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for b in table.to_batches():
            yield rows(2, b.column("id"), b.column("text"), key=b.column("key"), after=b.column("after"), before=b.column("before"), at=b.column("at"))

    held: list[pa.RecordBatch] = []
    first_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < GATHER:
            continue
        table = pa.Table.from_batches(held)
        key = table.column("key").to_numpy()
        first_key = key[0] if first_key is None else first_key
        own = int(np.searchsorted(key, first_key, "right"))
        yield from give_back(table.slice(0, own))
        table, key = table.slice(own), key[own:]
        cut = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0
        yield from piece(table.slice(0, cut)) if cut else ()
        held = table.slice(cut).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        key = table.column("key").to_numpy()
        if len(key):
            a = int(np.searchsorted(key, key[0] if first_key is None else first_key, "right"))
            b = max(a, int(np.searchsorted(key, key[-1], "left")))
            yield from give_back(table.slice(0, a))
            yield from give_back(table.slice(b))
            table = table.slice(a, b - a)
        if table.num_rows:
            yield from piece(table)


def _parts(key: np.ndarray, most: int = GATHER) -> Iterator[tuple[int, int]]:
    """Ranges of about ``most`` suffixes that don't cut a beginning."""
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    ends = np.append(first[1:], len(key))
    a = 0
    while a < len(key):
        b = int(ends[min(np.searchsorted(ends, a + most), len(ends) - 1)])
        yield a, b
        a = b


def shared_words(side: str):
    """For classes sorted by beginning, ``side`` and smallest id: ``<side>_words``, how many
    words of that side another document has too, at the most. At the ends of what is looked
    at together the neighbours aren't known, and all words count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, GATHER):
                batch = whole.slice(a, GATHER)
                codes, many = codes_of(batch.column(side))
                key, least, most = (batch.column(c).to_numpy() for c in ("key", "least", "most"))
                same = codes[1:] == codes[:-1]
                same &= np.arange(SIDE) < np.minimum(many[1:], many[:-1])[:, None]
                alike = np.append(np.append(SIDE, np.where(key[1:] == key[:-1], np.minimum.accumulate(same, 1).sum(1), 0)), SIDE)
                # Rows of one document only: what they share with each other doesn't count.
                own = np.flatnonzero((least[1:] == least[:-1]) & (most[1:] == most[:-1]) & (least[1:] == most[1:])) + 1
                back, ahead = alike[:-1].copy(), alike[1:].copy()
                for i in own:
                    back[i] = min(back[i], back[i - 1])
                for i in own[::-1]:
                    ahead[i - 1] = min(ahead[i - 1], ahead[i])
                words = np.where(least < most, many, np.minimum(np.maximum(back, ahead), many))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(words, pa.int32())], names=[*batch.schema.names, f"{side}_words"])

    return run


def all_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every run through the given classes, by its hash."""
    for whole in batches:
        for a in range(0, whole.num_rows, GATHER):
            batch = whole.slice(a, GATHER)
            key = batch.column("key").to_numpy().view(_U)
            right, left = (_sides(*codes_of(batch.column(c)), salt) for salt, c in ((1, "after"), (2, "before")))
            for offset in range(SIDE + 1):
                at, own = runs_of(key, right, left, offset)
                taken = [batch.column(c).take(pa.array(at)) for c in ("key", "class", "least", "most")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.view(np.int64)), *taken[:2], pa.array(np.full(len(at), offset, np.int32)), *taken[2:]],
                    names=[x.split()[0] for x in RUNS.split(", ")],
                )


def masked_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of members (id, text, at) of classes, given the masks of their runs."""
    for whole in batches:
        for a in range(0, whole.num_rows, GATHER):
            batch = whole.slice(a, GATHER)
            ids, texts, least, repeated, first = (batch.column(c).to_numpy() for c in ("id", "text", "least", "repeated", "first"))
            marked, kept = (((mask[:, None] >> np.arange(SIDE + 1)) & 1).astype(bool) for mask in (repeated, first))
            kept &= (ids == least)[:, None]
            places = pa.concat_arrays([batch.column("at")])
            for kind, bits in ((0, marked), (1, marked & ~kept)):
                row, begin, end = _spans(places, bits)
                own, text, begin, end = _joined(ids[row], texts[row], begin, end)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), kind, np.int8)), pa.array(own), pa.array(text), pa.array(begin, pa.int32()), pa.array(end, pa.int32())],
                    names=[x.split()[0] for x in SPANS.split(", ")],
                )


def class_spans(members: DataFrame) -> DataFrame:
    """(kind, id, text, first, last) of suffixes (id, text, key, after, before, at) that are
    compared over all pieces."""
    sides = ["key", "after", "before"]
    classes = members.groupBy(*sides).agg(F.min("id").alias("least"), F.max("id").alias("most"))
    for side in ("after", "before"):
        classes = settle(classes, "classes")
        order = ["key", side, "least", "most"]
        classes = classes.repartitionByRange(*order).sortWithinPartitions(*order)
        classes = classes.mapInArrow(shared_words(side), T.StructType([*classes.schema, T.StructField(f"{side}_words", T.IntegerType())]))
    # A run has SIDE words besides the beginning; with fewer shared ones there is none.
    cut = [F.expr(f"substring({side}, 1, 3 * {side}_words)").alias(f"{side}_cut") for side in ("after", "before")]
    classes = classes.where(F.col("after_words") + F.col("before_words") >= SIDE).select(*sides, "least", "most", *cut)
    classes = settle(classes.withColumn("class", F.xxhash64("after_cut", F.octet_length("after_cut"), "before_cut")), "classes")
    cut_classes = classes.groupBy("key", "class").agg(
        F.first("after_cut").alias("after"), F.first("before_cut").alias("before"), F.min("least").alias("least"), F.max("most").alias("most"))
    # Written before they are joined: both sides are plain shuffles, and a hot run's can be split.
    runs = settle(cut_classes.mapInArrow(all_runs, RUNS), "runs")
    shared = settle(runs.groupBy("run").agg(F.min("least").alias("low"), F.max("most").alias("high")).where("low <> high").select("run", "low"), "shared")
    bit = F.expr("shiftleft(1L, offset)")
    masks = runs.join(shared, "run").groupBy("key", "class").agg(
        F.bit_or(bit).alias("repeated"), F.bit_or(F.when(F.col("least") == F.col("low"), bit).otherwise(F.lit(0).cast("long"))).alias("first"), F.min("least").alias("least"))
    masks = settle(classes.select(*sides, "class").join(masks, ["key", "class"]).drop("class"), "masks")
    return members.join(masks, sides).select("id", "text", "at", "least", "repeated", "first").mapInArrow(masked_spans, SPANS)


def _merge(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of each text made one: (id, text, first, last)."""
    line = Window.partitionBy("id", "text").orderBy("first", "last")
    reach = F.max("last").over(line.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.coalesce((F.col("first") > reach).cast("int"), F.lit(1)))
    spans = spans.withColumn("island", F.sum("new").over(line))
    return spans.groupBy("id", "text", "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    order = ["key", "after", "before", "id"]
    array = suffixes(docs, id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
    found = settle(array.mapInArrow(extend, FOUND), "suffixes")
    given = settle(found.where("kind = 2").select("id", "text", "key", "after", "before", "at"), "given-back")
    spans = found.where("kind < 2").select("kind", "id", "text", "first", "last")
    return spans.union(settle(class_spans(given), "class-spans"))


def repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Spans of words that other documents repeat, and those of them that another document
    keeps: (id, text, first, last), the hash of the text, words from 0, ``last`` exclusive."""
    marked = _marked(docs, id_col, text_col)
    both = [_merge(marked.where(F.col("kind") == kind).drop("kind")) for kind in (0, 1)]
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        names = docs.select(number_of(docs, id_col).alias("id"), F.col(f"`{id_col}`").alias("_id")).where("id IS NOT NULL").distinct()
        both = [spans.join(names, "id").select(F.col("_id").alias("id"), "text", "first", "last") for spans in both]
    return both[0], both[1]


def with_chance(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` (_own_id, _own_text) with ``_chance``: false only where ``cuts`` (_cut_id,
    _cut_text) has no such row. A bitmap of 2^``BITS`` bits, 4 MB whatever the corpus,
    tells most of them apart in the scan."""
    slot = lambda *keys: F.shiftrightunsigned(F.xxhash64(*keys), 64 - BITS) + 1
    bits = cuts.groupBy(F.bitmap_bucket_number(slot("_cut_id", "_cut_text")).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot("_cut_id", "_cut_text"))).alias("_bits"))
    bits = settle(bits, "cut-bits")
    place = F.bitmap_bit_position(slot("_own_id", "_own_text"))
    found = rows.withColumn("_bucket", F.bitmap_bucket_number(slot("_own_id", "_own_text"))).join(F.broadcast(bits), "_bucket", "left")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))), F.lit(2)) == 1
    return found.withColumn("_chance", F.coalesce(bit, F.lit(False))).drop("_bucket", "_bits")


def cut_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` without the passages that another document keeps. A cut takes a span's
    words and what stands between them and the next word. Rows of which no word is left
    go; rows without such passages stay as they are. ``length_col`` counts characters."""
    cuts = _merge(_marked(docs, id_col, text_col).where("kind = 1").drop("kind"))
    cuts = settle(cuts.groupBy(F.col("id").alias("_cut_id"), F.col("text").alias("_cut_text")).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("_cuts")), "cuts")
    own = [number_of(docs, id_col).alias("_own_id"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("_own_text")]
    marked = with_chance(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *own), cuts)
    # Only texts that may have a cut move.
    whole = [marked.where(~F.col("_chance")).select("row.*")]
    rows = marked.where("_chance").join(cuts, (F.col("_own_id") == F.col("_cut_id")) & (F.col("_own_text") == F.col("_cut_text")), "left").select("row", "_cuts")
    whole.append(rows.where("_cuts IS NULL").select("row.*"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("row").field(text_col).cast(pa.string()), batch.column("_cuts").to_pylist()
            out = []
            for words in words_of(texts):
                for r in range(words.rows):
                    a, b = words.row_start[r], words.row_start[r + 1]
                    raw = words.raw[words.off[r] : words.off[r + 1]]
                    keep = np.ones(len(raw), bool)
                    for s in spans[words.first + r]:
                        end = words.start[a + s["last"]] if s["last"] < b - a else len(raw)
                        keep[words.start[a + s["first"]] : end] = False
                    kept = raw[keep]
                    out.append(kept.tobytes().decode("utf-8") if LOWER[kept].any() else None)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], names=["row", "new_text"])

    changed = rows.where("_cuts IS NOT NULL").mapInArrow(run, rows.select("row").schema.add("new_text", "string")).where("new_text IS NOT NULL")
    changed = changed.select(*[
        F.col("new_text").alias(c) if c == text_col else F.length("new_text").cast(docs.schema[c].dataType).alias(c) if c == length_col else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ])
    return whole[0].unionByName(whole[1]).unionByName(changed)
