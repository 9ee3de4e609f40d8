"""Phrases whose words stand together more often than chance, by truncated suffix trees.

The suffix tree of the corpus, cut at ``LONGEST`` words and at rare words, is built in
groups of prefixes (vertical partitioning), each group on its own:

1. Words are counted. A phrase is as frequent as ``LEAST`` only if all its words and
   neighbouring pairs are, so a bitmap of the frequent words (``BITS`` bits, whatever the
   corpus) tells most of the others apart; what it lets through by chance is counted
   exactly like the rest and dropped by its count.
2. Prefixes of two such words are counted by hash; those that occur ``LEAST`` times go into
   a second bitmap. A prefix that occurs more than ``PREFIX_ROWS`` times is extended by a
   word and its extensions are counted, again and again while there are such prefixes.
3. Every place from which frequent pairs follow each other gives a suffix of up to
   ``LONGEST`` words. Its prefix (two words, more where that one was extended) gives its
   group. Equal suffixes of a task are one suffix with its number; the suffixes of a task
   for a group travel together, as one row.
4. Each group is sorted in one task: the suffixes of a prefix are a subtree, and the total
   of a node is the sum of the leaf totals below it. Nodes above an extended prefix get the
   sum of the totals of their parts.

The number of groups follows the number of words (``GROUP_WORDS`` each), so a group is
bounded by that and by ``PREFIX_ROWS``. Texts are read once for each of the passes and
never shuffled. What moves is combined in the tasks first, so a passage or a pair that a
third of all documents hold costs an entry a task. The list of extended prefixes, which all
tasks hold, has the number of words / ``PREFIX_ROWS`` entries at the most. The counts of the
parts of each cut are joined by phrase; scores are whole numbers of 38 digits. Ranking keeps
the first ``TOP`` of each partition before they meet.

Defined results: a null or empty text has no words; a null ``lang`` counts as ``und``,
together with documents of that name; rows with equal or null ids count each; a text of any
length is read whole, cut where a piece ends (a piece is held whole); phrases that agree in
score and count are ordered by their bytes; without candidates the result is empty. No other
column than text and language is looked at."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from riftlog.llm.text import _POWERS, BYTE_HASH, PIECE_BYTES, column_bytes, mix, pieces
from riftlog.operators.lookups import lookup_join
from riftlog.session import settle

LEAST, LONGEST, TOP = 100, 5, 2000
BITS = 25  # log2 of the bits of a bitmap: 4 MB
PREFIX_ROWS, GROUP_WORDS, MOST_GROUPS = 1 << 22, 1 << 19, 1 << 18
HELD_ROWS = 1 << 19  # counts a task combines before it gives them on

_U = np.uint64
_WORD, _BLANK, _BREAK = 0, 1, 2


def _kinds() -> np.ndarray:
    table = np.full(256, _WORD, np.uint8)
    table[[0x20, 0x09]] = _BLANK
    table[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK
    return table


KIND = _kinds()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def hashes(strings: pa.Array) -> np.ndarray:
    """64-bit hashes of strings without nulls."""
    raw, off = column_bytes(strings)
    length = np.diff(off)
    out = np.zeros(len(length), _U)
    filled = np.flatnonzero(length)
    if len(filled):
        place = np.arange(len(raw)) - np.repeat(off[:-1], length)
        with np.errstate(over="ignore"):
            out[filled] = np.add.reduceat(BYTE_HASH[raw] * _POWERS.upto(int(length.max()))[place], off[:-1][filled])
    return mix(out + length.astype(_U))


def prefix_hash(*parts: np.ndarray) -> np.ndarray:
    """The hash of a language and the words of a prefix, given by their hashes."""
    out = np.zeros(len(parts[0]), _U)
    with np.errstate(over="ignore"):
        for h in parts:
            out = mix(out * _U(0x9FB21C651E98DF25) + h)
    return out


def top_bits(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


@dataclass
class Bits:
    """A set that may hold more than was put in, never less."""

    raw: np.ndarray

    def has(self, h: np.ndarray) -> np.ndarray:
        slot = top_bits(h, BITS)
        return (self.raw[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def bitmap(hashed: DataFrame) -> Bits:
    """The bits of all ``h`` (64 bits, as long)."""
    slot = F.shiftrightunsigned("h", 64 - BITS) + 1
    found = hashed.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    raw = np.zeros(max(1, 1 << BITS >> 3), np.uint8)
    for row in found.toLocalIterator():  # a bucket has 4 KB, and BITS bound their number
        begin = (row["bucket"] - 1) * 4096
        raw[begin : begin + 4096] = np.frombuffer(row["bits"], np.uint8)[: len(raw) - begin]
    return Bits(raw)


@dataclass
class Text:
    """The words of some rows: numbers of (language, word), and which words follow the
    one before within a piece."""

    langs: pa.Array  # of each number
    words: pa.Array
    number: np.ndarray
    linked: np.ndarray  # word i + 1 follows word i

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        return hashes(self.langs), hashes(self.words)


def _slices(raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, offsets and rows of ``PIECE_BYTES`` at a time; a longer text is cut after
    breaks only, where no phrase goes on."""
    for a, b in pieces(off):
        own = raw[off[a] : off[b]]
        if b - a > 1 or len(own) <= 2 * PIECE_BYTES:
            yield own, off[a : b + 1] - off[a], np.arange(a, b)
            continue
        breaks = np.flatnonzero(KIND[own] == _BREAK) + 1
        at = np.searchsorted(breaks, np.arange(PIECE_BYTES, len(own), PIECE_BYTES))
        cuts = np.unique(np.concatenate([[0], breaks[at[at < len(breaks)]], [len(own)]]))
        for x, y in zip(cuts, cuts[1:]):
            yield own[x:y], np.array([0, y - x]), np.array([a])


def texts(batch: pa.RecordBatch) -> Iterator[Text]:
    lang = batch.column("lang").dictionary_encode()
    code, names = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64), lang.dictionary
    raw, off = column_bytes(batch.column("text"))
    for own, begin, rows in _slices(raw, off):
        kind = KIND[own]
        inside = kind == _WORD
        before = np.append(False, inside[:-1])
        before[begin[:-1][begin[:-1] < len(own)]] = False
        start = np.flatnonzero(inside & ~before)
        if not len(start):
            continue
        row = np.searchsorted(begin, start, "right") - 1
        broken = np.cumsum(kind == _BREAK)[start]
        linked = (row[1:] == row[:-1]) & (broken[1:] == broken[:-1])
        count = np.append(0, np.cumsum(inside, dtype=np.int64))
        offsets = count[np.append(start, len(own))]
        data = np.ascontiguousarray(LOWER[own[inside]])
        every = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        key = code[rows[row]] * len(every.dictionary) + every.indices.to_numpy(zero_copy_only=False)
        distinct, number = np.unique(key, return_inverse=True)
        yield Text(
            names.take(pa.array(distinct // len(every.dictionary))),
            every.dictionary.take(pa.array(distinct % len(every.dictionary))).cast(pa.string()), number, linked,
        )


def combined(tables: Iterator[pa.Table], keys: list[str], chunk: int = 1 << 16, whole: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows of equal ``keys`` made one, with the sum of their ``n``, as far as memory
    allows, or all of them if ``whole``."""

    def one() -> pa.Table:
        return pa.concat_tables(held).group_by(keys).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select([*keys, "n"]).combine_chunks()

    held: list[pa.Table] = []
    rows, most = 0, HELD_ROWS
    for table in tables:
        held.append(table)
        rows += table.num_rows
        if rows > most:
            held = [one()]
            rows = held[0].num_rows
            if whole:
                most = max(HELD_ROWS, 2 * rows)
            elif rows > HELD_ROWS // 2:
                yield from held[0].to_batches(max_chunksize=chunk)
                held, rows = [], 0
    if held:
        yield from one().to_batches(max_chunksize=chunk)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n): every word, and under a null word how many there are in the language."""

    def tables() -> Iterator[pa.Table]:
        for batch in batches:
            for text in texts(batch):
                n = np.bincount(text.number, minlength=len(text.words))
                total = pa.table({"lang": text.langs, "n": n}).group_by("lang").aggregate([("n", "sum")])
                yield pa.table({"lang": text.langs, "word": text.words, "n": n})
                yield pa.table({"lang": total["lang"], "word": pa.nulls(len(total), pa.string()), "n": total["n_sum"]})

    yield from combined(tables(), ["lang", "word"])


def hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = prefix_hash(hashes(batch.column("lang")), hashes(batch.column("word")))
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])


@dataclass
class Prefixes:
    """What is known of the prefixes: frequent words, frequent pairs, extended ones."""

    words: Bits
    pairs: Bits | None = None
    extended: tuple[np.ndarray, ...] = ()  # of two words, of three ...: sorted hashes

    def line(self, text: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the pairs at all places of a text, from 1 (0: no known pair begins
        there), the first and the second words of the pairs, and their hashes."""
        lang, word = hashes(text.langs), hashes(text.words)
        frequent = self.words.has(prefix_hash(lang, word))[text.number]
        at = np.flatnonzero(text.linked & frequent[1:] & frequent[:-1])
        distinct, pair = np.unique(text.number[at] * len(text.words) + text.number[at + 1], return_inverse=True)
        a, b = np.divmod(distinct, len(text.words))
        h = prefix_hash(lang[a], word[a], word[b])
        good = self.pairs.has(h) if self.pairs else np.ones(len(h), bool)
        line = np.zeros(len(text.number) + LONGEST, np.int64)
        line[at[good[pair]]] = pair[good[pair]] + 1
        return line, a, b, h

    def prefix_of(self, h: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The prefixes (hashes) of suffixes and their sizes, given the hashes of their
        first pairs and of the words after them (0 where there is none)."""
        h, size = h.copy(), np.full(len(h), 2)
        more = np.ones(len(h), bool)
        for j, extended in enumerate(self.extended):
            more &= np.isin(h, extended)
            # A suffix that ends with the prefix is a part of its own of the prefix.
            h[more] = prefix_hash(h[more], words[more, j])
            size[more] += 1
        return h, size


def suffixes(text: Text, known: Prefixes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct suffixes of known pairs: (language and word) numbers, -1 after the end;
    how often each stands there; hashes of first pairs and of the words that follow."""
    line, _, b, h = known.line(text)
    place = np.flatnonzero(line)
    steps = np.stack([line[place + j] for j in range(LONGEST - 1)], 1)
    steps[np.minimum.accumulate(steps > 0, 1) == 0] = 0
    key = np.zeros(len(place), np.int64)
    for j in range(LONGEST - 1):  # dense numbers: the products stay small
        _, key = np.unique(key * (len(h) + 1) + steps[:, j], return_inverse=True)
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    step = steps[first]
    numbers = np.full((len(first), LONGEST), -1)
    numbers[:, 0] = text.number[place[first]]
    numbers[:, 1:] = np.where(step > 0, np.append(b, -1)[step - 1], -1)
    after = np.append(hashes(text.words), _U(0))[numbers[:, 2:]]
    return numbers, n, h[step[:, 0] - 1], after, place[first]


def _planes(values: np.ndarray) -> bytes:
    """Ascending uint32 numbers as steps, all first bytes first: runs of small steps pack well."""
    steps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32)


def _sorted_sums(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else order
    return key[first], np.add.reduceat(n[order], first) if len(first) else n


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """The rows of each ``group`` of sorted batches, as they come."""
    rest = (
        (int(keys[a]), batch.slice(a, b - a))
        for batch in batches if batch.num_rows
        for keys in [batch.column("group").to_numpy()]
        for cuts in [np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))]
        for a, b in zip(cuts, cuts[1:])
    )
    for key, parts in itertools.groupby(rest, key=lambda x: x[0]):
        yield key, (x[1] for x in parts)


def count_prefixes(docs: DataFrame, known: Prefixes, size: int, bits: int, least: int) -> DataFrame:
    """(h, n) of the prefixes of ``size`` words that occur ``least`` times: all pairs of
    known words, or the extensions of extended prefixes. A hash has ``bits`` + 32 bits, the
    rest is 0; prefixes that share it count together."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0

        def give() -> pa.RecordBatch:
            h, n = _sorted_sums(*(np.concatenate(x) for x in zip(*held)))
            group = top_bits(h, bits)
            cuts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(h)) if len(h) else np.zeros(1, np.int64)
            own = (h >> _U(32 - bits)).astype(np.uint32)
            data = [(_planes(own[a:b]), n[a:b].astype("<i8").tobytes()) for a, b in zip(cuts, cuts[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(group[cuts[:-1]], pa.int32()), pa.array([x for x, _ in data], pa.binary()), pa.array([x for _, x in data], pa.binary())],
                names=["group", "keys", "counts"],
            )

        for batch in batches:
            for text in texts(batch):
                if size == 2:
                    line, _, _, pair = known.line(text)
                    h, n = pair, np.bincount(line[line > 0] - 1, minlength=len(pair))
                else:
                    _, n, pair, after, _ = suffixes(text, known)
                    h, found = known.prefix_of(pair, after)
                    h, n = h[found == size], n[found == size]
                held.append(_sorted_sums(h, n))
                rows += len(held[-1][0])
                if rows > 4 * HELD_ROWS:
                    held = [_sorted_sums(*(np.concatenate(x) for x in zip(*held)))]
                    rows = len(held[0][0])
                    if rows > 2 * HELD_ROWS:
                        yield give()
                        held, rows = [], 0
        if held:
            yield give()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, parts in grouped(batches):
            key, n = np.empty(0, np.uint32), np.empty(0, np.int64)
            held, rows = [(key, n)], 0
            for part in itertools.chain(parts, [None]):
                if part is None or rows > max(4 * HELD_ROWS, 2 * len(held[0][0])):
                    held, rows = [_sorted_sums(*(np.concatenate(x) for x in zip(*held)))], 0
                if part is not None:
                    for k, c in zip(part.column("keys"), part.column("counts")):
                        held.append((_from_planes(k.as_py()), np.frombuffer(c.as_py(), "<i8")))
                        rows += len(held[-1][0])
            key, n = held[0]
            often = np.flatnonzero(n >= least)
            h = _U(group) << _U(64 - bits) if bits else _U(0)
            h = h | key[often].astype(_U) << _U(32 - bits)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n[often], pa.int64())], names=["h", "n"])

    sent = docs.mapInArrow(count, "group int, keys binary, counts binary")
    return sent.repartition("group").sortWithinPartitions("group").mapInArrow(add_up, "h long, n long")


def send_suffixes(docs: DataFrame, known: Prefixes, bits: int) -> DataFrame:
    """(group, lang, size, suffixes, counts): the suffixes of a task for a group, one a
    line, by language and by the size of their prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables() -> Iterator[pa.Table]:
            for batch in batches:
                for text in texts(batch):
                    numbers, n, pair, after, _ = suffixes(text, known)
                    h, size = known.prefix_of(pair, after)
                    words = [text.words.take(pa.array(numbers[:, j], mask=numbers[:, j] < 0)) for j in range(LONGEST)]
                    phrase = pc.binary_join_element_wise(*words, " ", null_handling="skip")
                    group = pa.array(top_bits(h, bits), pa.int32())
                    yield pa.table({"group": group, "lang": text.langs.take(pa.array(numbers[:, 0])), "size": pa.array(size, pa.int32()), "suffix": phrase, "n": n})

        for batch in combined(tables(), ["group", "lang", "size", "suffix"], 1 << 30):
            yield from _packed(batch)

    schema = "group int, lang string, size int, suffixes binary, counts binary"
    return docs.mapInArrow(run, schema)


def _packed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """One row for each group, language and size."""
    keys = ["group", "lang", "size"]
    batch = batch.take(pc.sort_indices(batch, [(k, "ascending") for k in [*keys, "suffix"]]))
    change = np.zeros(batch.num_rows, bool)
    change[:1] = True
    for k in keys:
        column = batch.column(k)
        change[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(change)
    cuts = np.append(first, batch.num_rows)
    n = batch.column("n").to_numpy().astype("<i8")
    for a in range(0, len(first), 4096):
        own = cuts[a : a + 4097]
        lines = pa.ListArray.from_arrays(pa.array(own - own[0], pa.int32()), batch.column("suffix").slice(own[0], own[-1] - own[0]))
        joined = pc.binary_join(lines, "\n").cast(pa.binary())
        counts = pa.array([n[x:y].tobytes() for x, y in zip(own, own[1:])], pa.binary())
        taken = pa.array(own[:-1])
        yield pa.RecordBatch.from_arrays([*(batch.column(k).take(taken) for k in keys), joined, counts], names=[*keys, "suffixes", "counts"])


def _unpacked(part: pa.RecordBatch) -> pa.Table:
    lines = pc.split_pattern(part.column("suffixes").cast(pa.string()), "\n")
    row = pa.array(np.repeat(np.arange(part.num_rows), lines.value_lengths().to_numpy(zero_copy_only=False)))
    counts = np.frombuffer(b"".join(c.as_py() for c in part.column("counts")), "<i8")
    return pa.table({"lang": part.column("lang").take(row), "size": part.column("size").take(row), "suffix": lines.flatten(), "n": counts})


def node_totals(table: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, size, n) of the nodes of the subtrees of some prefixes, given all
    their suffixes (lang, size of the prefix, suffix, n)."""
    words = pc.split_pattern(table.column("suffix").combine_chunks(), " ")
    length = words.value_lengths().to_numpy(zero_copy_only=False)
    coded = words.flatten().dictionary_encode()
    lang = table.column("lang").combine_chunks().dictionary_encode()
    place = np.arange(LONGEST) < length[:, None]
    tree = np.full((len(length), LONGEST + 1), -1)
    tree[:, 0] = lang.indices.to_numpy()
    tree[:, 1:][place] = coded.indices.to_numpy()
    order = np.lexsort(tree.T[::-1])
    tree, n, depth = tree[order], table.column("n").to_numpy()[order], table.column("size").to_numpy()[order]
    change = np.zeros(len(n), bool)
    change[:1] = True
    for level in range(LONGEST + 1):
        change[1:] |= tree[1:, level] != tree[:-1, level]
        if level < 2:
            continue
        first = np.flatnonzero(change)
        total = np.add.reduceat(n, first) if len(first) else n
        # A node above an extended prefix is whole only with its other parts.
        partly = np.maximum.reduceat(depth, first) > level if len(first) else first
        there = (tree[first, level] >= 0) & ((total >= least) | partly)
        first, total = first[there], total[there]
        parts = [coded.dictionary.take(pa.array(tree[first, j])) for j in range(1, level + 1)]
        phrase = pc.binary_join_element_wise(*parts, " ")
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(tree[first, 0])), phrase, pa.array(np.full(len(first), level, np.int32)), pa.array(total)],
            names=["lang", "phrase", "size", "f"],
        )


def subtrees(sent: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of two words and more that occur ``least`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["lang", "size", "suffix"]
        for _, parts in grouped(batches):
            whole = list(combined((_unpacked(p) for p in parts), keys, 1 << 30, whole=True))
            if whole:
                yield from node_totals(pa.Table.from_batches(whole), least)

    nodes = sent.repartition("group").sortWithinPartitions("group").mapInArrow(run, "lang string, phrase string, size int, f long")
    return nodes.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def phrase_counts(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
    prefix_rows: int = PREFIX_ROWS, group_words: int = GROUP_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases that occur ``least`` times, single words too,
    and (lang, n), the number of words of each language."""
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))
    words = rows.mapInArrow(count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = settle(words.where((F.col("n") >= least) | F.col("word").isNull()), "words")
    frequent = words.where(F.col("word").isNotNull())
    totals = words.where("word IS NULL").select("lang", "n")
    groups = min((totals.agg(F.sum("n")).first()[0] or 0) // group_words + 1, MOST_GROUPS)
    bits = max(groups, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))).bit_length()

    known = Prefixes(bitmap(frequent.mapInArrow(hash_words, "h long")))
    for size in range(2, LONGEST):  # prefixes of LONGEST words have no subtree
        found = settle(count_prefixes(rows, known, size, bits, least if size == 2 else prefix_rows + 1), "prefixes")
        if size == 2:
            known.pairs = bitmap(found)
        large = np.sort(found.where(F.col("n") > prefix_rows).select("h").toArrow().column("h").to_numpy().view(_U))
        if not len(large):
            break
        known.extended = (*known.extended, large)

    nodes = subtrees(send_suffixes(rows, known, bits), least)
    counts = frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), F.col("n").alias("f"))
    return settle(counts.union(nodes), "phrases"), totals


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words and more: the cut
    with the lowest score, of equal ones the first."""
    part = lambda begin, many: F.array_join(F.slice("words", begin, many), " ")
    cuts = counts.where("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = cuts.select("lang", "phrase", "words", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    both = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    both = both.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    both = lookup_join(both, totals, ["lang"], spread_by=["phrase"])
    wide = {c: f"CAST({c} AS DECIMAL(19, 0))" for c in ("a", "n", "l", "r")}
    both = both.withColumn("score", F.expr(f"(1000BD * {wide['a']} * {wide['n']}) DIV ({wide['l']} * {wide['r']})"))
    low = both.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
    return low.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")


def covered(counts: DataFrame) -> DataFrame:
    """Phrases (lang, phrase) that stand inside a longer one each time they occur. One
    word more is enough to see it: what is longer is no more frequent."""
    longer = counts.where("size > 2").withColumn("words", F.split("phrase", " "))
    inner = F.array(*[F.array_join(F.slice("words", begin, F.col("size") - 1), " ") for begin in (1, 2)])
    most = longer.select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    return most.join(counts.where("size > 1"), ["lang", "phrase", "f"]).select("lang", "phrase")


def collocations(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP,
    prefix_rows: int = PREFIX_ROWS, group_words: int = GROUP_WORDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language."""
    counts, totals = phrase_counts(docs, text_col=text_col, lang_col=lang_col, least=least, prefix_rows=prefix_rows, group_words=group_words)
    kept = scored(counts, totals).join(covered(counts), ["lang", "phrase"], "left_anti")
    line = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
