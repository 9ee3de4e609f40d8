"""Message templates: mining them, and tagging rows with their key.

Mining follows the idea of the fixed-depth tree of He et al., "Drain: An Online
Log Parsing Approach with Fixed Depth Tree" (ICWS 2017): messages of the same
number of tokens and the same first tokens form a leaf, and within a leaf a
message joins the most similar template or starts a new one. Here messages are
first masked and reduced to distinct shapes; leaves are mined in parallel, the shapes
of a leaf in a sorted stream of which only the templates are kept. ``leaf.Tree`` says
how deep the tree is, how many branches a node has, or that the number of tokens alone
makes a leaf."""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riftlog.config import KEY_PREFIX, SIMILARITY, UNMAPPED, WILDCARD
from riftlog.functions.parsing import computed_once
from riftlog.functions.tokens import first_token, shape_of, token_count
from riftlog.operators.leaf import FIRST_TOKEN, LEAF, Leaf, Tree
from riftlog.operators.lookups import lookup_join
from riftlog.operators.positions import BLOCK_ROWS, with_positions
from riftlog.session import settle, settle_last

# Shapes a mining task takes up at once. It bounds memory and changes no result.
CHUNK_SHAPES = 4096
# Tokens are counted by so many parts of their hash, to tell rare ones.
TOKEN_PARTS = 1 << 20
# Bits per template of the bitmap of tokens that templates are found by, and most of its bits (log2).
BITS_EACH, MOST_BITS = 16, 27
# Tokens of a row that its mark of 128 bits speaks of.
MARKED = 64

_MINED = (
    "n_tokens int, first_token string, template string, first_line_no bigint, "
    "since_line_no bigint, version int, is_current boolean, n_rows bigint, known_no bigint"
)
_MINED_NAMES = [column.split()[0] for column in _MINED.split(", ")]


def with_shape(rows: DataFrame, message: str = "message", masked: str | None = None) -> DataFrame:
    """Add ``shape``, the masked message. Masking is the costly step per row: rows that are
    read several times are stored with their shape, and ``masked`` then names its column."""
    if masked:
        return rows.withColumn("shape", F.col(masked))
    return computed_once(rows, shape=shape_of(F.col(message)))


def distinct_shapes(
    rows: DataFrame, order: str = "line_no", tree: Tree = FIRST_TOKEN, templates: DataFrame | None = None
) -> DataFrame:
    """``shape, n_rows, first_line_no, n_tokens, first_token``. Equal shapes are
    combined on the map side, so copies cost nothing downstream. ``first_token`` holds
    the tokens on the way to the leaf; with ``templates`` that way is theirs."""
    shapes = (
        rows.filter(F.col("shape").isNotNull())
        .groupBy("shape")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min(order).alias("first_line_no"))
    )
    return tree.place(shapes, templates)


def number_templates(
    templates: DataFrame, order: str = "first_line_no", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``log_key``: LG_KEY_1, LG_KEY_2, ... by first appearance."""
    return (
        with_positions(templates, order, block_rows=block_rows)
        .withColumn("log_key", F.concat(F.lit(KEY_PREFIX), (F.col("pos") + 1).cast("string")))
        .drop("pos")
    )


def shape_templates(rows: DataFrame, order: str = "line_no") -> DataFrame:
    """The simplest template table: every distinct shape is a template."""
    shapes = distinct_shapes(rows, order).select(
        F.col("shape").alias("template"), "n_rows", "first_line_no"
    )
    return settle(number_templates(shapes), "templates")


def _finished(key: tuple, leaf: Leaf, changes: list[tuple] | None, keys: list):
    """The rows of a leaf: with ``changes`` all versions of its templates, else the current
    ones."""
    if changes is None:
        changes = ((p, leaf.versions[p], leaf.text(p), leaf.since[p]) for p in range(len(leaf.first)))
    for p, version, text, since in changes:
        yield (*key, text, leaf.first[p], since, version, version == leaf.versions[p], leaf.n_rows[p],
               keys[p] if p < len(keys) else None)


def _mine_sorted(similarity: float, chunk: int, versions: bool = False):
    """Mine rows that come sorted by leaf, known templates first, then shapes in
    order of appearance. Shapes pass by ``chunk`` at a time; what is held are the
    templates of one leaf, and with ``versions`` the texts they had. Rows of many leaves
    go out together."""

    def mine(batches):
        rows = mined(batches)
        while part := list(itertools.islice(rows, CHUNK_SHAPES)):
            yield pd.DataFrame(part, columns=_MINED_NAMES)

    def mined(batches):
        key, leaf, keys = None, Leaf(), []
        changes = [] if versions else None
        for pdf in batches:
            sizes, heads = pdf["n_tokens"].to_numpy(), pdf["first_token"].to_numpy()
            known_no = pdf["known_no"].to_numpy(dtype=float, na_value=np.nan)
            is_known = ~np.isnan(known_no)
            shapes, lines, counts = pdf["shape"].tolist(), pdf["first_line_no"].tolist(), pdf["n_rows"].tolist()
            edge = (sizes[1:] != sizes[:-1]) | (heads[1:] != heads[:-1]) | (is_known[1:] != is_known[:-1])
            starts = [0, *(np.flatnonzero(edge) + 1).tolist(), len(pdf)]
            for a, b in zip(starts, starts[1:]):
                if a == b:
                    continue
                here = (int(sizes[a]), heads[a])
                if here != key:
                    if key:
                        yield from _finished(key, leaf, changes, keys)
                    key, leaf, keys = here, Leaf(), []
                    changes = [] if versions else None
                for at in range(a, b, chunk):
                    end = min(b, at + chunk)
                    if is_known[a]:
                        if versions:
                            changes += [(len(keys) + i, 1, shapes[at + i], lines[at + i]) for i in range(end - at)]
                        leaf.hold(shapes[at:end], lines[at:end], [1] * (end - at), counts[at:end])
                        keys += known_no[at:end].astype(int).tolist()
                    else:
                        made = leaf.add(shapes[at:end], lines[at:end], counts[at:end], similarity, versions)[1]
                        if versions:
                            changes += made
        if key:
            yield from _finished(key, leaf, changes, keys)

    return mine


def _mine(shapes: DataFrame, similarity: float, chunk: int, versions: bool = False) -> DataFrame:
    """Mine each leaf in one task; a task takes many small leaves. Without ``versions``
    only the current ones come out."""
    return (
        shapes.repartition(*LEAF)
        .sortWithinPartitions(*LEAF, F.col("known_no").asc_nulls_last(), "first_line_no", "shape")
        .mapInPandas(_mine_sorted(similarity, chunk, versions), _MINED)
    )


def mine_versions(
    shapes: DataFrame, similarity: float = SIMILARITY, chunk: int = CHUNK_SHAPES, versions: bool = True
) -> DataFrame:
    """Mine templates from distinct shapes. Every version a template went through
    is a row, from the line that brought it about; ``is_current`` marks the last. Without
    ``versions`` only the last are kept, in memory too.
    ``first_line_no`` is where the template first appeared, and ``n_rows`` counts
    its input rows.

    A leaf is mined in order of appearance, whatever its size: its shapes stream
    through one task, ``chunk`` at a time, sorted by Spark; only its templates stay
    in memory. The order is the rule of the method, so a leaf is not split."""
    work = shapes.select(*LEAF, "shape", "n_rows", "first_line_no", F.lit(None).cast("bigint").alias("known_no"))
    return _mine(work, similarity, chunk, versions).drop("known_no")


def current_templates(versions: DataFrame) -> DataFrame:
    """One row per current template text, with its key."""
    merged = (
        versions.filter("is_current")
        .groupBy("template", *LEAF)
        .agg(F.sum("n_rows").alias("n_rows"), F.min("first_line_no").alias("first_line_no"))
    )
    return number_templates(settle(merged, "mined"))


def mine_templates(
    rows: DataFrame, similarity: float = SIMILARITY, order: str = "line_no", tree: Tree = FIRST_TOKEN,
    masked: str | None = None, **options
) -> DataFrame:
    """From rows with a ``message`` to the template table: ``log_key, template,
    n_rows, first_line_no, n_tokens, first_token``. ``masked`` is that of ``with_shape``."""
    def mined() -> DataFrame:
        shapes = distinct_shapes(with_shape(rows, masked=masked), order, tree)
        return current_templates(mine_versions(shapes, similarity, versions=False, **options))

    return settle_last(rows.sparkSession, mined, "templates")


def learn_more(
    templates: DataFrame, shapes: DataFrame, similarity: float = SIMILARITY, chunk: int = CHUNK_SHAPES
) -> DataFrame:
    """The template table after it went on learning from the distinct shapes of
    another log. A known template keeps its key and first line while its text may get
    more general; should two become the same text, the lower key stays. New ones are
    numbered on behind the highest key, by first appearance in the other log."""
    columns = [*LEAF, "shape", "n_rows", "first_line_no", "known_no"]
    known = templates.withColumns({"shape": F.col("template"), "known_no": _key_number()}).select(*columns)
    fresh = shapes.withColumn("known_no", F.lit(None).cast("bigint")).select(*columns)
    mined = _mine(known.unionByName(fresh), similarity, chunk).filter("is_current")
    merged = settle(
        mined.groupBy("template", *LEAF).agg(
            F.sum("n_rows").alias("n_rows"),
            F.min_by("first_line_no", F.struct(F.col("known_no").isNull(), "known_no", "first_line_no")).alias("first_line_no"),
            F.min("known_no").alias("known_no"),
        ),
        "learned",
    )
    highest = templates.agg(F.coalesce(F.max(_key_number()), F.lit(0))).first()[0]
    kept = merged.filter("known_no is not null").withColumn("_no", F.col("known_no"))
    new = with_positions(merged.filter("known_no is null"), "first_line_no", name="_no").withColumn(
        "_no", F.col("_no") + highest + 1
    )
    numbered = kept.unionByName(new).withColumn("log_key", F.concat(F.lit(KEY_PREFIX), F.col("_no").cast("string")))
    return settle(numbered.drop("known_no", "_no"), "templates")


def _key_number():
    return F.substring_index("log_key", "_", -1).cast("bigint")


def _hashed(rows: DataFrame, row: str, text: str) -> DataFrame:
    """``row, _ats``: a hash of leaf, place and token for all tokens of a text but wildcards.
    Place 0, an empty token, is the leaf itself."""
    tokens = F.concat(F.array(F.lit("")), F.split(text, " "))
    return rows.select(row, F.transform(tokens, lambda t, place: F.when(t != WILDCARD, F.xxhash64(*LEAF, place, t))).alias("_ats"))


def _flat_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row, the place and the hash of all tokens of a batch that are no wildcards."""
    starts = column.offsets.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(column)), np.diff(starts))
    place = np.arange(len(row)) - (starts - starts[0])[row]
    values = column.flatten()
    there = values.is_valid().to_numpy(zero_copy_only=False)
    return row[there], place[there], values.drop_null().to_numpy(zero_copy_only=False)


def _marks(n: int, row: np.ndarray, place: np.ndarray, at: np.ndarray) -> list[pa.Array]:
    """Two numbers per row, with a bit for each of its first tokens: a template fits no shape that
    lacks one of its bits."""
    bits = np.zeros((n, 128), bool)
    bits[row[place <= MARKED], at[place <= MARKED] & 127] = True
    return [pa.array(half) for half in np.packbits(bits, axis=1).view(np.int64).T]


def _rare_tokens(hashed: DataFrame) -> DataFrame:
    """``_template, _at, _t0, _t1``: the fixed token of each template that the fewest templates have,
    the leaf if there is none, and the template's mark. Tokens are counted by a part of their
    hash, so what is counted does not grow with them; any token would do."""
    spark = hashed.sparkSession
    part = lambda at: at & (TOKEN_PARTS - 1)

    def count(batches):
        n = np.zeros(TOKEN_PARTS, np.int64)
        for one in batches:
            n += np.bincount(part(_flat_hashes(one.column("_ats"))[2]), minlength=TOKEN_PARTS)
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n[found])], names=["part", "n"])

    counted = hashed.mapInArrow(count, "part bigint, n bigint").groupBy("part").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(TOKEN_PARTS, np.int64)
    counts[counted["part"].to_numpy()] = counted["n"].to_numpy()
    shared = spark.sparkContext.broadcast(counts)

    def pick(batches):
        for one in batches:
            if not one.num_rows:
                continue
            row, place, at = _flat_hashes(one.column("_ats"))
            # Every row has its leaf, place 0.
            order = np.lexsort((place, shared.value[part(at)], place == 0, row))
            first = order[np.searchsorted(row[order], np.arange(one.num_rows))]
            yield pa.RecordBatch.from_arrays(
                [one.column("_template"), pa.array(at[first]), *_marks(one.num_rows, row, place, at)], names=["_template", "_at", "_t0", "_t1"]
            )

    return settle(hashed.mapInArrow(pick, "_template bigint, _at bigint, _t0 bigint, _t1 bigint"), "template-index")


def _looked_up(hashed: DataFrame, index: DataFrame) -> DataFrame:
    """``_shape, _at, _s0, _s1``: the tokens of shapes that a template may be found by, and the mark
    of the shape. A bitmap of the tokens of ``index``, 16 MB at the most, leaves out nearly all
    others where they are read."""
    bits = min(MOST_BITS, max(16, math.ceil(math.log2(max(1, BITS_EACH * index.count())))))
    slot = F.shiftrightunsigned("_at", 64 - bits) + 1
    found = index.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    raw = np.zeros(1 << bits >> 3, np.uint8)
    for r in found.toLocalIterator():  # a bucket has 4 KB
        begin = (r["bucket"] - 1) * 4096
        raw[begin : begin + 4096] = np.frombuffer(r["bits"], np.uint8)
    shared = hashed.sparkSession.sparkContext.broadcast(raw)

    def look(batches):
        for one in batches:
            row, place, at = _flat_hashes(one.column("_ats"))
            where = (at.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
            met = np.flatnonzero(shared.value[where >> 3] >> (where & 7).astype(np.uint8) & 1)
            owner = pa.array(row[met])
            marks = [m.take(owner) for m in _marks(one.num_rows, row, place, at)]
            yield pa.RecordBatch.from_arrays([one.column("_shape").take(owner), pa.array(at[met]), *marks], names=["_shape", "_at", "_s0", "_s1"])

    return hashed.mapInArrow(look, "_shape bigint, _at bigint, _s0 bigint, _s1 bigint")


def match_shapes(shapes: DataFrame, templates: DataFrame) -> DataFrame:
    """Which template each distinct shape fits, without learning: ``shape,
    template, log_key``. A template fits when it has the same leaf and every token
    that is no wildcard is equal; of several the one with the fewest wildcards
    wins, then the one with the lowest key.

    Each template is found by one of its fixed tokens, at its place, that few templates of the
    leaf share, or by the leaf if it has none. A shape looks up its own tokens by numbers
    alone, and only those that a bitmap knows: a token moves as a row number, a hash and a
    mark of the shape, and only for the templates that a shape finds, and whose marks agree,
    are both texts fetched and compared as a whole."""
    if "first_token" not in templates.columns:
        templates = templates.withColumn("first_token", first_token(F.col("template")))
    wild = F.size(F.filter(F.split("template", " "), lambda t: t == WILDCARD))
    # Written first: the number of a row must be the same wherever it is read.
    keyed = settle(
        templates.select(
            "template", "log_key", _key_number().alias("_no"), wild.alias("_wild"),
            token_count(F.col("template")).alias("n_tokens"), "first_token",
        ).withColumn("_template", F.monotonically_increasing_id()),
        "keyed",
    )
    asked = settle(shapes.select("shape", *LEAF).withColumn("_shape", F.monotonically_increasing_id()), "asked")
    index = _rare_tokens(_hashed(keyed, "_template", "template"))
    looked = _looked_up(_hashed(asked, "_shape", "shape"), index)
    met = lookup_join(looked, index, ["_at"], "inner", ["_shape"])
    met = met.filter((F.col("_t0").bitwiseAND(F.bitwise_not("_s0")) == 0) & (F.col("_t1").bitwiseAND(F.bitwise_not("_s1")) == 0))
    named = lookup_join(met.select("_shape", "_template"), keyed, ["_template"], "inner", ["_shape"])
    found = named.join(asked.withColumnsRenamed({c: f"_{c}" for c in LEAF}), "_shape")
    fits = F.forall(F.arrays_zip(F.split("template", " ").alias("t"), F.split("shape", " ").alias("s")), lambda p: (p["t"] == WILDCARD) | (p["t"] == p["s"]))
    same_leaf = functools.reduce(Column.__and__, [F.col(c) == F.col(f"_{c}") for c in LEAF])
    best = F.min(F.struct("_wild", "_no", "template", "log_key"))
    return (
        found.filter(same_leaf & fits)
        .groupBy("_shape", "shape")
        .agg(best.alias("b"))
        .select("shape", F.col("b.template").alias("template"), F.col("b.log_key").alias("log_key"))
    )


def tag_rows(
    rows: DataFrame, templates: DataFrame, message: str = "message", order: str = "line_no", tree: Tree = FIRST_TOKEN,
    masked: str | None = None,
) -> DataFrame:
    """Add ``log_key`` to each row: its template's key, or UNMAPPED; rows without
    a message get none. Only distinct shapes are matched. ``tree`` is the one that the
    templates were mined with, ``masked`` that of ``with_shape``."""
    shaped = with_shape(rows, message, masked)

    def matched() -> DataFrame:
        found = match_shapes(distinct_shapes(shaped, order, tree, templates), templates)
        return found.select(_short(F.col("shape")).alias("_short"), "log_key")

    matches = settle_last(rows.sparkSession, matched, "matches")
    # What moves is a short name of the shape, and no text that the caller does not ask for.
    named = shaped.withColumns({"_short": _short(F.col("shape")), "_given": F.col(message).isNotNull()})
    return (
        lookup_join(named, matches, ["_short"], "left", [order])
        .withColumn("log_key", F.when(F.col("_given"), F.coalesce("log_key", F.lit(UNMAPPED))))
        .select(*rows.columns, "log_key")
    )


def _short(shape: Column) -> Column:
    """128 bits of a cryptographic hash, which stand for the text."""
    return F.substring(F.unhex(F.sha2(shape, 256)), 1, 16)


def template_text(tagged: DataFrame, templates: DataFrame, order: str = "line_no") -> DataFrame:
    """Add the ``template`` text of each row's key; null for an unknown key."""
    return lookup_join(tagged, templates.select("log_key", "template"), ["log_key"], "left", [order])


def template_usage(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("log_key").agg(F.count(F.lit(1)).alias("n"))


def unseen_templates(tagged: DataFrame, templates: DataFrame) -> DataFrame:
    """Templates that no row of ``tagged`` carries."""
    return templates.join(template_usage(tagged).select("log_key"), "log_key", "left_anti")
