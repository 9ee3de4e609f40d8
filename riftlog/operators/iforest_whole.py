"""Trees over most rows of a table, each grown in one task.

Every such tree needs nearly all rows. Rows are packed into chunks of flat numbers, and trees
are dealt out to some groups, twice as many as the cluster has slots: a chunk moves once to
each group and not to each tree. A task makes the matrix of all rows once (``HELD_BYTES`` at the
most; a larger table is grown by aggregates over all tasks), and for one tree of its group
after the other it draws the sample, grows it, and walks all rows down. Of the trees only the
sums of the rows' paths leave the task, or their nodes where these are asked for."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riftlog.session import settle

# Numbers of the matrix that a task holds, in bytes.
HELD_BYTES = 1 << 28
# Numbers that are looked at or walked with at a time.
STEP_CELLS = 1 << 20

_CHUNK = "n int, ids array<{id}>, heads array<bigint>, lengths binary, places binary, numbers binary"
_GROWN = "tree int, node bigint, feature int, threshold double, size bigint"
_SUMS = "chunk bigint, n_nodes bigint, sums binary"


def number_kind(df: DataFrame, features: str) -> str:
    """How a number of the features is held."""
    kind = df.schema[features].dataType
    return "f4" if kind.typeName() == "array" and kind.elementType.typeName() == "float" else "f8"


def fits_a_task(df: DataFrame, features: str, dim: int, n_rows: int) -> bool:
    return n_rows * dim * np.dtype(number_kind(df, features)).itemsize <= HELD_BYTES


def flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Numbers per row, their places (None: all, in order) and the numbers of a batch."""
    if column.null_count:
        raise ValueError("a row has no features")
    lists = column.field("indices") if pa.types.is_struct(column.type) else column
    values = column.field("values") if lists is not column else column
    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int32)
    places = None if lists is column else lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    return lengths, places, values.flatten().to_numpy(zero_copy_only=False).astype(kind)


def unpacked(row: dict, dim: int, kind: str, columns: np.ndarray | None = None) -> np.ndarray:
    """The (rows, dim) matrix of a chunk; with ``columns``, sorted, only those of it."""
    numbers = np.frombuffer(row["numbers"], kind)
    if row["places"] is None:
        x = numbers.reshape(row["n"], dim)
        return x if columns is None else x[:, columns]
    rows = np.repeat(np.arange(row["n"]), np.frombuffer(row["lengths"], np.int32))
    places = np.frombuffer(row["places"], np.int32)
    if columns is not None:
        if not len(columns):
            return np.zeros((row["n"], 0), kind)
        found = np.minimum(np.searchsorted(columns, places), len(columns) - 1)
        kept = columns[found] == places
        rows, places, numbers = rows[kept], found[kept], numbers[kept]
    out = np.zeros((row["n"], dim if columns is None else len(columns)), kind)
    out[rows, places] = numbers
    return out


def packed_rows(df: DataFrame, row_id: str, features: str, seed: int) -> DataFrame:
    """Chunks of rows, written once: ``chunk, n``, the rows' ``ids``, their ``heads`` (the hash of
    a draw but for the tree) and the flat numbers of their features."""
    kind = number_kind(df, features)
    head = F.xxhash64(F.lit(seed), F.lit("tree"), F.col(row_id))
    given = df.select(F.col(row_id).alias("id"), head.alias("head"), F.col(features).alias("features"))
    schema = _CHUNK.format(id=given.schema["id"].dataType.simpleString())

    def pack(batches):
        for one in batches:
            if not one.num_rows:
                continue
            lengths, places, numbers = flat(one.column("features"), kind)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([one.num_rows], pa.int32()), pa.ListArray.from_arrays([0, one.num_rows], one.column("id")),
                    pa.ListArray.from_arrays([0, one.num_rows], one.column("head")), pa.array([lengths.tobytes()], pa.binary()),
                    pa.array([None if places is None else places.tobytes()], pa.binary()), pa.array([numbers.tobytes()], pa.binary()),
                ],
                names=["n", "ids", "heads", "lengths", "places", "numbers"],
            )

    return settle(given.mapInArrow(pack, schema).withColumn("chunk", F.monotonically_increasing_id()), "forest-chunks")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
    return x ^ (x >> np.uint64(32))


def hash_on(heads: np.ndarray, number: int) -> np.ndarray:
    """``xxhash64(..., number)`` where ``heads`` are the hashes of what stands before it."""
    with np.errstate(over="ignore"):
        first = np.uint64(number & 0xFFFFFFFF) * np.uint64(0x9E3779B185EBCA87)
        x = (heads.astype(np.uint64) + np.uint64(0x27D4EB2F165667C5 + 4)) ^ first
        x = (x << np.uint64(23)) | (x >> np.uint64(41))
        return _mixed(x * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))


def drawn(heads: np.ndarray, ids: list, tree: int, size: int, offer: float) -> np.ndarray:
    """Which rows are the sample of a tree: the ``size`` of lowest hash, ties by id."""
    n = len(heads)
    if size >= n:
        return np.ones(n, bool)
    draw = hash_on(heads, tree) & np.uint64((1 << 40) - 1)
    offered = draw < np.uint64(min(math.ceil(offer * (1 << 40)), 1 << 40))
    if offered.sum() <= size:
        return offered
    last = np.partition(draw, size - 1)[size - 1]
    own, ties = draw < last, np.flatnonzero(draw == last)
    if len(ties) > 1:
        at = np.cumsum([0, *[len(x) for x in ids]])
        part = np.searchsorted(at, ties, "right") - 1
        named = [ids[p][int(t - at[p])].as_py() for p, t in zip(part, ties)]
        ties = ties[sorted(range(len(ties)), key=lambda i: (named[i] is not None, named[i]))]
    own[ties[: size - int(own.sum())]] = True
    return own


def below(node: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """Per inner node of a tree, sorted, the place of its left child; the right one is next."""
    out = np.zeros(len(node), np.int32)
    inner = np.flatnonzero(feature >= 0)
    out[inner] = np.searchsorted(node, 2 * node[inner])
    return out


def walk(x: np.ndarray, root: int, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The leaf of every row of ``x``, as a place among the nodes; ``feature`` is a column of ``x``."""
    here, active = np.full(len(x), root, np.int64), np.arange(len(x))
    numbers, width = np.ascontiguousarray(x).reshape(-1), x.shape[1]
    at = here
    while len(active):
        column = feature[at]
        inner = np.flatnonzero(column >= 0)
        if len(inner) < len(active):
            active, at, column = active[inner], at[inner], column[inner]
        at = left[at] + (numbers[active * width + column] > threshold[at])
        here[active] = at
    return here


def _tasks(spark: SparkSession, n_trees: int) -> dict[int, int]:
    """Keys of the groups of trees, such that each is dealt to a partition of its own."""
    n = max(1, min(n_trees, 2 * spark.sparkContext.defaultParallelism))
    found = spark.range(40 * n).groupBy(F.pmod(F.hash("id"), F.lit(n))).agg(F.min("id").alias("key")).collect()
    keys = sorted(r["key"] for r in found)
    return {key: i for i, key in enumerate(keys)}


def _grow_groups(groups: dict[int, int], counts: tuple[int, ...], n_rows: int, dim: int, kind: str, size: int, offer: float, seed: int, nodes: bool):
    """The task of one group of trees after the other."""

    def trees_of(group: int, x: np.ndarray, heads: np.ndarray, ids: list, chunks: list):
        from riftlog.operators.iforest import average_path, depth_limit, grow_tree

        limit, columns = depth_limit(size), np.arange(dim)
        sums, n_nodes = np.zeros((len(x), len(counts))), 0
        for tree in range(groups[group], max(counts), len(groups)):
            own = drawn(heads, ids, tree, size, offer)
            grown, leaf = grow_tree(x, columns, seed, tree, limit, rows=np.flatnonzero(own))
            node, feature, threshold, sizes = (grown[c].to_numpy() for c in ("node", "feature", "threshold", "size"))
            n_nodes += len(node)
            if nodes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(node), tree, np.int32)), pa.array(node), pa.array(feature.astype(np.int32)), pa.array(threshold), pa.array(sizes)],
                    names=["tree", "node", "feature", "threshold", "size"],
                )
                continue
            path = np.frexp(node.astype(float))[1] - 1 + average_path(sizes)
            ends = np.empty(len(x))
            ends[own] = path[np.searchsorted(node, leaf[own])]
            left, guests = below(node, feature), np.flatnonzero(~own)
            step = max(1, STEP_CELLS // max(dim, 1))
            for at in range(0, len(guests), step):
                some = guests[at : at + step]
                ends[some] = path[walk(x[some], 0, feature, threshold, left)]
            for i, n in enumerate(counts):
                if tree < n:
                    sums[:, i] += ends
        if not nodes:
            for i, (chunk, start, n) in enumerate(chunks):
                yield pa.RecordBatch.from_pydict(
                    {"chunk": [chunk], "n_nodes": [0 if i else n_nodes], "sums": [sums[start : start + n].tobytes()]},
                    pa.schema([("chunk", pa.int64()), ("n_nodes", pa.int64()), ("sums", pa.binary())]),
                )

    def run(batches):
        group, at = None, 0
        x = heads = None
        ids, chunks = [], []
        for one in batches:
            for i in range(one.num_rows):
                key = one.column("group")[i].as_py()
                if key != group:
                    if group is not None:
                        yield from trees_of(group, x[:at], heads[:at], ids, chunks)
                    group, at, ids, chunks = key, 0, [], []
                    x = np.empty((n_rows, dim), kind) if x is None else x
                    heads = np.empty(n_rows, np.int64) if heads is None else heads
                row = {c: one.column(c)[i].as_py() for c in ("chunk", "n", "lengths", "places", "numbers")}
                x[at : at + row["n"]] = unpacked(row, dim, kind)
                heads[at : at + row["n"]] = one.column("heads")[i].values.to_numpy(zero_copy_only=False)
                ids.append(one.column("ids")[i].values)
                chunks.append((row["chunk"], at, row["n"]))
                at += row["n"]
        if group is not None:
            yield from trees_of(group, x[:at], heads[:at], ids, chunks)

    return run


@dataclass(frozen=True)
class WholeTrees:
    """Packed rows, and how trees are grown over them."""

    chunks: DataFrame
    n_rows: int
    dim: int
    kind: str
    size: int
    offer: float
    seed: int

    def _grown(self, counts: tuple[int, ...], nodes: bool) -> DataFrame:
        groups = _tasks(self.chunks.sparkSession, max(counts))
        grow = _grow_groups(groups, counts, self.n_rows, self.dim, self.kind, self.size, self.offer, self.seed, nodes)
        keys = F.explode(F.array(*[F.lit(key) for key in groups])).alias("group")
        dealt = self.chunks.select("*", keys).repartition(len(groups), "group").sortWithinPartitions("group")
        return dealt.mapInArrow(grow, _GROWN if nodes else _SUMS)

    def nodes(self, n_trees: int) -> DataFrame:
        """``tree, node, feature, threshold, size`` of the first trees."""
        return self._grown((n_trees,), True)

    def scores(self, counts: tuple[int, ...], scale: float) -> tuple[int, DataFrame]:
        """The number of nodes, and ``s0, s1, ...``: the scores of all rows under the first
        ``counts`` trees each."""
        sums = settle(self._grown(counts, False), "forest-sums")
        n_nodes = sums.agg(F.coalesce(F.sum("n_nodes"), F.lit(0))).first()[0]
        names = [f"s{i}" for i in range(len(counts))]

        def total(pdf: pd.DataFrame) -> pd.DataFrame:
            depth = sum(np.frombuffer(s) for s in pdf["sums"]).reshape(-1, len(counts))
            return pd.DataFrame({c: -(2.0 ** (-depth[:, i] / n / scale)) for i, (c, n) in enumerate(zip(names, counts))})

        return n_nodes, sums.groupBy("chunk").applyInPandas(total, ", ".join(f"{c} double" for c in names))
