"""A forest that stays a table: trees over large shares of a large table have as many
nodes as the table has rows, so neither the driver nor a task holds one.

A task takes some whole trees (``PIECE_NODES`` nodes) and some chunks of rows, and walks all
these rows down all these trees; only the sums of a row's paths leave it. So rows move once to
each piece of the forest, and not once to each tree.

Trees of more than ``TREE_NODES`` nodes are cut into blocks of ``LEVELS`` levels, named by their top node. A row walks down a
block in the task that holds it and goes on to the next block below, all rows and trees at
once; what meets is one block and at most ``BLOCK_ROWS`` of its rows, so the block of a root,
which all rows pass, is dealt to many tasks. The lengths of a row's paths are added up by an
aggregate at the end. A tree over 2^30 rows takes four rounds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riftlog.functions.vectors import dense_rows
from riftlog.operators.iforest_whole import STEP_CELLS, below, flat, number_kind, unpacked, walk
from riftlog.operators.lookups import lookup_join
from riftlog.session import settle

LEVELS, BLOCK_ROWS = 10, 50_000
# Nodes of the trees that a scoring task takes at a time, of a tree that is not cut into blocks,
# and rows of a chunk that differ.
PIECE_NODES, TREE_NODES, CHUNK_ROWS = 1 << 21, 1 << 22, 1 << 14
NODES = ("tree", "node", "feature", "threshold", "size")


@dataclass(frozen=True)
class TableForest:
    """``nodes``: tree, node (root 1, children 2n and 2n + 1), feature (-1 in a leaf),
    threshold and size. Where these are made when they are read, ``fresh`` gives those of the
    first so many trees, which are ``n_nodes`` in all or fewer."""

    nodes: DataFrame
    n_trees: int
    sample: int
    dim: int
    offset: float = -0.5
    fresh: Callable[[int], DataFrame] | None = None
    n_nodes: int | None = None

    def first(self, n_trees: int) -> TableForest:
        if self.fresh:
            return replace(self, nodes=self.fresh(n_trees), n_trees=n_trees)
        return TableForest(self.nodes.filter(F.col("tree") < n_trees), n_trees, self.sample, self.dim, self.offset)

    def table(self, spark: SparkSession) -> DataFrame:
        return self.nodes.select(*NODES).withColumns(
            {"n_trees": F.lit(self.n_trees), "sample": F.lit(self.sample), "dim": F.lit(self.dim), "offset": F.lit(self.offset)}
        )

    @classmethod
    def from_table(cls, table: DataFrame) -> TableForest:
        one = table.select("n_trees", "sample", "dim", "offset").first()
        return cls(table.select(*NODES), one["n_trees"], one["sample"], one["dim"], one["offset"])


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """``tree, root`` and the nodes of each block in arrays, with the depth of the root."""
    depth = F.length(F.conv("node", 10, 2)) - 1
    level = depth - depth % levels
    top = F.expr("shiftright(node, depth - level)")
    own = nodes.withColumn("depth", depth).withColumn("level", level).withColumn("root", top)
    rows = F.array_sort(F.collect_list(F.struct(*NODES[1:])))
    return own.groupBy("tree", "root", "level").agg(rows.alias("rows"))


def _walk(dim: int, levels: int, average_path, row_id: str, is_struct: bool):
    def walk(blocks: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = rows.assign(path=np.nan, root=np.int64(0))
        if not len(rows) or not len(blocks):
            return out[[row_id, "tree", "root", "features", "path"]]
        table = pd.DataFrame(list(blocks["rows"].iloc[0]))
        node = table["node"].to_numpy(np.int64)
        feature, threshold = table["feature"].to_numpy(np.int64), table["threshold"].to_numpy(float)
        used = np.unique(feature[feature >= 0])
        given = pd.DataFrame(rows["features"].tolist()) if is_struct else rows["features"]
        x = dense_rows(given, dim, used)
        here = np.full(len(rows), int(blocks["root"].iloc[0]), np.int64)
        depth = int(blocks["level"].iloc[0])
        path = np.full(len(rows), np.nan)
        active = np.arange(len(rows))
        for _ in range(levels):
            at = np.searchsorted(node, here[active])
            leaf = feature[at] < 0
            done = active[leaf]
            path[done] = depth + average_path(table["size"].to_numpy(float)[at[leaf]])
            active, at = active[~leaf], at[~leaf]
            if not len(active):
                break
            right = x[active, np.searchsorted(used, feature[at])] > threshold[at]
            here[active] = 2 * here[active] + right
            depth += 1
        out["path"] = path
        # What goes on is at the root of a block below.
        out["root"] = np.where(np.isnan(path), here, 0)
        return out[[row_id, "tree", "root", "features", "path"]]

    return walk


def _packed_trees(nodes: DataFrame) -> DataFrame:
    """A row per tree: its nodes in flat numbers, by node; ``below`` has the places of the left
    children, and ``path`` the length of a path that ends in a node."""
    from riftlog.operators.iforest import average_path

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        node, feature = pdf["node"].to_numpy(), pdf["feature"].to_numpy(np.int32)
        path = np.frexp(node.astype(float))[1] - 1 + average_path(pdf["size"].to_numpy())
        parts = (feature, pdf["threshold"].to_numpy(float), below(node, feature), path)
        return pd.DataFrame([(int(pdf["tree"].iloc[0]), len(pdf), *[p.tobytes() for p in parts])], columns=["tree", "n", "feature", "threshold", "below", "path"])

    kinds = "tree int, n int, feature binary, threshold binary, below binary, path binary"
    return settle(nodes.groupBy("tree").applyInPandas(pack, kinds), "forest-trees")


def _chunks(df: DataFrame, row_id: str, features: str) -> DataFrame:
    """Rows in chunks, of equal rows one: ``chunk, n``, the flat numbers of the rows that differ, and
    ``ids`` of all rows with the ``place`` of each among those."""
    kind = number_kind(df, features)
    given = df.select(F.col(row_id).alias("id"), F.col(features).alias("features"))
    id_kind = given.schema["id"].dataType.simpleString()
    kinds = f"n int, ids array<{id_kind}>, place binary, lengths binary, places binary, numbers binary"

    def pack(batches):
        number: dict = {}
        ids, place, is_dense = [], [], False

        def chunk():
            lengths = np.array([len(numbers) // np.dtype(kind).itemsize for _, numbers in number], np.int32)
            cells = [[len(number)], [pa.concat_arrays(ids).to_pylist()], [np.concatenate(place).astype(np.int32).tobytes()],
                     [lengths.tobytes()], [None if is_dense else b"".join(p for p, _ in number)], [b"".join(v for _, v in number)]]
            kinds = [pa.int32(), pa.list_(ids[0].type), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=["n", "ids", "place", "lengths", "places", "numbers"])

        for one in batches:
            if not one.num_rows:
                continue
            lengths, places, numbers = flat(one.column("features"), kind)
            is_dense, at = places is None, np.cumsum([0, *lengths]).tolist()
            keys = [(b"" if is_dense else places[a:b].tobytes(), numbers[a:b].tobytes()) for a, b in zip(at, at[1:])]
            ids.append(one.column("id"))
            place.append(np.fromiter((number.setdefault(k, len(number)) for k in keys), np.int64, len(keys)))
            if len(number) >= CHUNK_ROWS or sum(map(len, ids)) >= 16 * CHUNK_ROWS:
                yield chunk()
                number, ids, place = {}, [], []
        if ids:
            yield chunk()

    return settle(given.mapInArrow(pack, kinds).withColumn("chunk", F.monotonically_increasing_id()), "forest-chunks")


def _walk_pieces(dim: int, kind: str, n_trees: tuple[int, ...]):
    """The task of some trees and some chunks."""

    def walked(trees: pd.DataFrame, chunks: pd.DataFrame) -> pd.DataFrame:
        out, grown = [], []
        for t in trees.to_dict("records"):
            grown.append((t["tree"], *[np.frombuffer(t[c], k) for c, k in (("feature", "i4"), ("threshold", "f8"), ("below", "i4"), ("path", "f8"))]))
        # Rows are only asked for the features that some node cuts.
        used = np.unique(np.concatenate([np.unique(t[1]) for t in grown])) if grown else np.zeros(0, np.int32)
        used = used[used >= 0]
        grown = [(tree, np.where(f >= 0, np.searchsorted(used, f), -1), *rest) for tree, f, *rest in grown]
        step = max(1, STEP_CELLS // max(len(used), 1))
        for c in chunks.to_dict("records"):
            sums = np.zeros((c["n"], len(n_trees)))
            for at, x in _slices(c, dim, kind, used, step):
                for tree, feature, threshold, left, path in grown:
                    ends = path[walk(x, 0, feature, threshold, left)]
                    for i, n in enumerate(n_trees):
                        if tree < n:
                            sums[at : at + len(x), i] += ends
            out.append((c["chunk"], sums.tobytes()))
        return pd.DataFrame(out, columns=["chunk", "sums"])

    return walked


def _slices(chunk: dict, dim: int, kind: str, used: np.ndarray, step: int):
    """The rows of a chunk as matrices of ``step`` rows, with the place of the first."""
    lengths = np.frombuffer(chunk["lengths"], np.int32)
    at = np.cumsum(np.r_[0, lengths.astype(np.int64)])
    for a in range(0, chunk["n"], step):
        b = min(chunk["n"], a + step)
        cut = lambda v, width: None if v is None else v[at[a] * width : at[b] * width]
        part = {"n": b - a, "lengths": lengths[a:b].tobytes(), "places": cut(chunk["places"], 4), "numbers": cut(chunk["numbers"], np.dtype(kind).itemsize)}
        yield a, unpacked(part, dim, kind, used)


def path_sums(
    df: DataFrame, forest: TableForest, row_id: str, features: str, n_trees: tuple[int, ...],
    levels: int = LEVELS, block_rows: int = BLOCK_ROWS, tree_nodes: int = TREE_NODES, piece_nodes: int = PIECE_NODES,
) -> DataFrame:
    """``row_id`` and ``s0, s1, ...``: the scores under the first so many trees each."""
    if 2 * forest.sample - 1 > tree_nodes:
        return _block_sums(df, forest, row_id, features, n_trees, levels, block_rows)
    from riftlog.operators.iforest import average_path

    spark, names = df.sparkSession, [f"s{i}" for i in range(len(n_trees))]
    trees = _packed_trees(forest.nodes)
    # One row per tree: trees go to pieces in order, until a piece is full.
    sizes = sorted(tuple(r) for r in trees.select("tree", "n").collect())
    before = np.cumsum([0, *[n for _, n in sizes]])
    piece_of = [(tree, int(b // piece_nodes)) for (tree, _), b in zip(sizes, before)]
    held = sorted({p for _, p in piece_of})
    chunks = _chunks(df, row_id, features)
    n_parts = max(1, min(chunks.count(), 2 * spark.sparkContext.defaultParallelism // max(1, len(held))))
    pieces = spark.createDataFrame(piece_of, "tree int, piece int")
    parts = F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))).alias("part")
    dealt = trees.join(F.broadcast(pieces), "tree").select("*", parts)
    asked = chunks.select("chunk", "n", "lengths", "places", "numbers", F.pmod(F.xxhash64("chunk"), F.lit(n_parts)).cast("int").alias("part"))
    asked = asked.withColumn("piece", F.explode(F.array(*[F.lit(p) for p in held])))
    kind = number_kind(df, features)
    walked = dealt.groupBy("piece", "part").cogroup(asked.groupBy("piece", "part")).applyInPandas(
        _walk_pieces(forest.dim, kind, n_trees), "chunk bigint, sums binary"
    )
    scale = float(average_path(forest.sample)) or 1.0
    id_kind = df.schema[row_id].dataType.simpleString()

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = sum(np.frombuffer(s) for s in pdf["sums"])
        return pd.DataFrame([(int(pdf["chunk"].iloc[0]), sums.tobytes())], columns=["chunk", "sums"])

    def spread(batches):
        for one in batches:
            for i in range(one.num_rows):
                ids, place = one.column("ids")[i].values, np.frombuffer(one.column("place")[i].as_py(), np.int32)
                depth = np.frombuffer(one.column("sums")[i].as_py()).reshape(-1, len(n_trees))
                scores = [-(2.0 ** (-depth[:, j] / n / scale))[place] for j, n in enumerate(n_trees)]
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, scores)], names=[row_id, *names])

    totals = settle(walked.groupBy("chunk").applyInPandas(total, "chunk bigint, sums binary"), "forest-totals")
    return chunks.select("chunk", "ids", "place").join(totals, "chunk").mapInArrow(spread, f"`{row_id}` {id_kind}, " + ", ".join(f"{c} double" for c in names))


def _block_sums(
    df: DataFrame, forest: TableForest, row_id: str, features: str, n_trees: tuple[int, ...], levels: int, block_rows: int
) -> DataFrame:
    """The same where trees are cut into blocks."""
    from riftlog.operators.iforest import average_path

    kind = df.schema[features].dataType
    blocks = settle(_blocks(forest.nodes, levels), "forest-blocks")
    rows = settle(df.select(row_id, F.col(features).alias("features")), "forest-scored")
    id_kind = rows.schema[row_id].dataType.simpleString()
    schema = f"{row_id} {id_kind}, tree int, root bigint, features {kind.simpleString()}, path double"
    trees = F.explode(F.sequence(F.lit(0), F.lit(forest.n_trees - 1))).alias("tree")
    state = rows.select(row_id, trees, F.lit(1).cast("bigint").alias("root"), "features")
    walk = _walk(forest.dim, levels, average_path, row_id, kind.typeName() == "struct")
    done = None
    while True:
        state = settle(state, "forest-state")
        parts = state.groupBy("tree", "root").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
        parts = settle(parts, "forest-parts")
        if parts.isEmpty():
            break
        dealt = lookup_join(state, parts, ["tree", "root"], "inner", [row_id])
        dealt = dealt.withColumn("part", F.pmod(F.xxhash64(row_id), F.col("parts")).cast("int")).drop("parts")
        own = blocks.join(parts, ["tree", "root"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        walked = own.groupBy("tree", "root", "part").cogroup(dealt.groupBy("tree", "root", "part")).applyInPandas(walk, schema)
        walked = settle(walked, "forest-walked")
        ended = walked.filter(F.col("path").isNotNull() & ~F.isnan("path")).select(row_id, "tree", "path")
        done = ended if done is None else done.unionByName(ended)
        state = walked.filter(F.col("root") > 0).select(row_id, "tree", "root", "features")
    if done is None:
        return rows.select(row_id, *[F.lit(None).cast("double").alias(f"s{i}") for i in range(len(n_trees))])
    return score_sums(done, forest, row_id, n_trees)


def score_sums(paths: DataFrame, forest: TableForest, row_id: str, n_trees: tuple[int, ...]) -> DataFrame:
    """``row_id`` and ``s0, s1, ...`` from ``row_id, tree, path`` of all rows and trees."""
    from riftlog.operators.iforest import average_path

    scale = float(average_path(forest.sample)) or 1.0
    sums = [F.sum(F.when(F.col("tree") < n, F.col("path"))).alias(f"s{i}") for i, n in enumerate(n_trees)]
    total = paths.groupBy(row_id).agg(*sums)
    return total.select(row_id, *[(-F.pow(F.lit(2.0), -F.col(f"s{i}") / n / scale)).alias(f"s{i}") for i, n in enumerate(n_trees)])
