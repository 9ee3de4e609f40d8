"""Isolation forest: Liu, Ting, Zhou, "Isolation Forest" (ICDM 2008).

Trees grow in parallel, each from its own random sample of rows, large nodes by
aggregates and small ones in a task each; the grown forest is a table of nodes; every row is scored by all trees, one Arrow batch at a time."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from riftlog.config import (
    FOREST_CONTAMINATION, FOREST_SAMPLES, FOREST_SEED, FOREST_TREES, FOREST_TRIALS,
)
from riftlog.functions.vectors import dense_rows, distinct_rows, used_columns
from riftlog.operators.iforest_table import TableForest, path_sums, score_sums
from riftlog.operators.iforest_whole import WholeTrees, fits_a_task, number_kind, packed_rows
from riftlog.operators.kmeans import SparseColumn, feature_column
from riftlog.operators.lookups import lookup_join
from riftlog.operators.quantiles import exact_quantiles
from riftlog.operators.runs import best_run
from riftlog.operators.search import Choice, Number, Space, study, trial_table
from riftlog.session import settle, side_by_side

AUTO_ROWS = 256
# Rows a task grows a node from. Larger nodes are cut by aggregates over all tasks
# first; where a node is grown changes nothing about it.
NODE_ROWS = 16384
# Of dense rows, whose width is known, a task takes as many as have so many numbers (64 MB).
NODE_CELLS = 1 << 23
# Numbers of a node that is grown level by level, with all its nodes below at once.
LEVEL_CELLS = 1 << 18
# Nodes of a forest that the driver and every scoring task may hold; a larger forest stays
# a table and scores the same.
HELD_NODES = 2_000_000
EULER = 0.5772156649015329

_NODES = "tree int, node int, feature int, threshold double, left int, right int, size int, depth int"


def average_path(n):
    """Mean depth of an unsuccessful search in a binary tree of ``n`` leaves."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    usual = 2.0 * (np.log(safe - 1.0) + EULER) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, usual))


def _draws(seed: int, tree: int, node: int) -> tuple[float, float]:
    """Two numbers in [0, 1) that depend on the node alone (splitmix64), so a node is
    cut the same wherever it is grown."""
    mask, out = (1 << 64) - 1, []
    x = (seed * 0x9E3779B97F4A7C15 + tree * 0xD1342543DE82EF95 + node * 0x2545F4914F6CDD1D) & mask
    for _ in range(2):
        x = (x + 0x9E3779B97F4A7C15) & mask
        z = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        out.append(((z ^ (z >> 31)) >> 11) / (1 << 53))
    return out[0], out[1]


def _draws_of(seed: int, tree: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_draws`` of many nodes of a tree."""
    start = (seed * 0x9E3779B97F4A7C15 + tree * 0xD1342543DE82EF95) & ((1 << 64) - 1)
    x, out = nodes.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) + np.uint64(start), []
    for _ in range(2):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        z = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append(((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53))
    return out[0], out[1]


def pick_cut(features, low, high, seed: int, tree: int, node: int) -> tuple[int, float]:
    """A random one of ``features``, in ascending order and none constant, and a random
    value between its ``low`` and ``high``."""
    a, b = _draws(seed, tree, node)
    i = int(a * len(features))
    threshold = float(low[i]) + b * (float(high[i]) - float(low[i]))
    return int(features[i]), threshold if threshold < high[i] else float(low[i])


def depth_limit(size: int) -> int:
    return math.ceil(math.log2(max(size, 2)))


_NODE_FIELDS = ("node", "feature", "threshold", "size")


def _part(x: np.ndarray, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Some rows and columns of ``x``; whole rows are copied at once."""
    part = x.take(rows, axis=0)
    return part if len(places) == x.shape[1] else part.take(places, axis=1)


def _ranges(x: np.ndarray, rows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest number of each column of some rows, a few rows at a time."""
    low, high, step = np.full(len(places), np.inf), np.full(len(places), -np.inf), max(1, LEVEL_CELLS // x.shape[1])
    for at in range(0, len(rows), step):
        part = _part(x, rows[at : at + step], places)
        low, high = np.minimum(low, part.min(axis=0)), np.maximum(high, part.max(axis=0))
    return low, high


def _grow_levels(x: np.ndarray, columns: np.ndarray, seed: int, tree: int, limit: int, root: int):
    """As ``grow_tree``, all nodes of a level at once: the rows of a node lie together."""
    leaf = np.full(len(x), root, np.int64)
    rows, nodes, starts, found = np.arange(len(x)), np.array([root], np.int64), np.zeros(1, np.int64), []
    depth = root.bit_length() - 1
    while len(rows):
        sizes = np.diff(np.append(starts, len(rows)))
        if depth < limit and x.shape[1]:
            low, high = (f.reduceat(x, starts, axis=0) for f in (np.minimum, np.maximum))
            varied = (low < high) & (sizes > 1)[:, None]
        else:
            varied = np.zeros((len(nodes), 0), bool)
        n_varied = varied.sum(axis=1)
        cut = np.flatnonzero(n_varied)
        feature, threshold = np.full(len(nodes), -1, np.int64), np.zeros(len(nodes))
        place = np.zeros(len(nodes), np.int64)
        if len(cut):
            a, b = _draws_of(seed, tree, nodes[cut])
            chosen = (a * n_varied[cut]).astype(np.int64)
            place[cut] = (np.cumsum(varied[cut], axis=1) <= chosen[:, None]).sum(axis=1)
            least, most = low[cut, place[cut]], high[cut, place[cut]]
            at = least + b * (most - least)
            feature[cut], threshold[cut] = columns[place[cut]], np.where(at < most, at, least)
        found.append((nodes, feature, threshold, sizes))
        of = np.repeat(np.arange(len(nodes)), sizes)
        leaf[rows] = nodes[of]
        on = np.flatnonzero(feature[of] >= 0)
        of = of[on]
        below = 2 * of + (x[on, place[of]] > threshold[of])
        order = np.argsort(below, kind="stable")
        # What is constant in all nodes of a level is so in those below.
        some = np.flatnonzero(varied.any(axis=0))
        rows, below = rows[on[order]], below[order]
        x, columns = _part(x, on[order], some), columns[some]
        starts = np.flatnonzero(np.r_[True, below[1:] != below[:-1]]) if len(below) else np.zeros(0, np.int64)
        nodes = 2 * nodes[below[starts] >> 1] + (below[starts] & 1)
        depth += 1
    return found, leaf


def grow_tree(
    x: np.ndarray, columns: np.ndarray, seed: int, tree: int, limit: int, root: int = 1, rows: np.ndarray | None = None
) -> tuple[pd.DataFrame, np.ndarray]:
    """Nodes below and with ``root`` for its ``rows`` of ``x`` (all), whose columns are the features
    ``columns``: (node, feature, threshold, size), by node; and the leaf of every such row. Node n
    has the children 2n and 2n + 1. A node is cut at a random value of a random feature that
    is not constant in it, until it holds one row, all its rows are equal, or it is at depth
    ``limit``."""
    found: list[tuple] = []
    leaf = np.full(len(x), root, np.int64)
    todo = [(root, np.arange(len(x)) if rows is None else rows, np.arange(x.shape[1]))]
    while todo:
        node, rows, places = todo.pop()
        if len(rows) * len(places) <= LEVEL_CELLS:
            own = _part(x, rows, places).astype(np.float64, copy=False)
            nodes, own = _grow_levels(own, columns[places], seed, tree, limit, node)
            found += nodes
            leaf[rows] = own
            continue
        if len(rows) > 1 and node.bit_length() - 1 < limit:
            low, high = _ranges(x, rows, places)
            varied = np.flatnonzero(low < high)
            # What is constant in a node is constant in its children.
            places, low, high = places[varied], low[varied], high[varied]
        else:
            places = places[:0]
        if not len(places):
            found.append(([node], [-1], [0.0], [len(rows)]))
            leaf[rows] = node
            continue
        feature, threshold = pick_cut(columns[places], low, high, seed, tree, node)
        # In double precision, whatever the numbers have.
        goes_left = x[rows, np.searchsorted(columns, feature)] <= np.float64(threshold)
        found.append(([node], [feature], [threshold], [len(rows)]))
        todo.append((2 * node + 1, rows[~goes_left], places))
        todo.append((2 * node, rows[goes_left], places))
    out = pd.DataFrame(dict(zip(_NODE_FIELDS, (np.concatenate(v) for v in zip(*found)))))
    return out.sort_values("node", ignore_index=True), leaf


def _leaves(x: np.ndarray, columns: np.ndarray, nodes: pd.DataFrame, root: int) -> np.ndarray:
    """The leaf of every row of ``x`` in a grown tree."""
    node, feature, threshold = (nodes[c].to_numpy() for c in _NODE_FIELDS[:3])
    here, active = np.full(len(x), root, np.int64), np.arange(len(x))
    while len(active):
        at = np.searchsorted(node, here[active])
        inner = feature[at] >= 0
        active, at = active[inner], at[inner]
        right = x[active, np.searchsorted(columns, feature[at])] > threshold[at]
        here[active] = 2 * here[active] + right
    return here


@dataclass(frozen=True)
class Forest:
    """A grown forest. ``nodes`` has one row per node, at most twice the sample
    size per tree, sorted by tree and node."""

    nodes: np.ndarray
    sample: int
    dim: int
    offset: float = -0.5

    @property
    def n_trees(self) -> int:
        return int(self.nodes["tree"].max()) + 1

    def first(self, n_trees: int) -> Forest:
        return replace(self, nodes=self.nodes[self.nodes["tree"] < n_trees])

    def table(self, spark) -> DataFrame:
        nodes = spark.createDataFrame(pd.DataFrame(self.nodes), _NODES)
        return nodes.withColumns(
            {"sample": F.lit(self.sample), "dim": F.lit(self.dim), "offset": F.lit(self.offset)}
        )

    @classmethod
    def from_table(cls, table: DataFrame) -> Forest | TableForest:
        if "left" not in table.columns:
            return TableForest.from_table(table)
        pdf = table.toPandas()
        one = pdf.iloc[0]
        return cls(
            _node_array(pdf), int(one["sample"]), int(one["dim"]), float(one["offset"])
        )

    def score(self, features, n_trees: tuple[int, ...] | None = None) -> Column:
        """Negated anomaly score in (-1, 0), the lower the more abnormal. With
        ``n_trees``, an array of the scores of the first so many trees each."""
        wanted = n_trees or (self.n_trees,)
        reader = _PathReader(self.nodes, self.dim, self.sample)

        @F.pandas_udf("array<double>")
        def dense(x: pd.Series) -> pd.Series:
            return reader.scores(x, wanted)

        @F.pandas_udf("array<double>")
        def sparse(x: pd.DataFrame) -> pd.Series:
            return reader.scores(x, wanted)

        out = sparse(F.col(features.name)) if isinstance(features, SparseColumn) else dense(features)
        return out if n_trees else F.element_at(out, 1)


class _PathReader:
    """Walks rows down all trees of a forest, level by level."""

    def __init__(self, nodes: np.ndarray, dim: int, sample: int):
        self.dim, self.scale = dim, float(average_path(sample))
        starts = np.flatnonzero(np.r_[True, nodes["tree"][1:] != nodes["tree"][:-1]])
        base = np.repeat(starts, np.diff(np.r_[starts, len(nodes)]))
        self.root = starts
        inner = nodes["feature"] >= 0
        # Rows are only ever asked for the features that some node cuts.
        self.used = np.unique(nodes["feature"][inner])
        self.feature = np.where(inner, np.searchsorted(self.used, nodes["feature"]), -1)
        self.threshold = nodes["threshold"].copy()
        self.chunk = int(min(1024, max(16, (1 << 25) // max(1, len(self.used)))))
        self.left, self.right = nodes["left"] + base, nodes["right"] + base
        self.path = nodes["depth"] + average_path(nodes["size"])
        self.levels = int(nodes["depth"].max())

    def scores(self, x, wanted: tuple[int, ...]) -> pd.Series:
        x, place = distinct_rows(x)
        out = [np.zeros((0, len(wanted)))]
        for at in range(0, len(x), self.chunk):
            rows = dense_rows(x.iloc[at : at + self.chunk], self.dim, self.used)
            here = np.tile(self.root, (len(rows), 1))
            index = np.arange(len(rows))[:, None]
            for _ in range(self.levels):
                feature = self.feature[here]
                inner = feature >= 0
                if not inner.any():
                    break
                goes_left = rows[index, np.maximum(feature, 0)] <= self.threshold[here]
                here = np.where(inner, np.where(goes_left, self.left[here], self.right[here]), here)
            depth = np.cumsum(self.path[here], axis=1)
            scale = self.scale if self.scale > 0 else 1.0
            out.append(np.stack([-(2.0 ** (-depth[:, n - 1] / n / scale)) for n in wanted], axis=1))
        return pd.Series(np.concatenate(out)[place].tolist(), dtype=object)


def _node_array(pdf: pd.DataFrame) -> np.ndarray:
    names = ["tree", "node", "feature", "threshold", "left", "right", "size", "depth"]
    pdf = pdf[names].sort_values(["tree", "node"])
    return pdf.astype({n: "float64" if n == "threshold" else "int64" for n in names}).to_records(
        index=False
    ).view(np.recarray)


def sample_size(n_rows: int, max_samples: str | int | float) -> int:
    """Rows per tree: ``auto``, a number, or a share of the rows."""
    if max_samples == "auto":
        return min(AUTO_ROWS, n_rows)
    if isinstance(max_samples, float):
        return max(1, int(max_samples * n_rows))
    return min(max_samples, n_rows)


HASH = 1 << 40


def _hash(seed: int, salt: str, *columns) -> Column:
    """A number below 2^40 that depends on the values alone."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), *columns), F.lit(HASH))


def _pool(n_trees: int, size: int, n_rows: int) -> tuple[float, float]:
    """The share of all rows that is the pool, and the share of the pool offered to a tree."""
    share = min(1.0, (4.0 * n_trees * size + 1000) / max(n_rows, 1))
    pooled = share * n_rows
    return share, min(1.0, (size + 8.0 * math.sqrt(size) + 16.0) / max(pooled - 8 * math.sqrt(pooled), 1.0))


def tree_samples(
    df: DataFrame, row_id: str, n_trees: int, size: int, n_rows: int, seed: int, guests: bool = False
) -> DataFrame:
    """``tree`` beside the columns of ``df``: a random sample of ``size`` rows per
    tree, those of lowest hash. The samples do not depend on partitioning. With ``guests``
    all rows of ``df`` for each tree, and ``_in``, whether they are of its sample.

    One hash per row draws a pool some times larger than all samples together, and
    only pool rows are offered to the trees; so what is shuffled depends on the forest,
    not on the table. Rows per 1/1024 of the hash range are counted, on the map side; a tree takes the
    ranges that it can take whole and ranks the rows of its last one only."""
    trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
    if size >= n_rows:
        every = df.withColumn("tree", F.explode(trees))
        return every.withColumn("_in", F.lit(True)) if guests else every
    share, offer = _pool(n_trees, size, n_rows)
    in_pool = F.lit(True) if share == 1.0 else _hash(seed, "pool", F.col(row_id)) < share * HASH
    draw = lambda t: _hash(seed, "tree", F.col(row_id), t)
    drawn = {"_draw": draw(F.col("tree")), "_range": F.shiftright(draw(F.col("tree")), 30)}
    if guests:
        every = df.withColumn("tree", F.explode(trees)).withColumns(drawn)
        every = every.withColumn("_in", in_pool & (F.col("_draw") < offer * HASH))
        offered = every.filter("_in")
    else:
        every = offered = df.filter(in_pool).withColumn(
            "tree", F.explode(F.filter(trees, lambda t: draw(t) < offer * HASH))
        ).withColumns({**drawn, "_in": F.lit(True)})
    so_far = Window.partitionBy("tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        offered.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(so_far) - F.col("_n"))
        .filter(F.col("_before") < size)
        .groupBy("tree").agg(F.max_by(F.struct("_range", "_before"), "_range").alias("_last"))
    )
    # One row per tree.
    placed = every.join(F.broadcast(last), "tree")
    at_last = F.col("_in") & (F.col("_range") == F.col("_last._range"))
    whole = placed.filter(~at_last).withColumn("_in", F.col("_in") & (F.col("_range") < F.col("_last._range")))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("_draw", row_id))
    edge = placed.filter(at_last).withColumn("_in", rank <= size - F.col("_last._before"))
    found = whole.unionByName(edge)
    return found.select(*df.columns, "tree", "_in") if guests else found.filter("_in").select(*df.columns, "tree")


_GROWN = "tree int, node bigint, feature int, threshold double, size bigint"


def _grow_small(rows: DataFrame, row_id: str, features: str, dim: int, seed: int, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """All nodes below those of ``rows``, a task per node of ``rows``; where these have
    guests, also ``row_id, tree, path`` of all rows: the length of the row's path."""
    is_struct = rows.schema[features].dataType.typeName() == "struct"
    guests = "_in" in rows.columns

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, root = int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0])
        batch = pd.DataFrame(pdf[features].tolist()) if is_struct else pdf[features].reset_index(drop=True)
        own = pdf["_in"].to_numpy(bool) if guests else np.ones(len(pdf), bool)
        used = used_columns(batch[own], dim)
        nodes, leaf = grow_tree(dense_rows(batch[own], dim, used), used, seed, tree, limit, root)
        if not guests:
            nodes.insert(0, "tree", tree)
            return nodes
        ends = np.empty(len(pdf), np.int64)
        ends[own] = leaf
        ends[~own] = _leaves(dense_rows(batch[~own], dim, used), used, nodes, root)
        at = np.searchsorted(nodes["node"].to_numpy(), ends)
        path = np.frexp(ends.astype(float))[1] - 1 + average_path(nodes["size"].to_numpy()[at])
        cells = [tree, *[nodes[c].to_numpy() for c in _NODE_FIELDS], pdf[row_id].to_numpy(), path]
        return pd.DataFrame([cells], columns=["tree", *_NODE_FIELDS, row_id, "path"])

    parts = rows.groupBy("tree", "node")
    if not guests:
        return parts.applyInPandas(grow, _GROWN), None
    id_kind = rows.schema[row_id].dataType.simpleString()
    kinds = f"tree int, node array<bigint>, feature array<int>, threshold array<double>, size array<bigint>, {row_id} array<{id_kind}>, path array<double>"
    grown = settle(parts.applyInPandas(grow, kinds), "forest-grown")
    nodes = grown.select("tree", F.inline(F.arrays_zip(*_NODE_FIELDS)))
    return nodes, grown.select("tree", F.inline(F.arrays_zip(row_id, "path"))).select(row_id, "tree", "path")


def _cut_large(rows: DataFrame, sizes: DataFrame, features: str, seed: int) -> DataFrame:
    """One cut per node of ``sizes``: ``tree, node, feature, threshold, size``; no row
    for a node without a feature that varies. Ranges are combined on the map side."""
    if rows.schema[features].dataType.typeName() == "struct":
        pairs = F.explode(F.arrays_zip(f"{features}.indices", f"{features}.values")).alias("p")
        entries = rows.select("tree", "node", pairs).select(
            "tree", "node", F.col("p.indices").alias("feature"), F.col("p.values").alias("x")
        )
    else:
        entries = rows.select("tree", "node", F.posexplode(features).alias("feature", "x"))
    x = F.col("x").cast("double")
    ranges = entries.groupBy("tree", "node", "feature").agg(
        F.min(x).alias("low"), F.max(x).alias("high"), F.count(F.lit(1)).alias("n")
    )
    # A row that does not list a feature has 0 there.
    lists_all = F.col("n") == F.col("size")
    ranges = ranges.join(sizes, ["tree", "node"]).withColumns({
        "low": F.when(lists_all, F.col("low")).otherwise(F.least("low", F.lit(0.0))),
        "high": F.when(lists_all, F.col("high")).otherwise(F.greatest("high", F.lit(0.0))),
    })

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("feature")
        tree, node, size = (int(pdf[c].iloc[0]) for c in ("tree", "node", "size"))
        chosen = pick_cut(*(pdf[c].to_numpy() for c in ("feature", "low", "high")), seed, tree, node)
        return pd.DataFrame([(tree, node, *chosen, size)], columns=["tree", "node", "feature", "threshold", "size"])

    return ranges.filter("low < high").groupBy("tree", "node").applyInPandas(cut, _GROWN)


def _value_at(df: DataFrame, features: str) -> Column:
    if df.schema[features].dataType.typeName() != "struct":
        return F.get(features, F.col("feature")).cast("double")
    at = F.array_position(f"{features}.indices", F.col("feature")) - 1
    return F.when(at < 0, 0.0).otherwise(F.get(F.col(f"{features}.values"), at.cast("int")))


def grow_nodes(
    samples: DataFrame, row_id: str, features: str, dim: int, seed: int, size: int, node_rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """All nodes of all trees; where ``samples`` has guests, also the paths of all rows. While some node holds more than ``node_rows`` rows, one
    level of such nodes is cut: an aggregate finds the range of every feature in every
    node, and each row goes to the side of its node. Smaller nodes go to a task each."""
    limit = depth_limit(size)
    rows, done, ended = samples.withColumn("node", F.lit(1).cast("bigint")), [], []
    guests = "_in" in rows.columns
    if size > node_rows:
        rows = settle(rows, "forest-rows")
        for level in range(limit + 1):
            counted = rows.filter("_in") if guests else rows
            sizes = settle(counted.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("size")), "forest-sizes")
            large = sizes.filter(F.col("size") > node_rows)
            if large.isEmpty():
                break
            in_large = lookup_join(counted, large.select("tree", "node"), ["tree", "node"], "left_semi", [row_id])
            cuts = settle(_cut_large(in_large, large, features, seed).filter(F.lit(level < limit)), "forest-cuts")
            # At full depth, or without a feature that varies, a large node is a leaf.
            flat = large.join(cuts, ["tree", "node"], "left_anti")
            done += [cuts, flat.select("tree", "node", F.lit(-1).alias("feature"), F.lit(0.0).alias("threshold"), "size")]
            if guests:
                n = F.col("size")
                path = F.lit(level) + F.when(n == 2, 1.0).otherwise(2 * (F.ln(n - 1) + EULER) - 2 * (n - 1) / n)
                stay = lookup_join(rows, flat.select("tree", "node", "size"), ["tree", "node"], "inner", [row_id])
                ended.append(stay.select(row_id, "tree", path.alias("path")))
            placed = lookup_join(rows, cuts.drop("size"), ["tree", "node"], "left", [row_id])
            placed = lookup_join(placed, flat.select("tree", "node"), ["tree", "node"], "left_anti", [row_id])
            side = F.when(_value_at(rows, features) <= F.col("threshold"), 0).otherwise(1)
            node = F.when(F.col("feature").isNull(), F.col("node")).otherwise(F.col("node") * 2 + side)
            rows = settle(placed.withColumn("node", node).select(*rows.columns), "forest-rows")
    nodes, paths = _grow_small(rows, row_id, features, dim, seed, limit)
    nodes = functools.reduce(DataFrame.unionByName, [*done, nodes])
    return nodes, functools.reduce(DataFrame.unionByName, [*ended, paths]) if guests else None


def _rows_of_a_task(df: DataFrame, features: str, dim: int) -> int:
    is_struct = df.schema[features].dataType.typeName() == "struct"
    return NODE_ROWS if is_struct else max(NODE_ROWS, NODE_CELLS // max(dim, 1))


def grow_forest(
    df: DataFrame,
    dim: int,
    row_id: str,
    features: str = "features",
    n_trees: int = 100,
    max_samples: str | int | float = "auto",
    seed: int = FOREST_SEED,
    n_rows: int | None = None,
    node_rows: int | None = None,
    held_nodes: int | None = None,
) -> Forest | TableForest:
    """Grow all trees side by side. ``row_id`` is unique. A forest of at most
    ``held_nodes`` nodes is held whole; a larger one, as trees over a share of a large
    table make it, stays a table."""
    n_rows = df.count() if n_rows is None else n_rows
    size = sample_size(n_rows, max_samples)
    if node_rows is None and _needs_most_rows(n_trees, size, n_rows) and fits_a_task(df, features, dim, n_rows):
        nodes = whole_trees(df, dim, row_id, features, n_trees, size, seed, n_rows).nodes(n_trees)
    else:
        samples = tree_samples(df.select(row_id, features), row_id, n_trees, size, n_rows, seed)
        node_rows = _rows_of_a_task(df, features, dim) if node_rows is None else node_rows
        nodes = grow_nodes(samples, row_id, features, dim, seed, size, node_rows)[0]
    nodes = settle(nodes, "forest-nodes")
    if nodes.count() > (HELD_NODES if held_nodes is None else held_nodes):
        return TableForest(nodes, n_trees, size, dim)
    return Forest(_linked(nodes.toPandas()), size, dim)


def _needs_most_rows(n_trees: int, size: int, n_rows: int) -> bool:
    """Whether large trees draw half of the rows or more."""
    return n_trees * (2 * size - 1) > HELD_NODES and 2 * size >= n_rows


def whole_trees(df: DataFrame, dim: int, row_id: str, features: str, n_trees: int, size: int, seed: int, n_rows: int) -> WholeTrees:
    """What grows trees over the rows of ``df`` that draw half of them or more, so that all
    rows are in the pool."""
    offer = _pool(n_trees, size, n_rows)[1]
    return WholeTrees(packed_rows(df, row_id, features, seed), n_rows, dim, number_kind(df, features), size, offer, seed)


def _held_if_small(forest: Forest | TableForest) -> Forest | TableForest:
    """The forest held whole, if its nodes are known to be few and are not made yet."""
    if isinstance(forest, TableForest) and forest.fresh and forest.n_nodes <= HELD_NODES:
        return Forest(_linked(forest.nodes.toPandas()), forest.sample, forest.dim, forest.offset)
    return forest


def _linked(grown: pd.DataFrame) -> np.ndarray:
    """Nodes 1, 2n, 2n + 1 numbered 0, 1, ... per tree, with their children and depth."""
    grown = grown.sort_values(["tree", "node"], ignore_index=True)
    number = grown.groupby("tree").cumcount()
    at = pd.Series(number.to_numpy(), index=pd.MultiIndex.from_frame(grown[["tree", "node"]]))
    inner = grown["feature"].to_numpy() >= 0
    children = [
        np.where(inner, at.reindex(pd.MultiIndex.from_arrays([grown["tree"], grown["node"] * 2 + side])).to_numpy(), -1)
        for side in (0, 1)
    ]
    depth = np.frexp(grown["node"].to_numpy().astype(np.float64))[1] - 1
    return _node_array(
        grown.assign(node=number, left=children[0], right=children[1], depth=depth)
    )


def with_scores(df: DataFrame, forest: Forest | TableForest, features: str = "features") -> DataFrame:
    if isinstance(forest, Forest):
        return df.withColumn("score", forest.score(feature_column(df, features)))
    # Written first: the number of a row must be the same wherever it is read.
    rows = settle(df.withColumn("_row", F.monotonically_increasing_id()), "forest-input")
    scores = path_sums(rows, forest, "_row", features, (forest.n_trees,)).withColumnRenamed("s0", "score")
    return rows.join(scores, "_row").select(*df.columns, "score")


def trial_scores(df: DataFrame, forest: Forest | TableForest, row_id: str, features: str, counts: tuple[int, ...]) -> DataFrame:
    """``s0, s1, ...``: the scores of all rows under the first ``counts`` trees each."""
    if isinstance(forest, TableForest):
        return path_sums(df, forest, row_id, features, counts).drop(row_id)
    scores = df.select(forest.score(feature_column(df, features), counts).alias("_s"))
    return scores.select(*[F.col("_s")[i].alias(f"s{i}") for i in range(len(counts))])


def grow_and_score(
    df: DataFrame, dim: int, row_id: str, features: str, counts: tuple[int, ...], max_samples: str | int | float,
    seed: int, n_rows: int, node_rows: int | None = None,
) -> tuple[Forest | TableForest, DataFrame]:
    """A forest of as many trees as the largest of ``counts``, and the ``trial_scores`` of the
    rows it was grown from. Nodes of trees that are grown whole are made when they are asked
    for: what tries many settings needs those of one.

    Trees over most rows of a large table meet nearly every row while they grow: each is grown
    in one task that holds all rows (``iforest_whole``). Of a table too large for that the
    rows that a tree has not drawn come along as guests: they count for no cut, but end in a
    leaf with the others, so rows move to the trees once and not again to be scored."""
    n_trees, size = max(counts), sample_size(n_rows, max_samples)
    if not _needs_most_rows(n_trees, size, n_rows):
        forest = grow_forest(df, dim, row_id, features, n_trees, max_samples, seed, n_rows, node_rows or _rows_of_a_task(df, features, dim))
        return forest, trial_scores(df, forest, row_id, features, counts)
    if node_rows is None and fits_a_task(df, features, dim, n_rows):
        trees = whole_trees(df, dim, row_id, features, n_trees, size, seed, n_rows)
        n_nodes, scores = trees.scores(counts, float(average_path(size)) or 1.0)
        return TableForest(trees.nodes(n_trees), n_trees, size, dim, fresh=trees.nodes, n_nodes=n_nodes), scores
    samples = tree_samples(df.select(row_id, features), row_id, n_trees, size, n_rows, seed, guests=True)
    nodes, paths = grow_nodes(samples, row_id, features, dim, seed, size, node_rows or _rows_of_a_task(df, features, dim))
    if nodes.count() <= HELD_NODES:
        forest = Forest(_linked(nodes.toPandas()), size, dim)
    else:
        forest = TableForest(nodes, n_trees, size, dim)
    return forest, score_sums(paths, forest, row_id, counts).drop(row_id)


def fit_offset(scored: DataFrame, contamination: float, score: str = "score") -> float:
    """The score below which the ``contamination`` share of the training rows lies."""
    return exact_quantiles(scored, score, [contamination])[0]


def fit_forest(
    df: DataFrame,
    dim: int,
    row_id: str,
    features: str = "features",
    n_trees: int = 100,
    contamination: float | None = None,
    max_samples: str | int | float = "auto",
    seed: int = FOREST_SEED,
) -> Forest | TableForest:
    forest = grow_forest(df, dim, row_id, features, n_trees, max_samples, seed)
    if contamination is None:
        return forest
    scored = with_scores(df.select(row_id, features), forest, features)
    return replace(forest, offset=fit_offset(scored, contamination))


def decide(df: DataFrame, forest: Forest | TableForest, features: str = "features") -> DataFrame:
    """Add ``anomaly_score``, the score above the offset (negative for abnormal
    rows), and ``is_anomaly``."""
    return (
        with_scores(df, forest, features)
        .withColumn("anomaly_score", F.col("score") - F.lit(forest.offset))
        .withColumn("is_anomaly", F.col("anomaly_score") < 0)
        .drop("score")
    )


def keep_windows(decided: DataFrame, keep: str = "all") -> DataFrame:
    if keep == "all":
        return decided
    if keep == "normal":
        return decided.filter(~F.col("is_anomaly"))
    if keep == "anomaly":
        return decided.filter("is_anomaly")
    raise ValueError(f"keep must be all, normal or anomaly, not {keep!r}")


def mean_anomaly(decided: DataFrame) -> DataFrame:
    return decided.agg(F.avg(-F.col("anomaly_score")).alias("mean_score"))


def trial_params(n_trials: int = FOREST_TRIALS, seed: int = FOREST_SEED) -> list[dict]:
    rng = np.random.default_rng(seed)
    return [
        {
            "run_no": i,
            "n_trees": int(rng.integers(FOREST_TREES[0], FOREST_TREES[1] + 1)),
            "contamination": float(rng.uniform(*FOREST_CONTAMINATION)),
            "max_samples": FOREST_SAMPLES[int(rng.integers(len(FOREST_SAMPLES)))],
        }
        for i in range(n_trials)
    ]


FOREST_SPACE = {
    "n_trees": Number(*FOREST_TREES, whole=True),
    "contamination": Number(*FOREST_CONTAMINATION),
    "max_samples": Choice(FOREST_SAMPLES),
}


def study_forest(
    df: DataFrame,
    dim: int,
    row_id: str,
    objective: Callable[[DataFrame], float] | None = None,
    features: str = "features",
    n_trials: int = FOREST_TRIALS,
    seed: int = FOREST_SEED,
    space: Space | None = None,
) -> tuple[Forest | TableForest, DataFrame]:
    """The forest of the highest ``objective`` of the decided rows (``anomaly_score`` and
    ``is_anomaly`` beside the columns of ``df``; by default the mean anomaly score), and
    the table of trials. Settings are chosen by the trials before; trees of one sample
    size are grown once, as many as the space allows, and a trial takes the first."""
    space = FOREST_SPACE if space is None else space
    data = settle(df, "forest-study")
    n_rows, grown = data.count(), {}
    most = space["n_trees"].high

    def fitted(t: dict) -> Forest | TableForest:
        samples = t["max_samples"]
        if samples not in grown:
            grown[samples] = grow_forest(data, dim, row_id, features, int(most), samples, seed, n_rows)
        forest = grown[samples].first(t["n_trees"])
        return replace(forest, offset=fit_offset(with_scores(data.select(row_id, features), forest, features), t["contamination"]))

    def value(t: dict) -> float:
        decided = decide(data, fitted(t), features)
        return mean_anomaly(decided).first()[0] if objective is None else objective(decided)

    trials = study(value, space, n_trials, seed)
    table = trial_table(df.sparkSession, [({**t, "max_samples": str(t["max_samples"])}, v) for t, v in trials],
                        "n_trees int, contamination double, max_samples string")
    chosen = trials[best_run(table, "run_no", "score").first()["run_no"]][0]
    return fitted(chosen), table


def search_forest(
    df: DataFrame,
    dim: int,
    row_id: str,
    features: str = "features",
    n_trials: int = FOREST_TRIALS,
    seed: int = FOREST_SEED,
    trials: list[dict] | None = None,
) -> tuple[Forest | TableForest, DataFrame]:
    """Try ``n_trials`` random settings and keep the one with the highest mean
    anomaly score. Returns the forest and the table of trials.

    Trials with the same sample size share trees: a trial of T trees uses the
    first T of one larger forest. So there is one growing job per sample size and
    one pass over the rows that scores all trials of it."""
    spark = df.sparkSession
    trials = trials if trials is not None else trial_params(n_trials, seed)
    data = df.select(row_id, features).persist()
    try:
        n_rows = data.count()
        rows, forests = [], {}
        for samples in dict.fromkeys(t["max_samples"] for t in trials):
            group = [t for t in trials if t["max_samples"] == samples]
            counts = tuple(t["n_trees"] for t in group)
            forest, scores = grow_and_score(data, dim, row_id, features, counts, samples, seed, n_rows)
            forests[samples] = forest
            scored = settle(scores, "trial-scores")
            means = scored.agg(*[F.avg(f"s{i}").alias(f"s{i}") for i in range(len(group))]).first()
            offsets = side_by_side(
                [
                    lambda i=i, t=t: fit_offset(scored, t["contamination"], f"s{i}")
                    for i, t in enumerate(group)
                ]
            )
            for i, (t, offset) in enumerate(zip(group, offsets)):
                rows.append(
                    (
                        t["run_no"], t["n_trees"], t["contamination"], str(samples),
                        forest.sample, offset, float(offset - means[f"s{i}"]),
                    )
                )
    finally:
        data.unpersist()
    table = spark.createDataFrame(
        rows,
        "run_no int, n_trees int, contamination double, max_samples string, "
        "sample_rows int, offset double, mean_score double",
    )
    win = best_run(table, "run_no", "mean_score", ("n_trees", "max_samples", "offset")).first()
    chosen = next(t for t in trials if t["run_no"] == win["run_no"])
    best = forests[chosen["max_samples"]].first(chosen["n_trees"])
    return _held_if_small(replace(best, offset=win["offset"])), table
