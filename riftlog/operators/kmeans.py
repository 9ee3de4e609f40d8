"""K-means on feature vectors: fitting, assigning, judging."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame, functions as F

from riftlog.config import DISTANCE_THRESHOLD, KMEANS_SEEDS, N_CLUSTERS
from riftlog.functions.vectors import dense_rows, distinct_rows, squared_distance
from riftlog.operators.lookups import lookup_join
from riftlog.operators.runs import best_run
from riftlog.session import side_by_side

# Blocks that the exact silhouette deals its vectors into, and so copies of each.
PAIR_BLOCKS = 24


@dataclass(frozen=True)
class Centroids:
    """Cluster centres as a (clusters, dim) matrix; the number of clusters is
    chosen by the user, so it is small."""

    centers: np.ndarray
    labels: tuple[int, ...]

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(int(k), [float(x) for x in c]) for k, c in zip(self.labels, self.centers)],
            "cluster int, center array<double>",
        )

    @classmethod
    def from_table(cls, table: DataFrame, cluster: str = "cluster", center: str = "center"):
        rows = table.select(cluster, center).orderBy(cluster).collect()
        return cls(np.array([r[1] for r in rows], dtype=float), tuple(int(r[0]) for r in rows))

    def assign(self, features: Column) -> Column:
        """Struct of the nearest ``cluster`` and the ``distance`` to its centre;
        ties go to the lowest cluster. One Arrow batch at a time."""
        centers, labels = self.centers, np.array(self.labels, dtype=np.int32)

        @F.pandas_udf("cluster int, distance double")
        def nearest(x: pd.Series) -> pd.DataFrame:
            return _nearest(x, centers, labels)

        @F.pandas_udf("cluster int, distance double")
        def nearest_sparse(x: pd.DataFrame) -> pd.DataFrame:
            return _nearest(x, centers, labels)

        return _pick(features, nearest, nearest_sparse)


def _nearest(x, centers, labels) -> pd.DataFrame:
    out = []
    x, place = distinct_rows(x)
    for at in range(0, len(x), 2048):
        rows = dense_rows(x.iloc[at : at + 2048], centers.shape[1])
        d2 = np.stack([((rows - c) ** 2).sum(axis=1) for c in centers], axis=1)
        best = d2.argmin(axis=1)
        out.append(
            pd.DataFrame(
                {"cluster": labels[best], "distance": np.sqrt(d2[np.arange(len(best)), best])}
            )
        )
    if not out:
        return pd.DataFrame({"cluster": [], "distance": []})
    return pd.concat(out, ignore_index=True).iloc[place].reset_index(drop=True)


class SparseColumn:
    """Marks a feature column that is a struct of indices and values."""

    def __init__(self, name: str):
        self.name = name


def _pick(features, dense, sparse) -> Column:
    if isinstance(features, SparseColumn):
        return sparse(F.col(features.name))
    return dense(features)


def feature_column(df: DataFrame, name: str):
    return SparseColumn(name) if df.schema[name].dataType.typeName() == "struct" else F.col(name)


def assign_clusters(df: DataFrame, model: Centroids, features: str = "features") -> DataFrame:
    """Add ``cluster`` and ``distance``."""
    return (
        df.withColumn("_near", model.assign(feature_column(df, features)))
        .withColumns({"cluster": F.col("_near.cluster"), "distance": F.col("_near.distance")})
        .drop("_near")
    )


def flag_far(df: DataFrame, threshold: float = DISTANCE_THRESHOLD) -> DataFrame:
    """The distance to the own centre is the anomaly score; beyond the threshold
    a row is an anomaly."""
    return df.withColumnRenamed("distance", "anomaly_score").withColumn(
        "is_anomaly", F.col("anomaly_score") > threshold
    )


def own_center_distance(df: DataFrame, centroids: DataFrame, features: str, cluster: str = "cluster"):
    """Distance to a given cluster's centre, by a lookup of the centre table.
    ``centroids`` is ``cluster, center`` with one row per cluster."""
    return lookup_join(df, centroids, [cluster], "left").withColumn(
        "distance", F.sqrt(squared_distance(F.col(features), F.col("center")))
    )


def label_means(df: DataFrame, features: str, label: str) -> DataFrame:
    """``cluster, center``: the mean vector of each label. Averages are combined
    per label and place before the shuffle, so a label's rows never meet."""
    return (
        df.select(F.col(label).alias("cluster"), F.posexplode(features).alias("at", "x"))
        .groupBy("cluster", "at")
        .agg(F.avg(F.col("x").cast("double")).alias("m"))
        .groupBy("cluster")
        .agg(F.array_sort(F.collect_list(F.struct("at", "m")))["m"].alias("center"))
    )


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))


def inertia(df: DataFrame, distance: str = "distance") -> DataFrame:
    return df.agg(F.sum(F.col(distance) * F.col(distance)).alias("inertia"))


def fit_kmeans(df: DataFrame, vector: str = "vector", k: int = N_CLUSTERS, seed: int = 42) -> Centroids:
    model = KMeans(k=k, seed=seed, featuresCol=vector, predictionCol="_cluster").fit(df)
    centers = np.array(model.clusterCenters())
    return Centroids(centers, tuple(range(len(centers))))


def fit_best_kmeans(
    df: DataFrame, vector: str = "vector", k: int = N_CLUSTERS, seeds=KMEANS_SEEDS
) -> tuple[Centroids, DataFrame]:
    """Fit once per seed and keep the fit with the best silhouette (linear form;
    the first of equals). Also returns the table of runs."""
    spark = df.sparkSession
    data = df.select(vector).persist()
    judge = ClusteringEvaluator(featuresCol=vector, predictionCol="_cluster")

    def attempt(seed: int):
        model = KMeans(k=k, seed=seed, featuresCol=vector, predictionCol="_cluster").fit(data)
        centers = np.array(model.clusterCenters())
        score = judge.evaluate(model.transform(data)) if len(centers) > 1 else 0.0
        return Centroids(centers, tuple(range(len(centers)))), score, model.summary.trainingCost

    try:
        data.count()
        fits = side_by_side([lambda s=seed: attempt(s) for seed in seeds])
    finally:
        data.unpersist()
    runs = [
        (i, int(seed), float(score), float(cost))
        for i, (seed, (_, score, cost)) in enumerate(zip(seeds, fits))
    ]
    table = spark.createDataFrame(runs, "run_no int, seed int, score double, inertia double")
    winner = best_run(table, "run_no", "score").first()["run_no"]
    return fits[winner][0], table


def silhouette_squared(df: DataFrame, features: str, cluster: str) -> DataFrame:
    """Mean silhouette with squared Euclidean distance, ``silhouette`` as one row.

    The mean squared distance of a row to a cluster follows from the cluster's
    size, mean vector and mean squared length, so the cost is linear. The cluster
    table has one row per cluster."""
    squared = F.aggregate(
        F.transform(features, lambda x: x.cast("double") * x.cast("double")),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    rows = df.select(F.col(cluster).alias("cluster"), F.col(features).alias("x"), squared.alias("xx"))
    stats = (
        rows.groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("xx").alias("mean_xx"))
        .join(label_means(rows, "x", "cluster"), "cluster")
    )
    clusters = stats.agg(
        F.collect_list(F.struct("cluster", "n", "mean_xx", "center"))
    ).scalar()
    dot = lambda a, b: F.aggregate(
        F.zip_with(a, b, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda total, z: total + z
    )
    to_each = F.transform(
        F.col("clusters"),
        lambda c: F.struct(
            c["cluster"].alias("cluster"),
            c["n"].alias("n"),
            (F.col("xx") - 2 * dot(F.col("x"), c["center"]) + c["mean_xx"]).alias("d"),
        ),
    )
    measured = rows.withColumn("clusters", clusters).select(
        "cluster", to_each.alias("to_each"), F.lit(1).alias("w")
    )
    return _silhouette_of(measured)


def _silhouette_of(measured: DataFrame) -> DataFrame:
    """From each row's mean distance to every cluster, with itself counted in its
    own cluster, to the mean silhouette over rows of weight ``w``. A row alone in its cluster has 0."""
    own = F.get(F.filter("to_each", lambda c: c["cluster"] == F.col("cluster")), F.lit(0))
    others = F.array_min(
        F.transform(
            F.filter("to_each", lambda c: c["cluster"] != F.col("cluster")), lambda c: c["d"]
        )
    )
    return (
        measured.select("w", own.alias("own"), others.alias("b"))
        .select(
            "w",
            F.col("own.n").alias("n"),
            (F.col("own.d") * F.col("own.n") / F.nullif(F.col("own.n") - 1, F.lit(0))).alias("a"),
            "b",
        )
        .select(
            "w",
            F.when(F.col("n") == 1, F.lit(0.0))
            .otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
            .alias("s")
        )
        .agg((F.sum(F.col("s") * F.col("w")) / F.sum("w")).alias("silhouette"))
    )


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Plain distances of all rows of ``x`` to all of ``y``. Rows that are so near that the
    product of matrices has lost their digits are subtracted place by place."""
    xx, yy = (x * x).sum(axis=1)[:, None], (y * y).sum(axis=1)[None, :]
    squared = x @ y.T
    squared *= -2
    squared += xx
    squared += yy
    near = np.nonzero(~(squared > 1e-6 * (xx + yy)))
    for at in range(0, len(near[0]), 4096):
        a, b = (k[at : at + 4096] for k in near)
        squared[a, b] = ((x[a] - y[b]) ** 2).sum(axis=1)
    return np.sqrt(squared, out=squared)


def silhouette_exact(
    df: DataFrame, features: str, cluster: str, block_rows: int = 2048
) -> DataFrame:
    """Mean silhouette with plain Euclidean distance, ``silhouette`` as one row.

    This measure has no short cut: the work grows with the square of the distinct
    vectors, so use it for tables of some 100,000 distinct rows and
    ``silhouette_squared`` beyond. Equal vectors are counted once with a weight.
    The vectors are dealt into at most ``PAIR_BLOCKS`` blocks, so that is how often one is
    copied; blocks meet pairwise, each pair in a task of its own that compares
    ``block_rows`` vectors of both at a time by one product of matrices, and gives back
    one row per vector and cluster, never one per pair."""
    points = (
        df.select(F.col(features).alias("x"), F.col(cluster).alias("cluster"))
        .groupBy("x", "cluster")
        .agg(F.count(F.lit(1)).alias("w"))
        .withColumn("id", F.xxhash64("x", "cluster"))
        .persist()
    )
    blocks = min(PAIR_BLOCKS, max(1, -(-points.count() // block_rows)))
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    mine = F.pmod("id", F.lit(blocks)).cast("int")
    left = points.select("id", "x", mine.alias("a"), each.alias("b"))
    right = points.select("x", "cluster", "w", mine.alias("b"), each.alias("a"))

    def meet(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(p) or not len(q):
            return pd.DataFrame({"id": [], "to": [], "d": []})
        px, qx = (np.vstack(t["x"].to_numpy()).astype(float) for t in (p, q))
        weight, codes = q["w"].to_numpy(dtype=float), q["cluster"].to_numpy()
        names, index = np.unique(codes, return_inverse=True)
        onto = np.zeros((len(q), len(names)))
        onto[np.arange(len(q)), index] = weight
        sums = np.zeros((len(p), len(names)))
        for i in range(0, len(p), block_rows):
            for j in range(0, len(q), block_rows):
                sums[i : i + block_rows] += distances(px[i : i + block_rows], qx[j : j + block_rows]) @ onto[j : j + block_rows]
        return pd.DataFrame(
            {
                "id": np.repeat(p["id"].to_numpy(), len(names)),
                "to": np.tile(names, len(p)),
                "d": sums.ravel(),
            }
        )

    sums = (
        left.groupBy("a", "b")
        .cogroup(right.groupBy("a", "b"))
        .applyInPandas(meet, "id bigint, to int, d double")
        .groupBy("id", "to")
        .agg(F.sum("d").alias("d"))
    )
    sizes = points.groupBy("cluster").agg(F.sum("w").alias("n"))
    sizes_map = sizes.agg(F.map_from_entries(F.collect_list(F.struct("cluster", "n")))).scalar()
    to_each = F.collect_list(
        F.struct(F.col("to").alias("cluster"), F.col("n"), (F.col("d") / F.col("n")).alias("d"))
    )
    measured = (
        sums.withColumn("_sizes", sizes_map)
        .withColumn("n", F.element_at("_sizes", F.col("to")))
        .groupBy("id")
        .agg(to_each.alias("to_each"))
        .join(points.select("id", "cluster", "w"), "id")
    )
    return _silhouette_of(measured)
