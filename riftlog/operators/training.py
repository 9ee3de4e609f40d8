"""Training jobs: from the words of sessions to a model and its run log."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from riftlog.config import (
    BATCH_SIZE, EPOCHS, KMEANS_SEEDS, LATENT_DIM, LATENT_SEED, MAX_FEATURES, N_CLUSTERS,
)
from riftlog.operators.autoencoder import fit_autoencoder, with_latent
from riftlog.operators.features import split_tail
from riftlog.operators.iforest import search_forest
from riftlog.operators.kmeans import assign_clusters, cluster_sizes, fit_best_kmeans, fit_kmeans
from riftlog.operators.positions import with_positions
from riftlog.operators.runs import run_rows
from riftlog.operators.scoring import EncoderModel, ForestModel, KMeansModel
from riftlog.operators.session_terms import SessionTerms, TermTable, sequence_terms, with_vectors
from riftlog.session import settle


def numbered_sequences(sequences: DataFrame) -> DataFrame:
    """Sequences in the order of their session, as ``row_no, sequence``."""
    kept = sequences.filter(F.col("sequence").isNotNull() & (F.col("sequence") != ""))
    ordered = settle(
        kept.sort("session_id", "piece").withColumn("_id", F.monotonically_increasing_id()),
        "ordered",
    )
    return with_positions(ordered, "_id", name="row_no").select("row_no", "sequence")


def training_terms(given: SessionTerms | DataFrame) -> SessionTerms:
    """What the trainings learn from: the words of sessions, or sequences of text."""
    return given if isinstance(given, SessionTerms) else sequence_terms(given)


def _cluster_metrics(assigned: DataFrame) -> dict[str, int]:
    """Rows per cluster, one entry per cluster."""
    return {f"cluster_{r['cluster']}_count": r["n"] for r in cluster_sizes(assigned).collect()}


def train_kmeans(
    sessions: SessionTerms | DataFrame, run_id: str = "kmeans", k: int = N_CLUSTERS, seeds=KMEANS_SEEDS,
    max_features: int = MAX_FEATURES,
) -> tuple[KMeansModel, DataFrame]:
    rows = training_terms(sessions)
    tfidf = rows.fit(max_features)
    data = with_vectors(rows.features(tfidf), tfidf.dim)
    centroids, trials = fit_best_kmeans(data, "vector", k, seeds)
    best = trials.orderBy(F.desc("score"), "run_no").first()
    log = run_rows(
        rows.terms.sparkSession,
        run_id,
        {"n_clusters": k, "max_features": max_features, "best_epoch": best["run_no"] + 1},
        {"best_silhouette_score": best["score"], **_cluster_metrics(assign_clusters(data, centroids))},
    )
    return KMeansModel(tfidf, centroids), log


def train_forest(
    sessions: SessionTerms | DataFrame, run_id: str = "forest", n_trials: int = 10, trials=None
) -> tuple[ForestModel, DataFrame]:
    """The forest uses all words of the sessions, however many."""
    rows = training_terms(sessions)
    terms = rows.fit_all()
    data = settle(rows.features(terms), "forest-input")
    tfidf = TermTable.from_table(terms.vocab)
    forest, table = search_forest(data, tfidf.dim, "row_no", n_trials=n_trials, trials=trials)
    logs = None
    for t in table.orderBy("run_no").collect():
        one = run_rows(
            rows.terms.sparkSession,
            f"{run_id}/{t['run_no']}",
            {
                "n_estimators": t["n_trees"], "contamination": t["contamination"],
                "max_samples": t["max_samples"], "sample_rows": t["sample_rows"],
            },
            {"avg_anomaly_score": t["mean_score"]},
        )
        logs = one if logs is None else logs.unionByName(one)
    return ForestModel(tfidf, forest), logs


def train_encoder(
    sessions: SessionTerms | DataFrame, run_id: str = "encoder", epochs: int = EPOCHS, batch: int = BATCH_SIZE,
    k: int = N_CLUSTERS, max_features: int = MAX_FEATURES, parts: int = 1,
) -> tuple[EncoderModel, DataFrame]:
    rows = training_terms(sessions)
    tfidf = rows.fit(max_features)
    data = settle(
        split_tail(rows.features(tfidf), "row_no").select("features", "is_validation"),
        "encoder-input",
    )
    network, losses = fit_autoencoder(data, tfidf.dim, epochs=epochs, batch=batch, parts=parts)
    latent = with_latent(data, network).select("latent", array_to_vector("latent").alias("vector")).persist()
    centroids = fit_kmeans(latent, "vector", k, LATENT_SEED)
    assigned = assign_clusters(latent, centroids, "latent").withColumn(
        "_label", F.col("cluster").cast("double")
    )
    silhouette = ClusteringEvaluator(featuresCol="vector", predictionCol="_label").evaluate(assigned) if (
        assigned.select("cluster").distinct().count() > 1
    ) else 0.0
    log = run_rows(
        rows.terms.sparkSession,
        run_id,
        {
            "latent_dim": LATENT_DIM, "max_features": max_features, "n_clusters": k,
            "epochs": epochs, "batch_size": batch,
        },
        {"silhouette_score": silhouette, **_cluster_metrics(assigned)},
        losses,
    )
    latent.unpersist()
    return EncoderModel(tfidf, network, centroids), log
