"""Model bundles as Parquet tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from riftlog.operators.autoencoder import Network
from riftlog.operators.features import TfIdf
from riftlog.operators.iforest import Forest
from riftlog.operators.kmeans import Centroids
from riftlog.operators.scoring import EncoderModel, ForestModel, KMeansModel
from riftlog.operators.session_terms import TermTable

_PARTS = {
    KMeansModel: {"tfidf": TfIdf, "centroids": Centroids},
    ForestModel: {"tfidf": TermTable, "forest": Forest},
    EncoderModel: {"tfidf": TfIdf, "network": Network, "centroids": Centroids},
}


def save_model(spark: SparkSession, model, path: str) -> str:
    """One table per part of the bundle, below ``path``."""
    for part in _PARTS[type(model)]:
        getattr(model, part).table(spark).write.mode("overwrite").parquet(f"{path}/{part}")
    return path


def load_model(spark: SparkSession, kind: type, path: str):
    return kind(
        **{
            part: cls.from_table(spark.read.parquet(f"{path}/{part}"))
            for part, cls in _PARTS[kind].items()
        }
    )
