"""Scoring uploaded logs: from lines to one scored row per window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from riftlog.config import DISTANCE_THRESHOLD, SIMILARITY, WINDOW_LINES
from riftlog.functions.parsing import computed_once
from riftlog.functions.tokens import words
from riftlog.operators.autoencoder import Network, with_latent
from riftlog.operators.features import TfIdf
from riftlog.operators.iforest import Forest, decide, keep_windows
from riftlog.operators.kmeans import Centroids, assign_clusters, flag_far
from riftlog.operators.lookups import lookup_join
from riftlog.operators.session_terms import TermTable
from riftlog.operators.templates import distinct_shapes, learn_more, match_shapes, with_shape
from riftlog.operators.windows import context_payload, sliding_windows
from riftlog.session import settle


@dataclass(frozen=True)
class KMeansModel:
    tfidf: TfIdf
    centroids: Centroids


@dataclass(frozen=True)
class ForestModel:
    tfidf: TfIdf | TermTable
    forest: Forest


@dataclass(frozen=True)
class EncoderModel:
    tfidf: TfIdf
    network: Network
    centroids: Centroids


def with_unit(
    lines: DataFrame,
    unit: str = "template",
    templates: DataFrame | None = None,
    line: str = "value",
    order: str = "line_no",
    learn: bool = False,
    similarity: float = SIMILARITY,
    masked: str | None = None,
) -> DataFrame:
    """Add ``unit``, the text a window is made of: the line itself, or the
    template of the line. Templates are looked up in ``templates``; a line that
    fits none stands for itself with its digits masked, as a new template would.
    With ``learn``, the templates first go on learning from all lines given. ``masked``
    names a column that holds the masked lines, if there is one."""
    if unit == "line":
        return lines.withColumn("unit", F.col(line))
    if unit != "template":
        raise ValueError(f"unit must be line or template, not {unit!r}")
    shaped = with_shape(lines, line, masked)
    if templates is None:
        return shaped.withColumnRenamed("shape", "unit")
    shapes = settle(distinct_shapes(shaped, order), "shapes")
    if learn:
        templates = learn_more(templates, shapes, similarity)
    found = settle(match_shapes(shapes, templates), "matches")
    return (
        lookup_join(shaped, found.select("shape", "template"), ["shape"], "left", [order])
        .withColumn("unit", F.coalesce("template", "shape"))
        .select(*lines.columns, "unit")
    )


def scoring_windows(
    lines: DataFrame, size: int = WINDOW_LINES, line: str = "value", keys=("file",)
) -> DataFrame:
    """Windows of an uploaded log with a ``unit`` column: start line and words.
    Several files are scored at once; files too short for a window give none.

    The words of a window are those of its units in order, as if these had been
    joined by blanks; so each line is cut into words once, not once per window."""
    none = F.array().cast("array<string>")
    cut = computed_once(lines, words=F.coalesce(words(F.col("unit")), none))
    windows = sliding_windows(cut, keys, "line_no", ["words"], [line], size)
    return windows.select(
        *keys, "line_no", F.col(line).alias("window_start_line"), F.flatten("words_window").alias("words")
    )


def anomaly_payload(
    scored: DataFrame, lines: DataFrame, line: str = "value", keys=("file",), size: int = WINDOW_LINES
) -> DataFrame:
    """The windows flagged ``is_anomaly`` with their lines, as JSON text: ``line_no`` and
    ``payload``. Lines are fetched for flagged windows only, so scoring carries none."""
    keys = list(keys)
    flagged = scored.filter("is_anomaly").select(*keys, F.col("line_no").alias("_first"))
    places = flagged.withColumn("line_no", F.explode(F.sequence("_first", F.col("_first") + size - 1)))
    found = places.join(lines.select(*keys, "line_no", F.col(line).alias("_line")), [*keys, "line_no"])
    rows = F.array_sort(F.collect_list(F.struct("line_no", "_line")))
    whole = found.groupBy(*keys, F.col("_first").alias("line_no")).agg(rows["_line"].alias("log_window"))
    return context_payload(whole, "log_window").select(*keys, "line_no", "payload")


def score_kmeans(
    windows: DataFrame, model: KMeansModel, threshold: float = DISTANCE_THRESHOLD
) -> DataFrame:
    """``window_start_line, cluster, anomaly_score, is_anomaly`` by the distance to
    the nearest centre."""
    scored = assign_clusters(model.tfidf.features(windows, "words"), model.centroids)
    return flag_far(scored, threshold).drop("features", "words")


def score_forest(windows: DataFrame, model: ForestModel, keep: str = "all") -> DataFrame:
    """``window_start_line, anomaly_score, is_anomaly`` by the isolation forest;
    ``keep`` may leave only the normal or only the abnormal windows."""
    scored = decide(model.tfidf.features(windows, "words").drop("words"), model.forest)
    return keep_windows(scored, keep).drop("features")


def score_encoder(windows: DataFrame, model: EncoderModel) -> DataFrame:
    """``log_window_start, cluster, anomaly_score`` by the reconstruction error,
    with the cluster of the latent vector."""
    encoded = with_latent(model.tfidf.features(windows, "words"), model.network)
    return (
        assign_clusters(encoded, model.centroids, "latent")
        .withColumnsRenamed(
            {"reconstruction_error": "anomaly_score", "window_start_line": "log_window_start"}
        )
        .drop("features", "words", "latent", "distance")
    )
