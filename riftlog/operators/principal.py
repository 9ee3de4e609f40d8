"""Principal components: the linear baseline of the autoencoder.

One pass adds up the products of all pairs of features in each task; a task sends its
matrix row by row, and every row is summed on its own, so what moves is tasks x matrix and
no task sums more than some rows. The decomposition of the small matrix is the driver's.
Features are few here (a capped vocabulary, a latent vector); memory grows with the square
of their number, never with the rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riftlog.config import LATENT_DIM
from riftlog.functions.vectors import dense_rows
from riftlog.operators.kmeans import SparseColumn, feature_column
from riftlog.session import settle


def _products(dim: int, is_struct: bool):
    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The last row holds the sums of the features and the number of rows.
        total = np.zeros((dim + 1, dim + 1))
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                column = pdf["features"].iloc[at : at + 1024]
                x = dense_rows(pd.DataFrame(column.tolist()) if is_struct else column, dim)
                x = np.hstack([x, np.ones((len(x), 1))])
                total += x.T @ x
        if total[-1, -1]:
            yield pd.DataFrame({"at": np.arange(dim + 1), "sums": list(total)})

    return add_up


def _sum_row(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"at": [int(pdf["at"].iloc[0])], "sums": [np.vstack(pdf["sums"].to_numpy()).sum(0)]})


def covariance_rows(df: DataFrame, dim: int, features: str = "features") -> DataFrame:
    """``at, sums``: row ``at`` of the sums of products of features (and 1); row ``dim``
    has the sums of the features and, last, the number of rows."""
    rows = df.select(F.col(features).alias("features")).filter(F.col("features").isNotNull())
    is_struct = rows.schema["features"].dataType.typeName() == "struct"
    schema = "at int, sums array<double>"
    return rows.mapInPandas(_products(dim, is_struct), schema).groupBy("at").applyInPandas(_sum_row, schema)


def covariance(df: DataFrame, dim: int, features: str = "features") -> DataFrame:
    """``i, j, covariance`` of all pairs of features, over all rows."""
    sums = settle(covariance_rows(df, dim, features), "products")
    totals = sums.filter(F.col("at") == dim).select("sums").scalar()
    entry = sums.filter(F.col("at") < dim).select(F.col("at").alias("i"), F.posexplode("sums").alias("j", "s"))
    n = F.get(totals, F.lit(dim))
    value = F.col("s") / n - F.get(totals, F.col("i")) / n * (F.get(totals, F.col("j")) / n)
    return entry.filter(F.col("j") < dim).select("i", "j", value.alias("covariance"))


@dataclass(frozen=True)
class Principal:
    """Mean, components (rows, of unit length, by falling variance) and all variances."""

    mean: np.ndarray
    components: np.ndarray
    variances: np.ndarray

    @property
    def dim(self) -> int:
        return len(self.mean)

    @property
    def left_over(self) -> float:
        """The mean squared error that the components leave, per feature."""
        return float(self.variances[len(self.components) :].sum() / max(self.dim, 1))


def fit_principal(df: DataFrame, dim: int, k: int = LATENT_DIM, features: str = "features") -> Principal:
    """The ``k`` directions of most variance; the sign of each makes its largest part
    positive. Without rows there are none."""
    rows = {r["at"]: np.array(r["sums"]) for r in covariance_rows(df, dim, features).collect()}
    if not rows:
        return Principal(np.zeros(dim), np.zeros((0, dim)), np.zeros(dim))
    total = np.vstack([rows[i] for i in range(dim + 1)])
    mean = total[-1, :-1] / total[-1, -1]
    values, vectors = np.linalg.eigh(total[:-1, :-1] / total[-1, -1] - np.outer(mean, mean))
    order = np.argsort(-values, kind="stable")
    components = vectors[:, order[:k]].T
    sign = np.sign(components[np.arange(len(components)), np.abs(components).argmax(1)])
    return Principal(mean, components * sign[:, None], np.maximum(values[order], 0))


def with_principal(df: DataFrame, model: Principal, features: str = "features") -> DataFrame:
    """Add ``latent`` and ``reconstruction_error``, as the autoencoder does."""

    def run(x) -> pd.DataFrame:
        latent, error = [], [np.zeros(0)]
        for at in range(0, len(x), 1024):
            rows = dense_rows(x.iloc[at : at + 1024], model.dim) - model.mean
            inside = rows @ model.components.T
            latent.extend(inside.tolist())
            error.append(((rows - inside @ model.components) ** 2).mean(axis=1))
        return pd.DataFrame({"latent": latent, "error": np.concatenate(error)})

    @F.pandas_udf("latent array<double>, error double")
    def dense(x: pd.Series) -> pd.DataFrame:
        return run(x)

    @F.pandas_udf("latent array<double>, error double")
    def sparse(x: pd.DataFrame) -> pd.DataFrame:
        return run(x)

    column = feature_column(df, features)
    out = sparse(F.col(column.name)) if isinstance(column, SparseColumn) else dense(column)
    found = df.withColumn("_principal", out)
    return found.withColumns({"latent": F.col("_principal.latent"), "reconstruction_error": F.col("_principal.error")}).drop("_principal")
