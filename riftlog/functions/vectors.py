"""Feature columns: array columns, sparse structs and ML vectors.

A sparse feature is ``struct<indices array<int>, values array<double>>``; a dense
one is an array. Functions that run in Python workers take either."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F


def sparse_struct(vector: Column) -> Column:
    """A sparse ML vector as a plain struct, without leaving the JVM."""
    raw = F.unwrap_udt(vector)
    return F.struct(raw["indices"].alias("indices"), raw["values"].alias("values"))


def dense_rows(features, dim: int, columns: np.ndarray | None = None) -> np.ndarray:
    """An Arrow batch of features as a (rows, dim) matrix; with ``columns``, a
    sorted array of places, only those columns of it."""
    n = len(features)
    width = dim if columns is None else len(columns)
    if not isinstance(features, pd.DataFrame):
        if n == 0:
            return np.zeros((0, width))
        dense = np.vstack(features.to_numpy()).astype(np.float64, copy=False)
        return dense if columns is None else dense[:, columns]
    out = np.zeros((n, width))
    lengths = np.fromiter((len(x) for x in features["indices"]), dtype=np.int64, count=n)
    if lengths.sum() and width:
        rows = np.repeat(np.arange(n), lengths)
        places = np.concatenate(features["indices"].to_numpy()).astype(np.int64)
        values = np.concatenate(features["values"].to_numpy())
        if columns is not None:
            found = np.minimum(np.searchsorted(columns, places), width - 1)
            kept = columns[found] == places
            rows, places, values = rows[kept], found[kept], values[kept]
        out[rows, places] = values
    return out


def distinct_rows(features) -> tuple:
    """Of an Arrow batch of features the first of each group of equal rows, and the place
    of every row among these. What is computed per row need not be done for copies, such
    as the windows of a log of few templates; a batch without any only pays for a look-up."""
    if isinstance(features, pd.DataFrame):
        keys = [(np.asarray(i).tobytes(), np.asarray(v).tobytes()) for i, v in zip(features["indices"], features["values"])]
    else:
        keys = [np.asarray(x).tobytes() for x in features]
    number: dict = {}
    place = np.fromiter((number.setdefault(k, len(number)) for k in keys), dtype=np.int64, count=len(keys))
    return features.iloc[np.unique(place, return_index=True)[1]], place


def used_columns(features, dim: int) -> np.ndarray:
    """Places that are set in any row of a batch; all of them if it is dense."""
    if not isinstance(features, pd.DataFrame):
        return np.arange(dim)
    if not len(features):
        return np.zeros(0, dtype=np.int64)
    return np.unique(np.concatenate(features["indices"].to_numpy()).astype(np.int64))


def squared_distance(a: Column, b: Column) -> Column:
    """Sum of squared differences of two arrays."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) ** 2),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def mean_squared_error(a: Column, b: Column) -> Column:
    """Row-wise mean squared difference of two arrays."""
    return squared_distance(a, b) / F.size(a)
