"""The exact silhouette copies a vector a bounded number of times."""

import numpy as np
from pyspark.sql import functions as F

from riftlog.operators import kmeans


def test_distances():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(70, 16)) + 50, rng.normal(size=(40, 16)) + 50
    y[:5], y[5:9] = x[:5], x[5:9] + 1e-9
    want = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
    np.testing.assert_allclose(kmeans.distances(x, y), want, rtol=1e-8, atol=1e-12)
    assert not kmeans.distances(x, y)[range(5), range(5)].any()


def test_copies_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(kmeans, "PAIR_BLOCKS", 3)
    copies, real = [], F.sequence
    monkeypatch.setattr(kmeans.F, "sequence", lambda a, b: copies.append(b) or real(a, b))
    rng = np.random.default_rng(5)
    x, label = rng.normal(size=(90, 6)), rng.integers(0, 3, 90)
    df = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, label)], "x array<double>, k int")
    got = kmeans.silhouette_exact(df, "x", "k", block_rows=4).first()[0]
    assert spark.range(1).select(copies[0]).first()[0] == 2
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    s = []
    for i in range(90):
        mean = [d[i, label == k].sum() / max(1, (label == k).sum() - (k == label[i])) for k in range(3)]
        a, b = mean[label[i]], min(m for k, m in enumerate(mean) if k != label[i])
        s.append((b - a) / max(a, b))
    assert abs(got - np.mean(s)) < 1e-9
