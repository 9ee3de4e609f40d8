"""Equal rows of a batch are scored once."""

import numpy as np
import pandas as pd

from riftlog.operators import iforest, kmeans


def sparse(rows):
    at = [np.flatnonzero(r) for r in rows]
    return pd.DataFrame({"indices": [a.astype(np.int32) for a in at], "values": [r[a] for r, a in zip(rows, at)]})


def counted(monkeypatch, module):
    seen, real = [], module.dense_rows
    monkeypatch.setattr(module, "dense_rows", lambda x, *a: seen.append(len(x)) or real(x, *a))
    return seen


def batch():
    rng = np.random.default_rng(2)
    return rng.integers(-1, 2, size=(7, 5)).astype(float)[rng.integers(0, 7, 400)]


def test_nearest_centre(monkeypatch):
    x, centers = batch(), np.random.default_rng(1).normal(size=(3, 5))
    seen = counted(monkeypatch, kmeans)
    d = np.sqrt(((x[:, None] - centers[None]) ** 2).sum(axis=2))
    for given in (sparse(x), pd.Series(list(x))):
        got = kmeans._nearest(given, centers, np.array([4, 5, 6], np.int32))
        assert got["cluster"].tolist() == (d.argmin(axis=1) + 4).tolist()
        np.testing.assert_allclose(got["distance"], d.min(axis=1))
    assert 0 < sum(seen) <= 14
    assert len(kmeans._nearest(sparse(x[:0]), centers, np.array([4, 5, 6], np.int32))) == 0


def test_paths(monkeypatch):
    x = batch()
    names = ["tree", "node", "feature", "threshold", "left", "right", "size", "depth"]
    nodes = [row for t in range(3) for row in ((t, 0, t, 0.5, 1, 2, 9, 0), (t, 1, -1, 0.0, -1, -1, 2 + t, 1), (t, 2, -1, 0.0, -1, -1, 7 - t, 1))]
    reader = iforest._PathReader(iforest._node_array(pd.DataFrame(nodes, columns=names)), 5, 9)
    alone = [reader.scores(pd.Series([r]), (1, 3))[0] for r in x]
    seen = counted(monkeypatch, iforest)
    for given in (sparse(x), pd.Series(list(x))):
        assert reader.scores(given, (1, 3)).tolist() == alone
    assert 0 < sum(seen) <= 14
    assert len(reader.scores(sparse(x[:0]), (1, 3))) == 0
