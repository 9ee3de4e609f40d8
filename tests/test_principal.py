"""The linear baseline, and training by workers that average slices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riftlog.operators import autoencoder as ae
from riftlog.operators.principal import covariance, fit_principal, with_principal


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(2)
    return rng.normal(size=(300, 3)) @ rng.normal(size=(3, 7)) + 0.01 * rng.normal(size=(300, 7)) + 5


@pytest.mark.parametrize("kind", ["dense", "sparse"])
def test_components_equal_numpy(spark, table, kind):
    x = np.where(np.arange(7) == 3, 0.0, table)
    if kind == "dense":
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "id long, features array<double>")
    else:
        df = spark.createDataFrame([(i, ([j for j in range(7) if v[j]], [float(a) for a in v if a])) for i, v in enumerate(x)],
                                   "id long, features struct<indices array<int>, values array<double>>")
    df = df.repartition(5)
    want = np.cov(x.T, bias=True)
    got = np.zeros((7, 7))
    for r in covariance(df, 7).collect():
        got[r["i"], r["j"]] = r["covariance"]
    assert np.allclose(got, want, atol=1e-9)
    model = fit_principal(df, 7, 3)
    values = np.linalg.eigvalsh(want)[::-1]
    assert np.allclose(model.variances, np.maximum(values, 0), atol=1e-9) and np.allclose(model.mean, x.mean(0))
    assert np.allclose(model.components @ model.components.T, np.eye(3), atol=1e-9)
    rows = with_principal(df.filter("features IS NOT NULL"), model).collect()
    errors = [r["reconstruction_error"] for r in rows]
    assert abs(np.mean(errors) - model.left_over) < 1e-9 and model.left_over < 1e-3
    latent = np.array([r["latent"] for r in sorted(rows, key=lambda r: r["id"])])
    assert np.allclose(latent, (x - x.mean(0)) @ model.components.T, atol=1e-8)


def test_no_rows(spark):
    df = spark.createDataFrame([], "features array<double>")
    model = fit_principal(df, 4, 2)
    assert model.components.shape == (0, 4) and covariance(df, 4).count() == 0 and with_principal(df, model).count() == 0


def test_workers_average_slices(spark, table):
    """Slices put together are the mean of whole states; the number of rows decides nothing."""
    df = spark.createDataFrame([(v.tolist(), i % 9 == 0) for i, v in enumerate((table - table.min()) / np.ptp(table))], "features array<double>, is_validation boolean")
    for workers in (1, 3):
        net, losses = ae.fit_autoencoder(df.repartition(4), 7, hidden=(8,), latent=3, epochs=6, batch=16, parts=workers)
        assert losses["train_loss"][-1] < losses["train_loss"][0] and len(net.weights) == len(ae.Network.fresh(net.sizes).weights)
    import pandas as pd

    states = [np.random.default_rng(i).normal(size=11).astype(np.float32) for i in range(3)]
    rows = [2, 5, 1]
    cuts = np.linspace(0, 11, 4).astype(int)
    parts = [ae._average(pd.DataFrame([{"slice": s, "part": i, "n": 0, "loss": 0.0, "n_val": 0, "val_loss": 0.0, "steps": 1, "rows": rows[i],
                                        "state": states[i][a:b].tobytes()} for i in range(3)])) for s, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    whole = np.concatenate([np.frombuffer(p["state"][0], np.float32) for p in parts])
    assert np.allclose(whole, sum(r * s for r, s in zip(rows, states)) / 8, atol=1e-6)
    assert ae.fit_autoencoder(df.limit(0), 7, hidden=(8,), latent=3, epochs=2, parts=2)[1] == {"train_loss": [], "val_loss": []}
