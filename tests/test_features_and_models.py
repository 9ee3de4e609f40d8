"""Features, clustering, forests and the autoencoder on small tables."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riftlog.operators import autoencoder as ae, features, iforest, kmeans, runs
from riftlog.functions.vectors import dense_rows

TEXTS = ["A b cd cd ef", "cd gh_1 Été", "", "x y z", "ef ef ef cd 42"]


def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, sequence string")


def plain_tfidf(limit=None):
    import re

    words = [re.findall(r"\b\w\w+\b", t.lower()) for t in TEXTS]
    total, df = {}, {}
    for ws in words:
        for w in ws:
            total[w] = total.get(w, 0) + 1
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    vocab = sorted(total, key=lambda w: (-total[w], w))[:limit]
    out = {}
    for i, ws in enumerate(words):
        vec = {w: ws.count(w) * (math.log((1 + len(TEXTS)) / (1 + df[w])) + 1) for w in set(ws) if w in vocab}
        norm = math.sqrt(sum(v * v for v in vec.values()))
        out.update({(i, w): v / norm for w, v in vec.items()})
    return out


@pytest.mark.parametrize("limit", [2, 1000])
def test_tfidf(spark, limit):
    model = features.fit_tfidf(docs(spark), limit=limit)
    got = {(r["id"], r["term"]): r["weight"] for r in model.long_form(docs(spark), "id").collect()}
    want = plain_tfidf(limit)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    full = {(r["id"], r["term"]): r["weight"] for r in features.tfidf_full(docs(spark), "id").collect()}
    want = plain_tfidf()
    assert full.keys() == want.keys() and all(abs(full[k] - want[k]) < 1e-12 for k in want)


def test_padded_ids(spark):
    d = docs(spark)
    out = features.padded_token_ids(d, features.token_vocabulary(d, "sequence", 4), "id", "sequence", 3)
    got = {r["id"]: (r["input_ids"], r["attention_mask"]) for r in out.collect()}
    # cd and ef are equally frequent, so cd comes first.
    assert got == {0: ([2, 2, 3], [1, 1, 1]), 1: ([2, 1, 1], [1, 1, 1]), 2: ([0, 0, 0], [0, 0, 0]),
                   3: ([0, 0, 0], [0, 0, 0]), 4: ([3, 3, 3], [1, 1, 1])}


def test_splits_do_not_depend_on_partitions(spark):
    ids = spark.range(5000).toDF("id")
    a = {r["id"] for r in features.split_train(ids, "id").filter("is_train").collect()}
    b = {r["id"] for r in features.split_train(ids.repartition(7), "id").filter("is_train").collect()}
    assert a == b and abs(len(a) / 5000 - 0.8) < 0.02
    assert a != {r["id"] for r in features.split_train(ids, "id", seed=1).filter("is_train").collect()}
    tail = features.split_tail(ids.repartition(3), "id").filter("is_validation")
    assert tail.agg(F.min("id"), F.count("*")).first() == (4500, 500)


def test_dense_rows_of_some_columns():
    batch = pd.DataFrame({"indices": [[0, 3], [], [5]], "values": [[1.0, 2.0], [], [4.0]]})
    assert dense_rows(batch, 6).tolist() == [[1, 0, 0, 2, 0, 0], [0] * 6, [0, 0, 0, 0, 0, 4]]
    assert dense_rows(batch, 6, np.array([3, 4, 5])).tolist() == [[2, 0, 0], [0, 0, 0], [0, 0, 4]]


def points(spark, n=120, dim=3):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(c, 0.3, size=(n // 3, dim)) for c in (0, 3, 6)])
    x = np.vstack([x, x[:5]])
    return x, spark.createDataFrame(
        [(i, [float(v) for v in row], i % 3 if i > 110 else i // (n // 3)) for i, row in enumerate(x)],
        "id bigint, features array<double>, label int",
    )


def silhouette_plainly(x, labels, power):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) ** power
    out = []
    for i, own in enumerate(labels):
        mates = (labels == own).sum()
        if mates == 1:
            out.append(0.0)
            continue
        a = d[i, labels == own].sum() / (mates - 1)
        b = min(d[i, labels == k].mean() for k in set(labels) if k != own)
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_silhouettes(spark):
    x, df = points(spark)
    labels = np.array([r["label"] for r in df.orderBy("id").collect()])
    for block in (10, 1000):
        got = kmeans.silhouette_exact(df, "features", "label", block).first()[0]
        assert abs(got - silhouette_plainly(x, labels, 1)) < 1e-9
    assert abs(kmeans.silhouette_squared(df, "features", "label").first()[0] - silhouette_plainly(x, labels, 2)) < 1e-9


def test_best_seed_finds_the_clusters(spark):
    x, df = points(spark)
    model, table = kmeans.fit_best_kmeans(df.select(array_to_vector("features").alias("vector")), k=3, seeds=(0, 1))
    assert table.count() == 2
    out = kmeans.assign_clusters(df, model).orderBy("id").collect()
    assert len({r["cluster"] for r in out[:40]}) == 1 and len({r["cluster"] for r in out}) == 3
    near = np.sqrt(((x[:, None] - model.centers[None]) ** 2).sum(-1)).min(1)
    np.testing.assert_allclose([r["distance"] for r in out], near, atol=1e-9)


def path_plainly(nodes, tree, row):
    mine = {n["node"]: n for n in nodes if n["tree"] == tree}
    n = mine[0]
    while n["feature"] >= 0:
        n = mine[n["left"] if row[n["feature"]] <= n["threshold"] else n["right"]]
    return n["depth"] + float(iforest.average_path(n["size"]))


def test_forest_scores_and_partitioning(spark):
    x, df = points(spark)
    far = spark.createDataFrame([(999, [30.0, -30.0, 30.0], 0)], df.schema)
    df = df.unionByName(far)
    forest = iforest.fit_forest(df, 3, "id", n_trees=40, contamination=0.05, max_samples=64)
    again = iforest.fit_forest(df.repartition(5), 3, "id", n_trees=40, contamination=0.05, max_samples=64)
    assert (forest.nodes == again.nodes).all() and abs(forest.offset - again.offset) < 1e-12
    assert all((forest.nodes["size"][forest.nodes["node"] == 0] == 64))
    rows = iforest.decide(df, forest).orderBy("id").collect()
    nodes = [dict(zip(forest.nodes.dtype.names, n)) for n in forest.nodes]
    for r in rows[::25]:
        mean = np.mean([path_plainly(nodes, t, r["features"]) for t in range(40)])
        want = -(2 ** (-mean / float(iforest.average_path(64)))) - forest.offset
        assert abs(r["anomaly_score"] - want) < 1e-9
    assert min(rows, key=lambda r: r["anomaly_score"])["id"] == 999
    assert sum(r["is_anomaly"] for r in rows) == 7  # 5 % of 126 rows, interpolated
    stored = iforest.Forest.from_table(forest.table(spark))
    assert (stored.nodes == forest.nodes).all() and stored.offset == forest.offset
    assert iforest.keep_windows(iforest.decide(df, forest), "normal").count() == 126 - 7


@pytest.mark.parametrize("sparse", [False, True])
def test_forest_is_the_same_where_nodes_are_cut_by_aggregates(spark, sparse):
    rng = np.random.default_rng(4)
    x = np.where(rng.random((90, 6)) < 0.5, 0.0, rng.normal(size=(90, 6)).round(1))
    x[:30] = x[0]  # a third of all rows are copies
    x[:, 5] = 0.0
    rows = [
        (i, {"indices": np.flatnonzero(r).tolist(), "values": r[r != 0].tolist()} if sparse else r.tolist())
        for i, r in enumerate(x)
    ]
    kind = "struct<indices:array<int>,values:array<double>>" if sparse else "array<double>"
    df = spark.createDataFrame(rows, f"id bigint, features {kind}")
    for samples in (1.0,) if sparse else (0.8, 50):
        whole = iforest.grow_forest(df, 6, "id", n_trees=3, max_samples=samples)
        cut = iforest.grow_forest(df.repartition(4), 6, "id", n_trees=3, max_samples=samples, node_rows=25)
        assert (whole.nodes == cut.nodes).all() and whole.sample == {0.8: 72, 1.0: 90, 50: 50}[samples]
        for t in range(3):
            nodes = whole.nodes[whole.nodes["tree"] == t]
            assert nodes["size"][0] == whole.sample == nodes["size"][nodes["feature"] < 0].sum()
            assert nodes["depth"].max() <= 7 and (nodes["size"] > 0).all() and (nodes["feature"] < 5).all()


def test_share_is_the_share_at_any_size():
    assert iforest.sample_size(100_000, 50_000) == 50_000
    assert iforest.sample_size(100_000, 0.8) == 80_000


def test_forest_search(spark):
    _, df = points(spark)
    trials = [
        {"run_no": 0, "n_trees": 10, "contamination": 0.02, "max_samples": "auto"},
        {"run_no": 1, "n_trees": 20, "contamination": 0.1, "max_samples": 0.8},
        {"run_no": 2, "n_trees": 15, "contamination": 0.1, "max_samples": 0.8},
    ]
    best, table = iforest.search_forest(df, 3, "id", trials=trials)
    rows = {r["run_no"]: r for r in table.collect()}
    assert rows[1]["sample_rows"] == int(0.8 * 125)
    alone = iforest.fit_forest(df, 3, "id", n_trees=15, contamination=0.1, max_samples=0.8)
    assert abs(rows[2]["offset"] - alone.offset) < 1e-12
    top = max(rows.values(), key=lambda r: r["mean_score"])
    assert best.n_trees == top["n_trees"] and best.offset == top["offset"]


def test_gradient_is_the_slope():
    net = ae.Network.fresh(ae.layer_sizes(6, (5,), 3))
    net = ae.Network(net.sizes, net.weights.astype(np.float64))
    x = np.random.default_rng(0).random((4, 6))

    def loss(w):
        return ((ae.Network(net.sizes, w).forward(x, np.float64)[-1] - x) ** 2).mean()

    _, grad = net.gradient(x)
    for i in range(0, len(grad), 7):
        step = np.zeros_like(net.weights)
        step[i] = 1e-5
        slope = (loss(net.weights + step) - loss(net.weights - step)) / 2e-5
        assert abs(slope - grad[i]) < 1e-5


def test_training_learns_in_one_and_many_partitions(spark):
    rng = np.random.default_rng(1)
    x = np.where(rng.random((300, 1)) > 0.5, 0.9, 0.1) * np.ones(8) + rng.normal(0, 0.02, size=(300, 8))
    df = spark.createDataFrame([([float(v) for v in r], i >= 270) for i, r in enumerate(x)], "features array<double>, is_validation boolean")
    for parts in (1, 4):
        net, losses = ae.fit_autoencoder(df.repartition(parts), 8, hidden=(32,), latent=4, epochs=15, batch=4, parts=parts)
        assert losses["val_loss"][-1] < 0.7 * losses["val_loss"][0]
        out = ae.with_reconstruction(ae.with_latent(df, net), net, "features").first()
        assert len(out["latent"]) == 4
        again = np.mean((np.array(out["features"]) - np.array(out["reconstruction"])) ** 2)
        assert abs(again - out["reconstruction_error"]) < 1e-12
        back = ae.Network.from_table(net.table(spark))
        assert back.sizes == net.sizes and (back.weights == net.weights).all()


@pytest.mark.parametrize("losses", [[5, 4, 3, 3, 3, 3, 3, 3, 1], [1, 2, 3], [3, 2, 1], [2, 1, 1, 1, 1, 1, 1]])
def test_early_stop_table_and_rule(spark, losses):
    df = spark.createDataFrame(list(enumerate(map(float, losses))), "epoch int, val_loss double")
    got = runs.early_stop(df).first()
    rule, stopped = runs.EarlyStop(), None
    for loss in losses:
        rule.update(float(loss))
        if rule.stop:
            stopped = rule.epoch
            break
    assert (got["stop_epoch"], got["best_epoch"]) == (rule.epoch if stopped is None else stopped, rule.best_epoch)
