"""A forest that stays a table scores as one that is held."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riftlog.operators import iforest as iso, iforest_table as table
from riftlog.operators.scoring import ForestModel
from riftlog.sources.models import load_model, save_model


@pytest.fixture(scope="module", params=["dense", "sparse"])
def rows(spark, request):
    rng = np.random.default_rng(0)
    x = np.where(rng.random((200, 6)) < 0.5, 0.0, rng.normal(size=(200, 6)))
    x[:20] = x[0]  # copies end in leaves of many rows
    if request.param == "dense":
        return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "row_no long, features array<double>").repartition(2)
    sparse = [(i, ([int(j) for j in np.flatnonzero(v)], v[v != 0].tolist())) for i, v in enumerate(x)]
    return spark.createDataFrame(sparse, "row_no long, features struct<indices array<int>, values array<double>>").repartition(2)


def forests(rows, **options):
    return [iso.grow_forest(rows, 6, "row_no", n_trees=3, held_nodes=n, **options) for n in (10**6, 0)]


@pytest.mark.parametrize("samples", [1.0, 64])
def test_scores_equal(rows, samples):
    held, kept = forests(rows, max_samples=samples)
    assert isinstance(held, iso.Forest) and isinstance(kept, table.TableForest)
    want = {r["row_no"]: r["score"] for r in iso.with_scores(rows, held).collect()}
    got = {r["row_no"]: r["score"] for r in iso.with_scores(rows, kept).collect()}
    assert got.keys() == want.keys() and np.allclose([got[k] for k in want], [want[k] for k in want], rtol=0, atol=1e-12)
    some = iso.trial_scores(rows, kept, "row_no", "features", (2, 3)).agg(F.sum("s0"), F.sum("s1")).first()
    full = iso.trial_scores(rows, held, "row_no", "features", (2, 3)).agg(F.sum("s0"), F.sum("s1")).first()
    assert np.allclose(some, full)


@pytest.mark.parametrize("levels, block_rows", [(2, 10**6), (4, 30)])
def test_small_blocks_and_many_parts(rows, levels, block_rows):
    held, kept = forests(rows, max_samples=1.0)
    want = {r["row_no"]: r["score"] for r in iso.with_scores(rows, held).collect()}
    got = {r["row_no"]: r["s0"] for r in table.path_sums(rows, kept, "row_no", "features", (3,), levels, block_rows).collect()}
    assert got.keys() == want.keys() and np.allclose([got[k] for k in want], [want[k] for k in want], rtol=0, atol=1e-12)


def test_search_and_bundle(spark, rows, tmp_path, monkeypatch):
    trials = [{"run_no": i, "n_trees": n, "contamination": 0.1, "max_samples": s} for i, (n, s) in enumerate([(2, 1.0), (3, 0.8)])]
    held, log = iso.search_forest(rows, 6, "row_no", trials=trials)
    monkeypatch.setattr(iso, "HELD_NODES", 0)
    kept, same = iso.search_forest(rows, 6, "row_no", trials=trials)
    plain = lambda t: [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in t.orderBy("run_no").collect()]
    assert plain(log) == plain(same) and abs(held.offset - kept.offset) < 1e-12
    from riftlog.operators.features import TfIdf

    path = save_model(spark, ForestModel(TfIdf(("a",), (1.0,)), kept), str(tmp_path / "m"))
    back = load_model(spark, ForestModel, path).forest
    assert isinstance(back, table.TableForest) and back.offset == kept.offset and back.n_trees == kept.n_trees
    a, b = (sorted((r["row_no"], round(r["anomaly_score"], 9), r["is_anomaly"]) for r in iso.decide(rows, f).collect()) for f in (held, back))
    assert a == b


@pytest.mark.parametrize("samples, node_rows", [(1.0, None), (0.8, None), (0.8, 25)])
def test_scored_while_it_grows(rows, monkeypatch, samples, node_rows):
    """Rows that a tree has not drawn end in its leaves as when they are scored later, also
    below nodes that are cut by aggregates."""
    held = iso.grow_forest(rows, 6, "row_no", n_trees=3, max_samples=samples)
    monkeypatch.setattr(iso, "HELD_NODES", 0)
    forest, scores = iso.grow_and_score(rows, 6, "row_no", "features", (2, 3), samples, iso.FOREST_SEED, 200, node_rows)
    assert isinstance(forest, table.TableForest) and "_in" not in forest.nodes.columns
    want = iso.trial_scores(rows, held, "row_no", "features", (2, 3))
    got, want = (np.array(sorted(tuple(r) for r in d.collect())) for d in (scores, want))
    assert got.shape == (200, 2) and np.allclose(got, want, rtol=0, atol=1e-12)
    assert (iso._linked(forest.nodes.toPandas()) == held.nodes).all()


def test_levels_at_once_are_node_by_node(monkeypatch):
    x = np.random.default_rng(5).normal(size=(300, 5)).round(1)
    x[:100] = x[0]
    at_once, leaf = iso.grow_tree(x, np.arange(5) * 3, 42, 7, 9)
    monkeypatch.setattr(iso, "LEVEL_CELLS", -1)
    one_by_one, same = iso.grow_tree(x, np.arange(5) * 3, 42, 7, 9)
    assert at_once.equals(one_by_one) and (leaf == same).all() and len(at_once) > 100


def test_no_rows(spark, rows):
    _, kept = forests(rows, max_samples=64)
    assert iso.with_scores(rows.limit(0), kept).count() == 0
