"""Trees over most rows are grown whole, and rows meet pieces of a forest, not each tree."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riftlog.operators import iforest as iso, iforest_table as table, iforest_whole as whole

KINDS = {"dense": "array<double>", "single": "array<float>", "sparse": "struct<indices array<int>, values array<double>>"}


def rows_of(spark, kind):
    rng = np.random.default_rng(3)
    x = np.where(rng.random((150, 5)) < 0.5, 0.0, rng.normal(size=(150, 5)))
    x[:40] = x[0]
    if kind == "sparse":
        data = [(i, ([int(j) for j in np.flatnonzero(v)], v[v != 0].tolist())) for i, v in enumerate(x)]
    else:
        data = [(i, v.tolist()) for i, v in enumerate(x)]
    return spark.createDataFrame(data, f"row_no long, features {KINDS[kind]}").repartition(3)


def test_hash_is_that_of_the_rows(spark):
    df = spark.range(200).select(
        F.xxhash64(F.lit(42), F.lit("tree"), "id").alias("head"), F.xxhash64(F.lit(42), F.lit("tree"), "id", F.lit(299)).alias("all")
    ).toPandas()
    assert (whole.hash_on(df["head"].to_numpy(), 299).astype(np.int64) == df["all"].to_numpy()).all()


@pytest.mark.parametrize("kind", list(KINDS))
@pytest.mark.parametrize("samples", [1.0, 0.8])
def test_rows_move_to_groups_of_trees(spark, monkeypatch, kind, samples):
    """The same nodes and scores as where a row is copied to each tree, which is not done."""
    rows = rows_of(spark, kind)
    held = iso.grow_forest(rows, 5, "row_no", n_trees=20, max_samples=samples)
    want = np.array(sorted(tuple(r) for r in iso.trial_scores(rows, held, "row_no", "features", (7, 20)).collect()))
    monkeypatch.setattr(iso, "HELD_NODES", 0)
    monkeypatch.setattr(iso, "tree_samples", None)
    forest, scores = iso.grow_and_score(rows, 5, "row_no", "features", (7, 20), samples, iso.FOREST_SEED, 150)
    assert np.allclose(np.array(sorted(tuple(r) for r in scores.collect())), want, rtol=0, atol=1e-12)
    assert (iso._linked(forest.nodes.toPandas()) == held.nodes).all() and forest.n_nodes == len(held.nodes)
    assert (iso._linked(forest.first(7).nodes.toPandas()) == held.first(7).nodes).all()
    grown = iso.grow_forest(rows, 5, "row_no", n_trees=20, max_samples=samples)
    assert isinstance(grown, table.TableForest) and (iso._linked(grown.nodes.toPandas()) == held.nodes).all()


@pytest.mark.parametrize("kind", ["dense", "sparse"])
def test_rows_move_to_pieces_of_a_forest(spark, monkeypatch, kind):
    rows = rows_of(spark, kind)
    held = iso.grow_forest(rows, 5, "row_no", n_trees=6, max_samples=1.0)
    kept = iso.grow_forest(rows, 5, "row_no", n_trees=6, max_samples=1.0, held_nodes=0)
    want = {r["row_no"]: r["score"] for r in iso.with_scores(rows, held).collect()}
    blocks = {r["row_no"]: r["s0"] for r in table.path_sums(rows, kept, "row_no", "features", (6,), tree_nodes=0).collect()}
    monkeypatch.setattr(table, "_block_sums", None)
    monkeypatch.setattr(table, "CHUNK_ROWS", 20)
    for piece_nodes in (1, 300):
        got = {r["row_no"]: r["s0"] for r in table.path_sums(rows, kept, "row_no", "features", (6,), piece_nodes=piece_nodes).collect()}
        assert got.keys() == want.keys() == blocks.keys()
        for k, v in want.items():
            assert abs(got[k] - v) < 1e-12 and abs(blocks[k] - v) < 1e-12


def test_equal_hashes_are_taken_by_id():
    import pyarrow as pa

    heads = np.repeat(np.arange(4), 3)  # three rows of each hash
    ids = [pa.array([9, 1, 5, 3, 7, 2]), pa.array([8, 4, 6, None, 0, 11])]
    draw = whole.hash_on(heads, 5) & np.uint64((1 << 40) - 1)
    named = [9, 1, 5, 3, 7, 2, 8, 4, 6, None, 0, 11]
    order = sorted(range(12), key=lambda i: (int(draw[i]), named[i] is not None, named[i]))
    for size in range(1, 13):
        assert sorted(order[:size]) == np.flatnonzero(whole.drawn(heads, ids, 5, size, 1.0)).tolist()
