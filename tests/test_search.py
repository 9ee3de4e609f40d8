"""The sequential sampler, and a forest study with an objective of the caller."""

import math

import numpy as np
import pytest

from riftlog.operators import iforest as iso
from riftlog.operators.search import Choice, Number, study, suggest

SPACE = {"x": Number(-5.0, 5.0), "n": Number(0, 40, whole=True), "kind": Choice(("a", "b", "c"))}


def bowl(t):
    return -((t["x"] - 1.3) ** 2) - ((t["n"] - 31) / 8) ** 2 - (0 if t["kind"] == "b" else 3)


def test_learns_from_trials():
    learned = [max(v for _, v in study(bowl, SPACE, 60, seed)) for seed in range(8)]
    drawn = [max(v for _, v in study(bowl, SPACE, 60, seed, startup=60)) for seed in range(8)]
    # A study may stay with a wrong option; most come much nearer than even draws.
    assert sum(a > b for a, b in zip(learned, drawn)) >= 6 and np.median(learned) > 0.25 * np.median(drawn)


def test_seeded_inside_and_whole():
    a, b = study(bowl, SPACE, 25, 7), study(bowl, SPACE, 25, 7)
    assert a == b != study(bowl, SPACE, 25, 8)
    assert all(-5 <= t["x"] <= 5 and 0 <= t["n"] <= 40 and isinstance(t["n"], int) and t["kind"] in "abc" for t, _ in a)


def test_finite_space_is_tried_out_and_missing_values_lose():
    space = {"k": Choice((1, 2, 3)), "n": Number(1, 4, whole=True)}
    trials = study(lambda t: None if t["k"] == 2 else t["k"] * t["n"], space, 12, 1)
    assert len({(t["k"], t["n"]) for t, _ in trials}) == 12
    assert sum(math.isnan(v) for _, v in trials) == 4
    assert suggest(space, trials, np.random.default_rng(0))["k"] in (1, 2, 3)  # nothing is left


def test_one_point():
    assert {tuple(t.values()) for t, _ in study(lambda t: 1.0, {"x": Number(2.0, 2.0), "n": Number(3, 3, whole=True)}, 14)} == {(2.0, 3)}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 3))
    x[:6] += 9
    return spark.createDataFrame([(i, v.tolist(), i < 6) for i, v in enumerate(x)], "row_no long, features array<double>, odd boolean")


def test_forest_study(spark, rows):
    space = {"n_trees": Number(5, 12, whole=True), "contamination": Number(0.01, 0.3), "max_samples": Choice(("auto", 1.0))}
    agree = lambda d: d.selectExpr("avg(CASE WHEN is_anomaly = odd THEN 1.0D ELSE 0.0D END)").first()[0]
    forest, table = iso.study_forest(rows, 3, "row_no", agree, n_trials=5, space=space)
    log = table.orderBy("run_no").collect()
    assert [r["run_no"] for r in log] == list(range(5)) and all(5 <= r["n_trees"] <= 12 for r in log)
    assert agree(iso.decide(rows, forest)) == max(r["score"] for r in log)
    _, default = iso.study_forest(rows, 3, "row_no", n_trials=2, space=space)
    assert default.filter("score IS NOT NULL").count() == 2
