"""Operators that must give whole results whatever the skew or partitioning."""

import random

import pytest
from pyspark.sql import functions as F

from riftlog.operators import windows
from riftlog.operators.lookups import lookup_join
from riftlog.operators.positions import with_positions
from riftlog.operators.quantiles import exact_quantiles
from riftlog.operators.sequences import session_sequences


def hot_rows(n=600, seed=3):
    """A third of all rows share one key."""
    rng = random.Random(seed)
    return [(f"k{0 if rng.random() < 0.34 else rng.randint(1, 40)}", i * 3 + 5, f"t{rng.randint(0, 9)}") for i in range(n)]


@pytest.mark.parametrize("block", [1, 7, 64, 100000])
def test_positions(spark, block):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, o bigint, t string").repartition(5)
    got = {(r["k"], r["o"]): r["pos"] for r in with_positions(df, "o", ["k"], block).collect()}
    seen = {}
    for k, o, _ in rows:
        assert got[(k, o)] == seen.get(k, 0)
        seen[k] = seen.get(k, 0) + 1
    assert sorted(r["pos"] for r in with_positions(df, "o", block_rows=block).collect()) == list(range(len(rows)))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_small_and_spread(spark, how):
    left = spark.createDataFrame(hot_rows(), "k string, o bigint, t string")
    right = spark.createDataFrame([(f"k{i}", i) for i in range(20)], "k string, v int")
    small = lookup_join(left, right, ["k"], how)
    large = lookup_join(left, right, ["k"], how, ["o"], max_rows=3, salts=4)
    assert small.columns == large.columns
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


@pytest.mark.parametrize("piece", [1, 16, 10_000])
def test_session_pieces_make_up_the_whole(spark, piece):
    rows = hot_rows()
    df = spark.createDataFrame(rows + [(None, 1, "x"), ("k0", 1, None)], "request_id string, line_no bigint, template string")
    for parts in (1, 6):
        got = session_sequences(df.repartition(parts), piece_events=piece, block_rows=50).collect()
        whole = {}
        for r in sorted(got, key=lambda r: (r["session_id"], r["piece"])):
            assert r["n_events"] <= piece and len(r["sequence"].split(" ")) == r["n_events"]
            whole.setdefault(r["session_id"], []).append(r["sequence"])
        want = {}
        for k, _, t in rows:
            want.setdefault(k, []).append(t)
        assert {k: " ".join(v) for k, v in whole.items()} == {k: " ".join(v) for k, v in want.items()}


@pytest.mark.parametrize("build", [7, 10_000])
def test_sessions_are_whole(spark, build):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "request_id string, line_no bigint, template string").repartition(6)
    want = {}
    for k, _, t in rows:
        want.setdefault(k, []).append(t)
    got = session_sequences(df, build_events=build, block_rows=50).collect()
    assert {r["session_id"]: (r["piece"], r["n_events"], r["sequence"]) for r in got} == {k: (0, len(v), " ".join(v)) for k, v in want.items()}
    assert len(got) == len(want)


@pytest.mark.parametrize("block", [10, 17, 8192])
def test_windows_over_block_borders(spark, block):
    sizes = {"a": 200, "b": 10, "c": 9, "d": 1}
    rows = [(f, i, f"{f}{i}") for f, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "file string, line_no bigint, value string").repartition(3)
    out = windows.sliding_windows(df, block_lines=block, carry=["value"])
    got = sorted((r["file"], r["line_no"], r["value"], r["value_window"]) for r in out.collect())
    want = [(f, i, f"{f}{i}", [f"{f}{j}" for j in range(i, i + 10)]) for f, n in sizes.items() for i in range(n - 9)]
    assert got == sorted(want)
    short = {(r["file"], r["n_lines"]) for r in windows.short_files(df).collect()}
    assert short == {("c", 9), ("d", 1)}


def test_window_keeps_missing_values(spark):
    df = spark.createDataFrame([("f", i, None if i == 1 else f"v{i}") for i in range(3)], "file string, line_no bigint, value string")
    out = windows.sliding_windows(df, size=3).select(windows.joined("value_window").alias("s"), "value_window").first()
    assert out["value_window"] == ["v0", None, "v2"] and out["s"] == "v0 v2"


@pytest.mark.parametrize("kind", ["spread", "ties", "one", "two", "tail"])
def test_quantiles(spark, kind):
    import numpy as np

    rng = np.random.default_rng(5)
    x = {
        "spread": rng.normal(size=5000),
        "ties": rng.integers(0, 4, size=3000).astype(float),
        "one": np.array([2.5]),
        "two": np.array([1.0, 9.0]),
        "tail": np.r_[np.zeros(2000), rng.exponential(size=500)],
    }[kind]
    ps = [0.0, 0.01, 0.1, 0.35, 0.5, 0.8, 0.999, 1.0]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    for accuracy in (100, 100_000):
        got = exact_quantiles(df, "x", ps, accuracy)
        np.testing.assert_allclose(got, np.quantile(x, ps), rtol=1e-12, atol=1e-12)
