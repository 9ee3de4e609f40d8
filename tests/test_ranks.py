"""Quantiles by counted ranges, and numbering in levels of blocks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riftlog.operators.positions import with_positions
from riftlog.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.013, 0.25, 0.5, 0.77, 0.999, 1.0]


def data():
    rng = np.random.default_rng(4)
    heavy = np.exp(rng.normal(0, 60, 500))
    return {
        "even": rng.random(700), "few values": rng.integers(0, 4, 600).astype(float), "one value": np.full(50, 3.5),
        "two rows": np.array([1.0, 2.0]), "one row": np.array([-7.0]), "heavy": np.concatenate([heavy, -heavy]),
        "near": 1.0 + np.arange(400) * np.spacing(1.0), "wide": np.array([-1.7e308, 1.7e308, 0.0, 1e-300, -5e-324, 5e-324] * 9),
        "ends": np.array([-math.inf, -1.0, 0.5, 2.0, 2.0, math.inf, math.inf]),
    }


@pytest.mark.parametrize("name", list(data()))
@pytest.mark.parametrize("accuracy, cells", [(100_000, 1024), (2, 3)])
def test_quantiles_equal_sorting(spark, name, accuracy, cells):
    x = data()[name]
    frame = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double").repartition(3)
    line = sorted(x.tolist())
    got = exact_quantiles(frame, "x", PROBABILITIES, accuracy, cells)
    for p, value in zip(PROBABILITIES, got):
        r = p * (len(line) - 1)
        a, b = line[math.floor(r)], line[math.ceil(r)]
        want = a if math.floor(r) == r else a + (b - a) * (r - math.floor(r))
        assert value == want or math.isclose(value, want, rel_tol=1e-12) or (math.isnan(want) and math.isnan(value))


def test_no_values(spark):
    assert exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5, 0.1]) == [None, None]


@pytest.mark.parametrize("block, fan", [(1 << 18, 1 << 15), (4, 2), (1, 3)])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_positions_of_sparse_orders(spark, block, fan, keys):
    rng = random.Random(block)
    top = 60 if block < 10 else 1 << 62
    rows = [(rng.choice("ab"), v) for v in rng.sample(range(-(top // 2), top // 2), 40)]
    frame = spark.createDataFrame(rows, "k string, v long").repartition(4)
    got = {(r["k"], r["v"]): r["p"] for r in with_positions(frame, "v", keys, block, "p", fan).collect()}
    for k, v in rows:
        assert got[k, v] == sum(w < v and (not keys or j == k) for j, w in rows)


def test_plan_has_no_window_over_all_rows(spark):
    plan = with_positions(spark.range(10).withColumn("v", F.col("id") * 10**9), "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1  # the sizes of the top level alone
