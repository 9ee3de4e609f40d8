"""Layers by date, the run log, and scratch that goes with its batch."""

import os

from pyspark.sql import functions as F

from riftlog.config import Layout
from riftlog.operators.runs import run_rows
from riftlog.plans import batch
from riftlog.session import passing_scratch, settle
from riftlog.sources import tables


def lines(spark, days, first=0):
    rows = [
        ("a.log", first + i, f"nova.log 2017-05-{day:02d} 00:00:{i % 60:02d}.5 {i} INFO nova.x [req-{i % 3}] open file {word} now")
        for i, (day, word) in enumerate(days)
    ]
    return spark.createDataFrame(rows + [("a.log", first + 999, "no log line")], "file string, line_no long, value string")


def test_a_date_is_replaced_and_read_alone(spark, tmp_path):
    layout = Layout(str(tmp_path))
    words = ["alpha", "beta", "gamma"]
    first = batch.run_days(spark, layout, lines(spark, [(d, w) for d in (1, 2, 3) for w in words])).collect()
    assert len(first) == 1  # one template for all
    before = {r["line_no"] for r in tables.read_days(spark, layout.structured_days, "2017-05-01", "2017-05-01").collect()}
    # The second date again, with fewer lines, and a new one.
    again = batch.run_days(spark, layout, lines(spark, [(2, "delta"), (4, "alpha")], first=5000)).collect()
    assert [(r["log_key"], r["template"]) for r in again] == [(r["log_key"], r["template"]) for r in first]
    for path in (layout.structured_days, layout.tagged_days):
        got = {r["day"]: r["n"] for r in spark.read.parquet(path).groupBy(F.col(tables.DAY).cast("string").alias("day")).agg(F.count("*").alias("n")).collect()}
        assert got == {"2017-05-01": 3, "2017-05-02": 1, "2017-05-03": 3, "2017-05-04": 1}
    one = tables.read_days(spark, layout.structured_days, "2017-05-01", "2017-05-01")
    assert {r["line_no"] for r in one.collect()} == before
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and len(one.inputFiles()) >= 1
    assert tables.read_days(spark, layout.tagged_days, first="2017-05-03").filter("log_key = 'LG_KEY_1'").count() == 4


def test_best_over_kinds(spark):
    runs = None
    for kind, scores in {"a": [0.1, 0.1, 0.9], "b": [5.0, 6.0, 7.0], "c": [100.0]}.items():
        for i, s in enumerate(scores):
            one = run_rows(spark, f"{kind}/{i}", metrics={f"m_{kind}": s}, tags={"model_path": f"/models/{kind}"})
            runs = one if runs is None else runs.unionByName(one)
    best = batch.best_over_kinds(runs, {k: f"m_{k}" for k in "abc"}).collect()
    assert [(r["kind"], r["run_id"], r["score"]) for r in best] == [("a", "a/2", 0.9)]
    assert abs(best[0]["lead"] - (0.9 - 1.1 / 3) / (0.16 * 8 / 9) ** 0.5) < 1e-12


def test_scratch_goes_with_its_block(spark):
    outer = settle(spark.range(3), "kept")
    with passing_scratch(spark):
        inside = settle(spark.range(5), "passing")
        path = inside.inputFiles()[0].removeprefix("file://").removeprefix("file:")
        assert inside.count() == 5 and os.path.exists(path)
    assert not os.path.exists(path) and outer.count() == 3


def test_csv_in_splits_is_asked_for(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a\nb"), (2, "c")], "n long, text string")
    path = tables.write_csv(rows, str(tmp_path / "csv"))
    assert tables.read_csv(spark, path, rows.schema).count() == 2
    assert tables.read_csv(spark, path, rows.schema, multiline=False).count() == 3
