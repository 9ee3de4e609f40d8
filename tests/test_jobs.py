"""Quality, run log, streams and whole jobs."""

import pytest
from pyspark.sql import functions as F, types as T

from riftlog.config import Layout
from riftlog.operators import quality, runs, templates as tpl
from riftlog.operators.autoencoder import layer_sizes
from riftlog.operators.scoring import (
    EncoderModel, ForestModel, KMeansModel, score_encoder, score_forest, score_kmeans, scoring_windows, with_unit,
)
from riftlog.plans import batch
from riftlog.session import scratch_root
from riftlog.sources import messages, text_logs
from riftlog.sources.event_lines import event_lines
from riftlog.sources.models import load_model
from riftlog.functions.parsing import parse_lines
from riftlog.streaming import jobs, templates as learning

SF = "/root/testdata/sf0.001"


def test_gate(spark):
    df = spark.createDataFrame([("1", 2.0), ("x", None)], "a string, b double")
    report = quality.validate(df, quality.schema_suite({"a": "int", "b": "double", "gone": "int"}))
    rows = {(r["column"], r["rule"]): (r["failed"], r["success"], r["severity"]) for r in report.collect()}
    assert rows[("a", "type")] == (1, False, "error")
    assert rows[("gone", "exists")] == (1, False, "warning")
    with pytest.raises(quality.ValidationError, match="a: type"):
        quality.gate(report)
    fine = quality.validate(df, quality.schema_suite({"b": "double", "gone": "int"}))
    assert quality.gate(fine) is fine


def test_mean_impute(spark):
    df = spark.createDataFrame([(1, None, "p"), (3, 4.0, None), (None, 6.0, "q")], "a int, b double, c string")
    assert sorted(map(tuple, quality.mean_impute(df).collect())) == [(1.0, 5.0, "p"), (2.0, 6.0, "q"), (3.0, 4.0, None)]


def test_quality_job(spark, tmp_path):
    (tmp_path / "in.csv").write_text('t1,INFO,c,7,"a, b"\nt2,INFO,c,,m\nt3,WARN,d,9,n\n')
    schema = T.StructType([T.StructField(c, T.LongType() if c == "PID" else T.StringType()) for c in quality.EXPECTED_TYPES])
    out = batch.run_quality(spark, str(tmp_path / "in.csv"), schema, str(tmp_path / "out"))
    rows = spark.read.option("header", True).csv(out).orderBy("Timestamp").collect()
    assert [r["PID"] for r in rows] == ["7.0", "8.0", "9.0"] and rows[0]["Message"] == "a, b"


def test_quality_job_keeps_the_report_of_a_failure(spark, tmp_path):
    (tmp_path / "in.csv").write_text("t1,INFO,c,seven,m\n")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in quality.EXPECTED_TYPES])
    with pytest.raises(quality.ValidationError):
        batch.run_quality(spark, str(tmp_path / "in.csv"), schema, str(tmp_path / "out"), reports=str(tmp_path / "reports"))
    report = spark.read.parquet(f"{tmp_path}/reports/*").where("NOT success").collect()
    assert [(r["column"], r["rule"], r["failed"]) for r in report] == [("PID", "type", 1)] and not (tmp_path / "out").exists()


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "yarn"
        def getCheckpointDir(self): return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        scratch_root(Session())


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    runs.append_run(runs.run_rows(spark, "r1", {"k": 5}, {"s": 0.25}, {"train_loss": [2, 1], "val_loss": [3, 2]}, {"at": "x"}), path)
    runs.append_run(runs.run_rows(spark, "r2", metrics={"s": 0.5}), path)
    table = spark.read.parquet(path)
    curve = [tuple(r) for r in runs.loss_curve(table).collect()]
    assert curve == [("r1", 0, 2.0, 3.0), ("r1", 1, 1.0, 2.0)]
    scores = spark.createDataFrame([(0, 1.0), (1, 3.0), (2, 3.0), (3, None)], "run_no int, score double")
    assert runs.best_run(scores, "run_no", "score").first()["run_no"] == 1


def lines_of(spark):
    return event_lines(spark.read.parquet(f"{SF}/events.parquet"))


def parsed_stream(spark, path):
    rows = parse_lines(spark.readStream.text(path))
    return rows.select("message", F.unix_micros(F.expr("cast(`timestamp` as timestamp)")).alias("line_no"))


def test_streamed_templates_equal_batch_and_survive_restart(spark, tmp_path):
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    lines = lines_of(spark)

    def run():
        learning.learn_templates(parsed_stream(spark, source)).writeStream.foreachBatch(
            lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch={n}")
        ).outputMode("update").option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
        return learning.current(spark.read.parquet(out).drop("batch")).collect()

    for part in range(2):
        half = lines.filter((F.col("line_no") >= 500) == F.lit(bool(part)))
        half.coalesce(1).select("value").write.mode("append").text(source)
        got = run()
    assert sorted(map(str, run())) == sorted(map(str, got))
    shapes = tpl.distinct_shapes(tpl.with_shape(parse_lines(lines)))
    want = tpl.mine_versions(shapes).filter("is_current").collect()
    assert sorted(r["template"] for r in got) == sorted(r["template"] for r in want)


def test_retrain_watch(spark, tmp_path):
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    spark.createDataFrame([('{"message":"retrain_model"}',), ('{"message":"other"}',)], "value string").write.text(source)
    messages.append_update(spark, source, {"a": "b"}, "2024-01-01")
    messages.append_update(spark, source)
    jobs.watch_retrain(spark, source, out, mark).awaitTermination()
    assert [r["body"] for r in spark.read.parquet(out).collect()] == ['{"message":"retrain_model"}']
    assert spark.read.text(source).filter(F.col("value").contains('"extra":{"a":"b"}')).count() == 1


def test_whole_chain(spark, tmp_path):
    layout = Layout(str(tmp_path))
    text_logs.write_log(lines_of(spark), layout.raw, files=3)
    trials = [{"run_no": 0, "n_trees": 20, "contamination": 0.05, "max_samples": "auto"}]
    out = batch.run_batch(
        spark, layout, {"kmeans": {"seeds": (0, 1)}, "encoder": {"epochs": 3}, "forest": {"trials": trials}}
    )
    assert spark.read.parquet(layout.structured).count() + spark.read.parquet(layout.rejects).count() == 1000
    tagged = spark.read.parquet(layout.tagged)
    assert tagged.filter("log_key = 'UNMAPPED'").count() == 0
    events = spark.read.parquet(layout.sequences).agg(F.sum("n_events")).first()[0]
    assert events == tagged.filter("request_id is not null and log_key is not null").count()
    log = spark.read.parquet(layout.runs)
    best = batch.best_model(log, {"kmeans": "best_silhouette_score", "encoder": "silhouette_score", "forest": "avg_anomaly_score"})
    assert {r["kind"] for r in best.collect()} == {"kmeans", "encoder", "forest"}
    assert spark.read.text(layout.updates).count() == 1

    upload = tmp_path / "upload"
    upload.mkdir()
    text = [r["message"] for r in tagged.filter("message is not null").orderBy("line_no").limit(40).collect()]
    (upload / "a.log").write_text("\n\n".join(f"  {t} " for t in text))
    (upload / "b.log").write_text("\n".join(text[:9]))
    lines = text_logs.read_upload(spark, str(upload))
    wins = scoring_windows(with_unit(lines, "template", out["templates"]))
    assert wins.count() == 31
    assert [r[0] for r in wins.orderBy("line_no").select("window_start_line").collect()] == text[:31]
    for kind, cls, score, columns in (
        ("kmeans", KMeansModel, score_kmeans, {"window_start_line", "cluster", "anomaly_score", "is_anomaly"}),
        ("forest", ForestModel, score_forest, {"window_start_line", "anomaly_score", "is_anomaly"}),
        ("encoder", EncoderModel, score_encoder, {"log_window_start", "cluster", "anomaly_score"}),
    ):
        fresh = score(wins, out[kind])
        assert set(fresh.columns) == columns | {"file", "line_no"}
        loaded = score(wins, load_model(spark, cls, layout.model(kind)))
        a = {r["line_no"]: r["anomaly_score"] for r in fresh.collect()}
        b = {r["line_no"]: r["anomaly_score"] for r in loaded.collect()}
        assert a == pytest.approx(b) and len(a) == 31
    assert out["encoder"].network.sizes == layer_sizes(out["encoder"].tfidf.dim)

    scores, mark = str(tmp_path / "scores"), str(tmp_path / "mark")
    for _ in range(2):
        jobs.score_arrivals(
            spark, str(upload), lambda w: score_kmeans(w, out["kmeans"]), scores, mark, templates=out["templates"]
        ).awaitTermination()
    assert spark.read.parquet(scores).count() == 31
