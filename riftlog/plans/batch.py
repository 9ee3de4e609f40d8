"""Whole jobs: the batch chain from raw log to models, and the quality job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riftlog.config import EXPORT_EVENTS, SIMILARITY, Layout
from riftlog.functions.parsing import event_day, impute_request, line_matches, parse_lines
from riftlog.operators.profile import histogram, profile_report
from riftlog.operators.quality import EXPECTED_TYPES, gate, mean_impute, schema_suite, validate
from riftlog.operators.runs import append_run, best_run, run_rows
from riftlog.operators.sequences import session_sequences
from riftlog.operators.session_terms import session_terms
from riftlog.operators.templates import distinct_shapes, learn_more, mine_templates, tag_rows, template_text, with_shape
from riftlog.operators.training import train_encoder, train_forest, train_kmeans
from riftlog.sources.messages import append_update
from riftlog.sources.models import save_model
from riftlog.sources.tables import DAY, read_csv, require_columns, require_rows, write_days, write_version
from riftlog.sources.text_logs import read_log
from riftlog.session import path_exists, scratch_path, settle


def run_batch(spark: SparkSession, layout: Layout, train: dict | None = None) -> dict[str, object]:
    """Parse, profile and clean, mine templates, tag, build sequences, train the
    three models, and note that they were updated. Each layer is written once as
    Parquet and read back by the next step. ``train`` may hold keyword arguments
    for each training (``kmeans``, ``forest``, ``encoder``)."""
    train = train or {}

    def stored(df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    # The log is numbered once; what follows reads the numbered lines by kind.
    numbered = read_log(spark, layout.raw, one_log=True)
    path = scratch_path(spark, "numbered")
    numbered.withColumn("matched", line_matches(F.col("value"))).write.partitionBy("matched").parquet(path)
    raw = spark.read.schema("file string, line_no bigint, value string, matched boolean").parquet(path)
    stored(raw.filter(~F.col("matched")).drop("matched"), layout.rejects)
    structured = stored(parse_lines(raw.filter("matched").drop("matched")), layout.structured)
    require_columns(structured, "request_id", "message")
    require_rows(structured.filter(F.col("message").isNotNull()), "structured log")

    stored(profile_report(structured.drop("file", "line_no")), f"{layout.reports}/profile")
    stored(histogram(structured.select("pid")), f"{layout.reports}/histogram")
    cleaned = stored(impute_request(structured), layout.cleaned)

    templates = stored(mine_templates(cleaned), layout.templates)
    tagged = stored(tag_rows(cleaned, templates), layout.tagged)
    texts = template_text(tagged, templates)
    # The text of a session is for export only, a long one in pieces; the models learn
    # from the words of the events, where no session need fit one value.
    sequences = stored(session_sequences(texts, piece_events=EXPORT_EVENTS), layout.sequences)
    sessions = session_terms(texts)

    out: dict[str, object] = {"templates": templates, "sequences": sequences}
    for kind, job in (("kmeans", train_kmeans), ("encoder", train_encoder), ("forest", train_forest)):
        model, log = job(sessions, kind, **train.get(kind, {}))
        path = save_model(spark, model, layout.model(kind))
        append_run(log.unionByName(run_rows(spark, kind, tags={"model_path": path})), layout.runs)
        out[kind] = model
    append_update(spark, layout.updates, {"models": ",".join(sorted(("kmeans", "encoder", "forest")))})
    return out


def run_days(spark: SparkSession, layout: Layout, lines: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Bring the layers up to date with more lines (``file, line_no, value``): parse them,
    let the templates go on learning, tag, and write structured and tagged rows by the date
    of their event. The dates of these lines are replaced, so a date may be run again; no
    other date is read or written. Returns the templates as they are then."""
    parsed = parse_lines(lines.filter(line_matches(F.col("value"))))
    structured = settle(parsed.withColumn(DAY, event_day()), "day")
    write_days(structured, layout.structured_days)
    cleaned = impute_request(structured)
    if path_exists(spark, layout.templates):
        known = settle(spark.read.parquet(layout.templates), "known-templates")
        templates = learn_more(known, distinct_shapes(with_shape(cleaned)), similarity)
    else:
        templates = mine_templates(cleaned, similarity)
    write_days(tag_rows(cleaned, templates), layout.tagged_days)
    templates.write.mode("overwrite").parquet(layout.templates)
    return spark.read.parquet(layout.templates)


def store_report(report: DataFrame, path: str) -> DataFrame:
    """Keep a validation report as a version below ``path``, and read it back."""
    return report.sparkSession.read.parquet(write_version(report, path))


def run_quality(
    spark: SparkSession, source: str, schema, out: str, expected: dict[str, str] = EXPECTED_TYPES,
    reports: str | None = None, multiline: bool = False,
) -> str:
    """Read a table without header, check it, store the report (below ``reports``, by
    default ``<out>-reports``), fill missing numbers with their mean, and write it.
    Stops before the write if a check fails; the report is then there to read."""
    df = read_csv(spark, source, schema, header=False, multiline=multiline)
    gate(store_report(validate(df, schema_suite(expected)), reports or f"{out.rstrip('/')}-reports"))
    return write_version(mean_impute(df), out, "csv")


def best_over_kinds(runs: DataFrame, metric: dict[str, str]) -> DataFrame:
    """The one best run over all kinds of model. Scores of different kinds are no common
    measure; how far the best stands out among the runs of its kind is: ``lead``, its
    distance from their mean in standard deviations (0 for a kind with one run or equal
    ones). Of equal leads the kind with more runs wins, then the first by name."""
    best = best_model(runs, metric)
    names = F.create_map(*[F.lit(x) for pair in metric.items() for x in pair])
    kind = F.split("run_id", "/")[0]
    scores = runs.filter(F.col("key") == F.get(F.array(names[kind]), F.lit(0))).select(kind.alias("kind"), F.expr("try_cast(value as double)").alias("score"))
    spread = scores.groupBy("kind").agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("deviation"), F.count("score").alias("n_runs"))
    lead = F.when(F.col("deviation") > 0, (F.col("score") - F.col("mean")) / F.col("deviation")).otherwise(F.lit(0.0))
    # One row per kind.
    return best.join(spread, "kind").withColumn("lead", lead).orderBy(F.desc("lead"), F.desc("n_runs"), "kind").limit(1).select("kind", "run_id", "score", "lead")


def best_model(runs: DataFrame, metric: dict[str, str]) -> DataFrame:
    """The best run of each kind of model. ``metric`` names the score of each kind,
    as scores of different kinds cannot be compared."""
    out = None
    for kind, key in metric.items():
        scores = runs.filter(
            (F.col("key") == key) & F.split("run_id", "/")[0].eqNullSafe(kind)
        ).select(
            "run_id",
            F.expr("try_cast(value as double)").alias("score"),
            F.coalesce(
                F.get(F.split("run_id", "/"), F.lit(1)).try_cast("bigint"), F.lit(0)
            ).alias("run_no"),
        )
        one = best_run(scores, "run_no", "score", ("run_id",)).withColumn("kind", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    return out
