"""Jobs over arriving files: scoring uploads, and picking out retrain requests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from riftlog.operators.scoring import scoring_windows, with_unit
from riftlog.session import passing_scratch
from riftlog.sources.messages import retrain_requests
from riftlog.sources.text_logs import number_lines, stream_lines, strip_blank


def score_arrivals(
    spark: SparkSession,
    path: str,
    score: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    unit: str = "template",
    templates: DataFrame | None = None,
    learn: bool = False,
) -> StreamingQuery:
    """Score each uploaded log when it arrives and append the result to the table
    at ``out``. A file belongs to one micro-batch as a whole, so its windows need
    no state. Batches carry their number, and a batch that is run again after a
    failure replaces its own earlier rows. With ``learn``, ``templates`` go on
    learning from the files of a batch before its windows are formed."""

    def one(batch: DataFrame, number: int) -> None:
        with passing_scratch(spark):
            lines = number_lines(strip_blank(batch))
            windows = scoring_windows(with_unit(lines, unit, templates, learn=learn))
            score(windows).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        stream_lines(spark, path)
        .writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def watch_retrain(
    spark: SparkSession, path: str, out: str, checkpoint: str
) -> StreamingQuery:
    """Copy messages that ask for a new training run to the table at ``out``; what
    is done about them is up to the caller."""
    messages = spark.readStream.text(path).select(F.col("value").alias("body"))
    return (
        retrain_requests(messages)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
