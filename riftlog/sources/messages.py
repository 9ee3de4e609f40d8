"""Messages about models: "a model was updated" and "please retrain"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riftlog.config import RETRAIN_MESSAGE, UPDATE_TASK, UPDATED_MESSAGE


def update_body(timestamp: Column, extra: Column) -> Column:
    """JSON text of a model-updated message; ``extra`` is a map of strings."""
    return F.to_json(
        F.struct(
            F.lit(UPDATE_TASK).alias("task"),
            timestamp.alias("timestamp"),
            extra.alias("extra"),
            F.lit(UPDATED_MESSAGE).alias("message"),
        )
    )


def append_update(
    spark: SparkSession, path: str, extra: dict[str, str] | None = None, at: str | None = None
) -> None:
    """Append one model-updated message to the message table at ``path``."""
    extra = extra or {}
    pairs = [F.lit(x) for kv in extra.items() for x in kv]
    mapped = F.create_map(*pairs) if pairs else F.from_json(F.lit("{}"), "map<string,string>")
    stamp = F.lit(at) if at else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    spark.range(1).select(update_body(stamp, mapped).alias("body")).write.mode("append").text(path)


def retrain_requests(messages: DataFrame, body: str = "body") -> DataFrame:
    """Messages that ask for a new training run."""
    return messages.filter(F.contains(F.col(body), F.lit(RETRAIN_MESSAGE)))
