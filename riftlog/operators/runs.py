"""Run log: parameters, metrics and losses of training runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riftlog.config import PATIENCE

RUN_SCHEMA = "run_id string, kind string, key string, step int, value string"


def run_rows(
    spark: SparkSession,
    run_id: str,
    params: dict | None = None,
    metrics: dict | None = None,
    losses: dict[str, list[float]] | None = None,
    tags: dict | None = None,
) -> DataFrame:
    """One row per parameter, metric, tag and loss step of a run."""
    rows = [(run_id, "param", k, None, str(v)) for k, v in (params or {}).items()]
    rows += [(run_id, "metric", k, None, repr(float(v))) for k, v in (metrics or {}).items()]
    rows += [
        (run_id, "metric", k, i, repr(float(v)))
        for k, vs in (losses or {}).items()
        for i, v in enumerate(vs)
    ]
    rows += [(run_id, "tag", k, None, str(v)) for k, v in (tags or {}).items()]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def append_run(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def loss_curve(runs: DataFrame, keys=("train_loss", "val_loss")) -> DataFrame:
    """``run_id, step`` with one column per loss, in order of steps."""
    return (
        runs.filter((F.col("kind") == "metric") & F.col("key").isin(*keys) & F.col("step").isNotNull())
        .groupBy("run_id", "step")
        .pivot("key", list(keys))
        .agg(F.max(F.expr("try_cast(value as double)")))
        .orderBy("run_id", "step")
    )


def best_run(runs: DataFrame, run: str, score: str, params: tuple[str, ...] = ()) -> DataFrame:
    """The run of the highest score, the first of equals; missing scores lose."""
    rank = F.struct(F.col(score), -F.col(run).cast("bigint"))
    kept = F.struct(F.col(run), F.col(score), *[F.col(p) for p in params])
    return runs.agg(F.max_by(kept, rank).alias("_best")).select("_best.*")


def early_stop(losses: DataFrame, patience: int = PATIENCE, epoch: str = "epoch", loss: str = "val_loss"):
    """Where training would have stopped: ``stop_epoch`` is the first epoch with
    ``patience`` epochs without a new minimum behind it, or the last epoch, and
    ``best_epoch`` the epoch whose weights are kept.

    ``losses`` has one row per epoch of one run."""
    upto = Window.orderBy("e").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("e").rowsBetween(Window.unboundedPreceding, -1)
    marked = losses.select(F.col(epoch).alias("e"), F.col(loss).alias("l")).withColumn(
        "new", F.coalesce(F.col("l") < F.min("l").over(before), F.lit(True))
    )
    marked = marked.withColumn("last", F.max(F.when(F.col("new"), F.col("e"))).over(upto))
    stop = marked.agg(
        F.coalesce(F.min(F.when(F.col("e") - F.col("last") >= patience, F.col("e"))), F.max("e"))
    ).scalar()
    return (
        marked.withColumn("stop", stop)
        .filter(F.col("e") <= F.col("stop"))
        .agg(
            F.max("stop").alias("stop_epoch"),
            F.min_by("e", F.struct("l", "e")).alias("best_epoch"),
            F.min("l").alias("best_loss"),
        )
    )


class EarlyStop:
    """The same rule while training goes on, one loss at a time."""

    def __init__(self, patience: int = PATIENCE):
        self.patience, self.best, self.best_epoch, self.epoch = patience, float("inf"), -1, -1

    def update(self, loss: float) -> bool:
        """Note the loss of the next epoch; whether it is the best so far."""
        self.epoch += 1
        if loss < self.best:
            self.best, self.best_epoch = loss, self.epoch
            return True
        return False

    @property
    def stop(self) -> bool:
        return self.epoch - self.best_epoch >= self.patience
