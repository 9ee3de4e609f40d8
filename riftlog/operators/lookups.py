"""Joining a large table to a lookup table whose size is checked first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

MAX_ROWS = 200_000
MAX_BYTES = 64 << 20
# A broadcast passes the driver, which holds it several times over while it is built, and
# a job has many of them: so tables are broadcast up to a smaller size.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 8 << 20
SALTS = 32


def is_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Whether ``df`` is proven to fit a broadcast: counts rows and bytes of text
    form, looking at no more than ``max_rows`` + 1 rows."""
    size = (
        df.limit(max_rows + 1)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(F.length(F.to_json(F.struct(*df.columns)))), F.lit(0)).alias("b"),
        )
        .first()
    )
    return size["n"] <= max_rows and size["b"] <= max_bytes


def _splits_skew(spark: SparkSession) -> bool:
    """Whether the session itself splits the partitions of hot keys of a join."""
    keys = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(spark.conf.get(k, "true").lower() == "true" for k in keys)


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread_by: Sequence[str] | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``rows`` to ``table`` (``how``: inner, left, left_semi, left_anti).

    A table of proven small size is broadcast. Beyond that, both sides move once, and
    the partition of a key that holds a large share of all rows is split by adaptive
    execution, which copies the table's part of that partition alone. In a session that
    has this turned off, rows of one key are spread over ``salts`` tasks by a hash of
    ``spread_by`` and the table is copied to each."""
    on = list(on)
    if is_small(table, max_rows, max_bytes):
        return rows.join(F.broadcast(table), on, how)
    if _splits_skew(rows.sparkSession):
        return rows.join(table, on, how)
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64(*(spread_by or rows.columns)), F.lit(salts)).cast("int")
    return rows.withColumn("_salt", salt).join(copies, [*on, "_salt"], how).drop("_salt")
