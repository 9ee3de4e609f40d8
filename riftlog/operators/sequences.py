"""One ordered event sequence per session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riftlog.operators.lookups import lookup_join
from riftlog.operators.positions import BLOCK_ROWS, with_positions
from riftlog.session import settle

#: Events of a long session that one task puts in order.
BUILD_EVENTS = 10_000


def _in_order(order: str, text: str) -> Column:
    events = F.array_sort(F.collect_list(F.struct(order, text)))
    return F.array_join(events[text], " ")


def session_sequences(
    rows: DataFrame,
    key: str = "request_id",
    order: str = "line_no",
    text: str = "template",
    piece_events: int | None = None,
    build_events: int = BUILD_EVENTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``session_id, piece, n_events, sequence``: the texts of each session in
    order, joined by blanks. Rows without a session or a text are skipped.

    A session is one row with ``piece`` 0, whatever its length (up to the 2 GB that a
    value can hold): a long one, such as the system session that takes all unnamed
    requests, is put in order in parts of ``build_events`` events, and one aggregate
    joins its ordered parts. A caller who wants bounded rows names ``piece_events``:
    longer sessions then come in pieces of exactly that many events."""
    whole, piece_events = piece_events is None, piece_events or build_events
    kept = rows.select(
        F.col(key).alias("session_id"), F.col(order).alias("_order"), F.col(text).alias("_text")
    ).dropna()
    long_ones = settle(
        kept.groupBy("session_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > piece_events)
        .select("session_id"),
        "long-sessions",
    )
    if long_ones.isEmpty():
        return (
            kept.groupBy("session_id")
            .agg(F.count(F.lit(1)).alias("n_events"), _in_order("_order", "_text").alias("sequence"))
            .select("session_id", F.lit(0).cast("bigint").alias("piece"), "n_events", "sequence")
        )
    spread = ["_order"]
    hot = with_positions(
        lookup_join(kept, long_ones, ["session_id"], "left_semi", spread),
        "_order", ["session_id"], block_rows,
    ).withColumn("piece", F.floor(F.col("pos") / piece_events)).drop("pos")
    cold = lookup_join(kept, long_ones, ["session_id"], "left_anti", spread).withColumn(
        "piece", F.lit(0).cast("bigint")
    )
    pieces = lambda df: df.groupBy("session_id", "piece").agg(
        F.count(F.lit(1)).alias("n_events"), _in_order("_order", "_text").alias("sequence")
    )
    if not whole:
        return pieces(cold.unionByName(hot))
    joined = pieces(hot).groupBy("session_id").agg(
        F.lit(0).cast("bigint").alias("piece"), F.sum("n_events").alias("n_events"), _in_order("piece", "sequence").alias("sequence")
    )
    return pieces(cold).unionByName(joined)
