"""Overlapping windows of consecutive lines, and context around a line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from riftlog.config import WINDOW_LINES

BLOCK_LINES = 1 << 13


def sliding_windows(
    lines: DataFrame,
    keys: Sequence[str] = ("file",),
    order: str = "line_no",
    collect: Sequence[str] = ("value",),
    carry: Sequence[str] = (),
    size: int = WINDOW_LINES,
    block_lines: int = BLOCK_LINES,
) -> DataFrame:
    """Every run of ``size`` consecutive lines of a file, moving by one line.

    ``order`` numbers the lines of each file without gaps. Each column of
    ``collect`` becomes an array of the window's values; columns of ``carry`` are
    those of its first line. A file is cut into blocks of ``block_lines`` lines,
    and a block also gets the first ``size`` - 1 lines of the next one, so one
    huge file is spread over many tasks and no window is lost at a cut."""
    keys = list(keys)
    number = F.col(order)
    block = F.floor(number / block_lines)
    belongs = F.when(
        (F.pmod(number, F.lit(block_lines)) < size - 1) & (block > 0), F.array(block, block - 1)
    ).otherwise(F.array(block))
    columns = list(dict.fromkeys([*keys, order, *collect, *carry]))
    # Windows are many times the size of the lines they come from, so the number of
    # partitions is the configured one, not one made to fit the lines.
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = lines.select(*columns, F.explode(belongs).alias("_block")).repartition(
        parts, *keys, "_block"
    )
    frame = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(0, size - 1)
    arrays = {f"{c}_window": F.collect_list(F.struct(c)).over(frame) for c in collect}
    full = F.size(f"{collect[0]}_window") == size
    return (
        placed.withColumns(arrays)
        .filter((F.floor(number / block_lines) == F.col("_block")) & full)
        .select(
            *keys,
            order,
            *[c for c in carry if c not in (*keys, order)],
            *[F.col(f"{c}_window")[c].alias(f"{c}_window") for c in collect],
        )
    )


def joined(window: str):
    """A window's values as one text; missing values are skipped."""
    return F.array_join(window, " ")


def short_files(
    lines: DataFrame, keys: Sequence[str] = ("file",), size: int = WINDOW_LINES
) -> DataFrame:
    """Files with too few lines for one window, and their line counts."""
    return (
        lines.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .filter(F.col("n_lines") < size)
    )


def context_payload(windows: DataFrame, window: str = "value_window") -> DataFrame:
    """The suspicious line with its window, as JSON text, one per window."""
    return windows.withColumn(
        "payload",
        F.to_json(
            F.struct(
                F.element_at(window, 1).alias("anomaly_line"), F.col(window).alias("log_window")
            )
        ),
    )


def context_slice(lines, start, size: int = WINDOW_LINES):
    """The context of the line at 1-based ``start`` of an array of lines."""
    return F.slice(lines, start, size)
