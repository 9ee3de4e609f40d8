"""Reading and writing raw log text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riftlog.functions.parsing import strip
from riftlog.operators.lookups import lookup_join
from riftlog.session import settle

#: File splits whose line counts may be broadcast, and the size of such a row as text.
SPLITS, SPLIT_BYTES = 4_000_000, 256


def _raw(reader, path) -> DataFrame:
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        "value",
    )


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with the file and the file split they come from."""
    return _raw(spark.read, path)


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same over files as they arrive."""
    return _raw(spark.readStream, path)


def strip_blank(lines: DataFrame) -> DataFrame:
    """Strip each line and leave out the blank ones."""
    return lines.withColumn("value", strip(F.col("value"))).filter(F.length("value") > 0)


def number_lines(scanned: DataFrame, one_log: bool = False) -> DataFrame:
    """Add gap-free 0-based ``line_no`` per file, or, with ``one_log``, across all
    files in name order.

    No line is shuffled: a split lies within one partition, in order, so a first
    pass counts the lines of each split and the second adds the counts of the
    splits before it to the place inside the split."""
    marked = scanned.withColumn("_id", F.monotonically_increasing_id())
    order = Window.orderBy("file", "split_start") if one_log else (
        Window.partitionBy("file").orderBy("split_start")
    )
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    splits = (
        marked.groupBy("file", "split_start")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .select(
            "file", "split_start", "_first", (F.sum("_n").over(until) - F.col("_n")).alias("_before")
        )
    )
    # One short row per split: settled, so that it is computed once, and broadcast up
    # to some hundreds of terabytes of log, so that no line moves.
    numbered = lookup_join(
        marked, settle(splits, "splits"), ["file", "split_start"], "inner", spread_by=["_id"],
        max_rows=SPLITS, max_bytes=SPLITS * SPLIT_BYTES,
    )
    return numbered.select(
        "file", (F.col("_before") + F.col("_id") - F.col("_first")).alias("line_no"), "value"
    )


def read_log(spark: SparkSession, path: str | list[str], one_log: bool = False) -> DataFrame:
    """One record per line: ``file, line_no, value``."""
    return number_lines(scan_lines(spark, path), one_log)


def read_upload(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Logs handed in for scoring: stripped, blank lines dropped, then numbered."""
    return number_lines(strip_blank(scan_lines(spark, path)))


def write_log(lines: DataFrame, path: str, files: int | None = None) -> None:
    """Write ``value`` as text files whose name order is the order of ``line_no``."""
    ranged = (
        lines.repartitionByRange(files, "line_no") if files else lines.repartitionByRange("line_no")
    )
    ranged.sortWithinPartitions("line_no").select("value").write.text(path)
