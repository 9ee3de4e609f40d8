"""Tables between steps: Parquet by default, CSV and JSON for exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riftlog.operators.lookups import is_small

STRUCTURED = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("pid", T.LongType()),
        T.StructField("level", T.StringType()),
        T.StructField("component", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)
TEMPLATES = T.StructType(
    [T.StructField("log_key", T.StringType()), T.StructField("template", T.StringType())]
)
SEQUENCES = T.StructType(
    [T.StructField("session_id", T.StringType()), T.StructField("sequence", T.StringType())]
)

# Quotes are doubled inside a quoted field; blanks at the ends of a field count.
_CSV = {
    "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


class MissingColumnError(ValueError):
    pass


class EmptyInputError(ValueError):
    pass


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Stop before any work when a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnError(f"missing columns {missing}; found {df.columns}")
    return df


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Stop when there is nothing to work on; reads at most one row."""
    if df.isEmpty():
        raise EmptyInputError(f"{what} has no rows")
    return df


def read_spread(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table ahead of costly work per row. Where its files give fewer
    splits than the cluster has slots, rows are dealt out over all slots first; a
    large table has more splits than that and is read where it lies."""
    df = spark.read.parquet(path)
    slots = spark.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True, multiline: bool = True
) -> DataFrame:
    """CSV with a declared schema. Fields may hold line breaks, so a file is read as a
    whole; ``multiline=False`` reads large files in splits where no field holds one, as in
    tables of log lines."""
    return (
        spark.read.schema(schema)
        .options(**_CSV)
        .option("multiLine", multiline)
        .option("header", header)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    df.write.options(**_CSV).option("header", header).mode("errorifexists").csv(path)
    return path


def write_version(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> str:
    """Write to a fresh directory below ``path`` and return it. A table may so be
    rewritten from itself: readers of the old version are not disturbed.
    ``single_file`` is for exports, since one task then writes everything: a table
    that is not proven small is computed by all tasks first and streamed through it."""
    version = f"{path.rstrip('/')}/v={uuid.uuid4().hex}"
    out = df
    if single_file:
        out = df.coalesce(1) if is_small(df) else df.repartition(1)
    writer = out.write
    if fmt == "csv":
        writer = writer.options(**_CSV).option("header", True)
    writer.format(fmt).save(version)
    return version


DAY = "event_date"


def write_days(df: DataFrame, path: str, day: str = DAY) -> str:
    """Write rows by date. Dates that ``df`` has rows of replace what was there; all others
    stay as they are, so a job can be run again for a date. Rows of one date and task are
    one file; null is a date of its own."""
    df.write.partitionBy(day).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    return path


def read_days(spark: SparkSession, path: str, first=None, last=None, day: str = DAY) -> DataFrame:
    """The rows of the dates from ``first`` to ``last``; other dates are not looked at."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.filter(F.col(day) >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.filter(F.col(day) <= F.lit(last).cast("date"))
    return rows


def by_source(df: DataFrame, order: str = "line_no", column: str = "source") -> DataFrame:
    """Rows range-partitioned and sorted by source, then by line. The line is part
    of the range key, so one busy source is cut over many partitions."""
    return df.repartitionByRange(column, order).sortWithinPartitions(column, order)


def as_json(df: DataFrame, name: str = "body") -> DataFrame:
    """Rows as JSON text, with missing values written out."""
    return df.select(
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name)
    )


def from_json(df: DataFrame, schema: T.StructType, name: str = "body") -> DataFrame:
    return df.select(F.from_json(name, schema).alias("_r")).select("_r.*")
