"""Expectations on a table, their report, the gate, and mean imputation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from riftlog.operators.profile import numeric_columns

# The expected columns of a structured log and their types.
EXPECTED_TYPES = {
    "Timestamp": "string",
    "LogLevel": "string",
    "Component": "string",
    "PID": "bigint",
    "Message": "string",
}


class ValidationError(ValueError):
    pass


@dataclass(frozen=True)
class Expectation:
    """``exists``: the column is there. ``type``: it has type ``dtype``, or is text
    whose every present value reads as one. ``severity`` is what a failure means:
    ``error`` stops the gate, ``warning`` is only reported."""

    column: str
    rule: str
    dtype: str | None = None
    severity: str = "error"


def schema_suite(expected: dict[str, str] = EXPECTED_TYPES) -> list[Expectation]:
    """A type rule per column; a column that is missing is only a warning."""
    return [
        e
        for column, dtype in expected.items()
        for e in (
            Expectation(column, "exists", severity="warning"),
            Expectation(column, "type", dtype),
        )
    ]


def validate(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One row per rule: ``column, rule, expected, failed, success, severity``.

    Rules the schema answers cost nothing; the others share one aggregate over
    one scan. A type rule on a missing column is left to its ``exists`` rule."""
    types = {f.name: f.dataType for f in df.schema.fields}
    rows, metrics = [], []
    for e in suite:
        present = e.column in types
        if e.rule == "exists":
            failed = F.lit(0 if present else 1)
        elif not present:
            continue
        elif types[e.column].simpleString() == e.dtype:
            failed = F.lit(0)
        elif isinstance(types[e.column], T.StringType):
            cast = F.expr(f"try_cast(`{e.column}` as {e.dtype})")
            metrics.append(
                F.count_if(F.col(e.column).isNotNull() & cast.isNull()).alias(f"m{len(metrics)}")
            )
            failed = F.col(f"m{len(metrics) - 1}")
        else:
            metrics.append(F.count(e.column).alias(f"m{len(metrics)}"))
            failed = F.col(f"m{len(metrics) - 1}")
        failed = failed.cast("bigint")
        rows.append(
            F.struct(
                F.lit(e.column).alias("column"),
                F.lit(e.rule).alias("rule"),
                F.lit(e.dtype).cast("string").alias("expected"),
                failed.alias("failed"),
                (failed == 0).alias("success"),
                F.lit(e.severity).alias("severity"),
            )
        )
    base = df.agg(*metrics) if metrics else df.sparkSession.range(1)
    return base.select(F.inline(F.array(*rows)))


def gate(report: DataFrame) -> DataFrame:
    """Pass the report on, or stop if a rule of severity ``error`` failed. The
    report has one row per rule of the suite."""
    bad = report.filter(~F.col("success") & (F.col("severity") == "error")).collect()
    if bad:
        raise ValidationError(
            "; ".join(f"{r['column']}: {r['rule']} failed on {r['failed']} rows" for r in bad)
        )
    return report


def mean_impute(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing numbers become the mean of their column. All means come from one
    aggregate; each is a one-row subquery, so the rows themselves do not move."""
    columns = columns if columns is not None else numeric_columns(df)
    if not columns:
        return df
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("m")).scalar()
    return (
        df.withColumn("_m", means)
        .withColumns(
            {c: F.coalesce(F.col(c).cast("double"), F.col("_m").getField(c)) for c in columns}
        )
        .drop("_m")
    )
