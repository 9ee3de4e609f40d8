"""Profile of a structured log: counts, missing values, histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from riftlog.config import HISTOGRAM_BINS, MISSING_REQUEST, TOP_VALUES


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; a missing value is a value of its own."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, k: int = TOP_VALUES) -> DataFrame:
    return value_counts(df, column).orderBy(F.desc("n"), F.asc_nulls_first("value")).limit(k)


def top_values_map(df: DataFrame, column: str, k: int = TOP_VALUES) -> DataFrame:
    """The top values folded into one map cell (at most ``k`` entries). A map
    holds no missing key, so that one is counted with the empty text."""
    named = top_values(df, column, k).groupBy(F.coalesce("value", F.lit("")).alias("value")).agg(F.sum("n").alias("n"))
    pair = F.struct(F.col("value").alias("key"), F.col("n").alias("value"))
    return named.agg(
        F.map_from_entries(F.sort_array(F.collect_list(pair))).alias("top")
    )


def id_profile(df: DataFrame, column: str = "request_id") -> DataFrame:
    """Missing, placeholder and repeated values of an id column, from its value
    counts, so that rows are combined before any shuffle."""
    n, value = F.col("n"), F.col("value")

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0))

    return value_counts(df, column).agg(
        total(value.isNull()).alias("null_count"),
        total(value == MISSING_REQUEST).alias("dash_count"),
        F.coalesce(F.bool_or(n > 1), F.lit(False)).alias("has_duplicates"),
    )


def column_summary(df: DataFrame) -> DataFrame:
    """One row per column: name, place, type, rows and missing values, in one
    aggregate over one scan."""
    types = dict(df.dtypes)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(i).alias("place"),
            F.lit(types[c]).alias("dtype"),
            F.col("_rows").alias("row_count"),
            F.col(c).alias("missing"),
        )
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*cells)))


def profile_report(df: DataFrame, id_column: str = "request_id") -> DataFrame:
    """The whole profile in long form: ``section, item, metric, value``."""
    def row(section, item, metric, value):
        return F.struct(
            F.lit(section).alias("section"),
            item.alias("item"),
            F.lit(metric).alias("metric"),
            value.cast("string").alias("value"),
        )

    summary = column_summary(df).select(
        F.inline(
            F.array(
                row("column", F.col("column"), "dtype", F.col("dtype")),
                row("column", F.col("column"), "missing", F.col("missing")),
                row("column", F.col("column"), "row_count", F.col("row_count")),
            )
        )
    )
    name = F.lit(id_column)
    ids = id_profile(df, id_column).select(
        F.inline(
            F.array(
                row("id", name, "null_count", F.col("null_count")),
                row("id", name, "dash_count", F.col("dash_count")),
                row("id", name, "has_duplicates", F.col("has_duplicates")),
            )
        )
    )
    top = top_values(df, id_column).select(
        F.lit("top").alias("section"),
        F.col("value").alias("item"),
        F.lit("n").alias("metric"),
        F.col("n").cast("string").alias("value"),
    )
    return summary.unionByName(ids).unionByName(top)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins of every numeric column: ``column, bin, low, high, n``.

    One pass for all ranges, one for all counts; rows are combined per bin before
    the shuffle. Empty bins are kept. A column with one single value gets the
    range half below to half above it."""
    columns = columns if columns is not None else numeric_columns(df)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, bin int, low double, high double, n bigint")
    x = {c: F.col(c).cast("double") for c in columns}
    edges = df.agg(
        *[F.min(x[c]).alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(x[c]).alias(f"hi_{i}") for i, c in enumerate(columns)],
    ).select(
        F.struct(
            *[
                F.struct(
                    F.when(F.col(f"lo_{i}") == F.col(f"hi_{i}"), F.col(f"lo_{i}") - 0.5)
                    .otherwise(F.col(f"lo_{i}")).alias("lo"),
                    F.when(F.col(f"lo_{i}") == F.col(f"hi_{i}"), F.col(f"hi_{i}") + 0.5)
                    .otherwise(F.col(f"hi_{i}")).alias("hi"),
                ).alias(f"c{i}")
                for i in range(len(columns))
            ]
        ).alias("edges")
    )
    ranged = df.select(*[x[c].alias(f"x_{i}") for i, c in enumerate(columns)], edges.scalar().alias("_e"))
    cells = []
    for i, c in enumerate(columns):
        lo, hi = F.col(f"_e.c{i}.lo"), F.col(f"_e.c{i}.hi")
        place = F.floor((F.col(f"x_{i}") - lo) / (hi - lo) * bins).cast("int")
        cells.append(
            F.struct(F.lit(c).alias("column"), F.least(place, F.lit(bins - 1)).alias("bin"))
        )
    counted = (
        ranged.select(F.inline(F.array(*cells)))
        .filter(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = edges.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"edges.c{i}.lo").alias("lo"),
                        F.col(f"edges.c{i}.hi").alias("hi"),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return frame.join(counted, ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
