"""Column expressions that read one log line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riftlog.config import IMPUTED_REQUEST, LINE_FIELDS, LINE_PATTERN, MISSING_REQUEST

# Anchored; '.' stops at a line feed only, and the tail eats whatever follows it.
_ANCHORED = "(?d)^" + LINE_PATTERN
_WHOLE = _ANCHORED + r"[\s\S]*$"
_MARK = "\u0001"
_N = len(LINE_FIELDS)

_EDGE_SPACE = "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F\\x85\\p{Z}]+"


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(text, f"^{_EDGE_SPACE}|{_EDGE_SPACE}$", "")


def line_matches(line: Column) -> Column:
    return line.rlike(_ANCHORED)


def line_fields(line: Column) -> Column:
    """The captured groups as an array, or an array of one when the line does not
    match.

    One regex pass writes all groups behind a marker that is then split; a line
    that itself holds the marker takes the slower way of one pass per group."""
    marked = F.regexp_replace(line, _WHOLE, _MARK.join(f"${i}" for i in range(1, _N + 1)))
    one_pass = F.split(marked, _MARK, _N)
    per_group = F.when(
        line_matches(line),
        F.array(*[F.regexp_extract(line, _ANCHORED, i) for i in range(1, _N + 1)]),
    ).otherwise(F.array(F.lit("")))
    return F.when(F.contains(line, F.lit(_MARK)), per_group).otherwise(one_pass)


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are costly to compute. As the output of a generator they
    are not merged into the filters and projections that use them, which would
    compute them again in each place."""
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(made)))


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines that match become typed columns beside the other columns of
    ``lines``; lines that do not match are left out (see ``rejected_lines``)."""
    others = [c for c in lines.columns if c != line]
    split_up = computed_once(lines, _f=line_fields(F.col(line))).filter(F.size("_f") == _N)
    at = {name: F.get(F.col("_f"), F.lit(i)) for i, name in enumerate(LINE_FIELDS)}
    return split_up.select(
        *others,
        at["source"].alias("source"),
        at["timestamp"].alias("timestamp"),
        at["pid"].try_cast("bigint").alias("pid"),
        at["level"].alias("level"),
        at["component"].alias("component"),
        F.nullif(at["request_id"], F.lit("")).alias("request_id"),
        F.nullif(at["message"], F.lit("")).alias("message"),
    )


def rejected_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    return lines.filter(~line_matches(F.col(line)))


def with_event_time(parsed: DataFrame) -> DataFrame:
    """Optional views on a parsed log: a typed time, the component without its
    trailing blank, and whether the request id looks like one."""
    request = F.col("request_id")
    return parsed.withColumns(
        {
            "event_ts": F.expr("try_cast(`timestamp` as timestamp_ntz)"),
            "component_trimmed": F.rtrim("component"),
            "request_id_valid": (request == MISSING_REQUEST) | request.startswith("req-"),
        }
    )


def event_day(column: str = "timestamp") -> Column:
    """The date of a line's time; null where the time cannot be read."""
    return F.expr(f"try_cast(try_cast(`{column}` AS timestamp_ntz) AS date)")


def impute_request(df: DataFrame, column: str = "request_id") -> DataFrame:
    """The placeholder id becomes the system session; missing ids stay missing."""
    value = F.col(column)
    return df.withColumn(
        column, F.when(value == MISSING_REQUEST, F.lit(IMPUTED_REQUEST)).otherwise(value)
    )
