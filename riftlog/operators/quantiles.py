"""Exact quantiles of a large column."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

ACCURACY = 100_000
CELLS = 1024
_MOST = 1.7976931348623157e308


def _cell(x: Column, low: float, high: float, cells: int) -> Column:
    """The place of ``x`` among equal parts of the range; the ends stand alone, so each
    look narrows the range, whatever its values."""
    a, b = (v if math.isfinite(v) else math.copysign(_MOST, v) for v in (low, high))
    # Halves, as the width of the whole range may leave the floats.
    share = (x / 2 - a / 2) / max(b / 2 - a / 2, 5e-324)
    inner = F.least(F.lit(cells - 1), F.greatest(F.lit(0), F.floor(share * cells)))
    return F.when(x == low, -1).when(x == high, cells).otherwise(inner).cast("int")


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int = ACCURACY, cells: int = CELLS
) -> list[float | None]:
    """Quantiles with linear interpolation between ranks; missing values are left
    out.

    A sketch of fixed size gives, for each wanted rank, two values that enclose it, as its
    rank error is at most 1 / ``accuracy`` of the rows. Then the range between two such
    values is cut into ``cells`` parts and their values are counted (combined on the map
    side, so a pass moves some thousand numbers a task); the part that holds the rank is cut
    again, until it holds one value. A pass divides the values in question by about
    ``cells``: few passes find a rank among any number of rows, and no task ever holds more
    than counts."""
    x = df.select(F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull())
    slack = 3.0 / accuracy
    sides = [min(1.0, max(0.0, p + d)) for p in probabilities for d in (-slack, slack)]
    stats = x.agg(
        F.percentile_approx("x", sides, accuracy).alias("at"), F.count(F.lit(1)).alias("n")
    ).first()
    if not stats["n"]:
        return [None for _ in probabilities]
    ranks = [p * (stats["n"] - 1) for p in probabilities]
    open_ranks = {f(r) for r in ranks for f in (math.floor, math.ceil)}
    brackets = _apart(zip(stats["at"][::2], stats["at"][1::2]))
    known: dict[int, float] = {}
    while open_ranks:
        rows = sorted(_counts(x, brackets, cells), key=lambda r: (r["zone"], r["cell"]))
        upto = list(accumulate(r["c"] for r in rows))
        following = set()
        for rank in sorted(open_ranks):
            i = next(i for i, u in enumerate(upto) if rank < u)
            row = rows[i]
            if row["low"] == row["high"] or rank == upto[i] - row["c"]:
                known[rank] = row["low"]
            elif rank == upto[i] - 1:
                known[rank] = row["high"]
            else:
                following.add((row["low"], row["high"]))
        open_ranks -= known.keys()
        brackets = _apart(following)
    return [
        known[math.floor(r)] + (known[math.ceil(r)] - known[math.floor(r)]) * (r - math.floor(r)) if r != math.floor(r) else known[math.floor(r)]
        for r in ranks
    ]


def _apart(brackets) -> list[tuple[float, float]]:
    """Ranges in order; those that meet are one."""
    out: list[list[float]] = []
    for low, high in sorted(brackets):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [tuple(b) for b in out]


def _counts(x: DataFrame, brackets: list[tuple[float, float]], cells: int) -> list:
    """How many values each cell of each bracket, and each gap between brackets, has, and
    its ends. Zones in order of value: gaps have even numbers, brackets odd ones."""
    zone, cell = F.lit(2 * len(brackets)), F.lit(0)
    for i in range(len(brackets) - 1, -1, -1):
        low, high = brackets[i]
        before, inside = F.col("x") < low, F.col("x") <= high
        zone = F.when(before, 2 * i).when(inside, 2 * i + 1).otherwise(zone)
        cell = F.when(before, 0).when(inside, _cell(F.col("x"), low, high, cells)).otherwise(cell)
    found = x.select("x", zone.alias("zone"), cell.alias("cell")).groupBy("zone", "cell")
    return found.agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
