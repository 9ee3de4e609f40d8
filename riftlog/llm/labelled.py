"""Labelled rows for fitting: folds, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 3; the fold of a null id is null."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3


def held_out(id_col: Column) -> Column:
    return F.coalesce(fold(id_col) == 1, F.lit(False))


def bounded_sample(rows: DataFrame, key: Column, most: int, seed: int = 0) -> DataFrame:
    """About ``most`` of ``rows`` at the most, chosen by a hash of ``key``: all rows
    if there are fewer. A chosen row stays chosen in every rerun."""
    n = rows.count()
    if n <= most:
        return rows
    draw = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30))
    return rows.where(draw < int(most / n * (1 << 30)))
