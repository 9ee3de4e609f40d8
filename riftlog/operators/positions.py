"""Gap-free numbering of rows without sorting a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

BLOCK_ROWS = 1 << 18
# Blocks under one block of the next level; two levels above the blocks cover all longs.
FAN = 1 << 15
LEVELS = 2


def with_positions(
    df: DataFrame,
    order: str,
    keys: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
    name: str = "pos",
    fan: int = FAN,
) -> DataFrame:
    """Add the 0-based rank of each row within its key, by the integer column
    ``order`` (unique within a key; keys not null).

    ``order`` is cut into blocks of ``block_rows`` values. Rows are ranked inside
    (key, block), a group that cannot exceed ``block_rows`` rows however hot the
    key is, and the sizes of the earlier blocks are added: those under the same block of
    ``fan`` blocks, then the earlier ones of these, and so on. So no task holds more than
    ``block_rows`` rows or ``fan`` sizes, whatever values ``order`` has (up to
    ``block_rows * fan`` ^ 3 apart)."""
    keys = list(keys)
    marked = df.withColumn("_block", F.floor(F.col(order) / block_rows))
    sizes = marked.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    return (
        marked.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(_offsets(sizes, keys, fan, LEVELS), [*keys, "_block"])
        .withColumn(name, F.col("_offset") + F.col("_rank"))
        .drop("_block", "_rank", "_offset")
        .select(*df.columns, name)
    )


def _offsets(sizes: DataFrame, keys: list[str], fan: int, levels: int) -> DataFrame:
    """``keys, _block, _offset``: the sum of the sizes ``_n`` of all earlier blocks."""
    line = Window.partitionBy(*keys, *(["_above"] if levels else [])).orderBy("_block")
    before = F.sum("_n").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    if not levels:
        return sizes.select(*keys, "_block", before.alias("_offset"))
    under = sizes.withColumn("_above", F.floor(F.col("_block") / fan))
    above = under.groupBy(*keys, F.col("_above").alias("_block")).agg(F.sum("_n").alias("_n"))
    earlier = _offsets(above, keys, fan, levels - 1).select(*keys, F.col("_block").alias("_above"), F.col("_offset").alias("_earlier"))
    placed = under.withColumn("_own", before).join(earlier, [*keys, "_above"])
    return placed.select(*keys, "_block", (F.col("_own") + F.col("_earlier")).alias("_offset"))
