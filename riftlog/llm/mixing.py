"""Mixing sources to target weights by systematic sampling, in DataFrame operations.

Every document of a source is expected ``target / source_size`` times in the mix.
The documents of a source stand in one line, ordered by size; their expected copies
are summed along the line, one random offset per source is added, and a document is
taken once for each integer boundary that its part of the sum crosses. As the line
is ordered by size, the words taken differ from the target by no more than about
the source's longest document.

The line is a range-partitioned sort of slim rows (id, source, size): a source that
holds a third of all rows is spread over as many partitions as its rows need, and
only one row per (partition, source) is gathered to continue the sums.

Defined results: a null text has size 0; a null source is a source of its own, last
in the order; documents of size 0 are copied at their source's rate and add no words;
where all sizes are 0 nothing is taken; repeated rows are separate documents; a null
id is an id like any other; an empty table gives an empty table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riftlog.session import settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
#: Expected copies are counted in steps of 1 / 2^20, so that sums are exact.
BITS = 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) of rows (source, size). ``share`` of all words
    is dealt by weight; what lies over ``most`` times a source's words goes to the
    others by weight, until none is above. With the sources ordered by limit over
    weight, that is one level: the largest of (what is left) / (weight left).

    The windows without a key see one row per source."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(most))
    rows = by_source.withColumn("weight", weight).withColumn("limit", limit)
    line = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(line), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(line), F.lit(0.0))
    rows = rows.withColumn("level", left / weight_left)
    return rows.select(
        "source", "source_size", F.least("limit", F.col("weight") * F.max("level").over(everything)).alias("target")
    )


def offset(source: Column, seed: int = 0) -> Column:
    """A number from 0 to 2^20 that the seed and the source decide."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def boundaries(position: Column, rate: Column, start: Column) -> Column:
    """Integer boundaries crossed by the document at ``position`` (from 1)."""
    upto = F.shiftright(start + position * rate, BITS)
    return upto - F.shiftright(start + (position - 1) * rate, BITS)


def allocate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 0,
             keys: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: id, size, source, source_size, target (of its source),
    position (in its source's line), rate, start, copies, taken, and ``keys``."""
    keys = keys or {}
    slim = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"),
        *[c.alias(k) for k, c in keys.items()],
    )
    slim = settle(slim, "sizes")  # texts are read once, though the sort samples its input first
    order = ["source", "size", "id", *keys]
    line = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id()
    line = settle(line.withColumn("part", F.shiftright(row, 33)).withColumn("place", row.bitwiseAND((1 << 33) - 1)), "mix")
    parts = line.groupBy("source", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("source", "part", "first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("earlier"))
    targets = source_targets(line, weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * (1 << BITS))).otherwise(0).cast("long")
    parts = parts.alias("p").join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))).select(
        "p.*", "source_size", "target", rate.alias("rate"), offset(F.col("p.source"), seed).alias("start")
    )
    # At most one row per partition and source, that is partitions + sources - 1 of
    # them, as the line is sorted by source.
    placed = line.alias("l").join(
        parts.alias("q"), (F.col("l.part") == F.col("q.part")) & F.col("l.source").eqNullSafe(F.col("q.source"))
    ).select("l.*", "source_size", "target", "rate", "start", (F.col("place") - F.col("first") + F.col("earlier") + 1).alias("position"))
    copies = boundaries(F.col("position"), F.col("rate"), F.col("start"))
    return placed.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).drop("part", "place")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the columns
    of ``docs``. Rows find their places again by two hashes of all their columns, so
    null or repeated ids do no harm; equal rows share out the places of their run."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keys = {"h1": F.xxhash64(F.lit(1), *columns), "h2": F.xxhash64(F.lit(2), *reversed(columns))}
    plan = allocate(docs, keys=keys, **options).groupBy("h1", "h2").agg(
        F.min("position").alias("position"), F.first("rate").alias("rate"), F.first("start").alias("start"), F.sum("copies").alias("copies")
    ).where(F.col("copies") > 0).drop("copies")
    rows = docs.select(F.struct("*").alias("row"), *[c.alias(k) for k, c in keys.items()]).join(plan, ["h1", "h2"])
    nth = F.row_number().over(Window.partitionBy("h1", "h2").orderBy(F.lit(0))) - 1
    rows = rows.withColumn("copies", boundaries(F.col("position") + nth, F.col("rate"), F.col("start")))
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.when(F.col("copies") > 0, F.col("copies")).cast("int"))).alias("copy")).select("row.*")
