"""Templates that go on learning while lines arrive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from riftlog.config import SIMILARITY
from riftlog.functions.tokens import first_token, shape_of, token_count
from riftlog.operators.leaf import LEAF, Leaf
from riftlog.operators.templates import CHUNK_SHAPES

_SHAPES = "n_tokens int, first_token string, shape string, n_rows bigint, first_line_no bigint"
_STATE = "templates array<string>, first_line_nos array<bigint>, versions array<int>, n_rows array<bigint>"
_OUT = (
    "n_tokens int, first_token string, place int, version int, template string, "
    "first_line_no bigint, n_rows bigint"
)


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Count equal shapes of a batch before they are sent to their leaf, so a leaf
    gets a busy shape once per batch rather than once per line."""
    for pdf in batches:
        yield (
            pdf.groupby([*LEAF, "shape"], as_index=False, sort=False)
            .agg(n_rows=("line_no", "size"), first_line_no=("line_no", "min"))
        )


def _learner(similarity: float):
    def learn(key, batches, state: GroupState) -> Iterator[pd.DataFrame]:
        new = (
            pd.concat(list(batches))
            .groupby("shape", as_index=False, sort=False)
            .agg(n_rows=("n_rows", "sum"), first_line_no=("first_line_no", "min"))
            .sort_values("first_line_no", kind="stable")
        )
        leaf = Leaf(*state.get) if state.exists else Leaf()
        shapes, lines, counts = (new[c].tolist() for c in ("shape", "first_line_no", "n_rows"))
        joined = set()
        for at in range(0, len(new), CHUNK_SHAPES):
            end = at + CHUNK_SHAPES
            joined |= leaf.add(shapes[at:end], lines[at:end], counts[at:end], similarity)[0]
        state.update((leaf.texts, leaf.first, leaf.versions, leaf.n_rows))
        at = sorted(joined)  # their counts are new, their texts perhaps
        yield pd.DataFrame(
            {
                "n_tokens": key[0],
                "first_token": key[1],
                "place": np.array(at, dtype=np.int32),
                "version": np.array([leaf.versions[p] for p in at], dtype=np.int32),
                "template": [leaf.text(p) for p in at],
                "first_line_no": [leaf.first[p] for p in at],
                "n_rows": [leaf.n_rows[p] for p in at],
            }
        )

    return learn


def learn_templates(rows: DataFrame, message: str = "message", similarity: float = SIMILARITY) -> DataFrame:
    """A stream of parsed rows (with ``line_no``) becomes a stream of templates
    that rows have joined: ``n_tokens, first_token, place, version, template,
    first_line_no, n_rows``; a leaf and a place name one template. ``version`` counts
    the changes of its text, ``n_rows`` its rows up to this batch, so the update with
    the most rows is current.

    State is kept per leaf: the templates of the leaf, no lines. Only distinct
    shapes of a batch reach it."""
    shape = shape_of(F.col(message))
    shapes = (
        rows.select("line_no", shape.alias("shape"))
        .filter(F.col("shape").isNotNull())
        .select(
            token_count(F.col("shape")).alias("n_tokens"),
            first_token(F.col("shape")).alias("first_token"),
            "shape",
            "line_no",
        )
        .mapInPandas(_combine, _SHAPES)
    )
    return shapes.groupBy(*LEAF).applyInPandasWithState(
        _learner(similarity), _OUT, _STATE, "update", GroupStateTimeout.NoTimeout
    )


def current(updates: DataFrame) -> DataFrame:
    """The current templates from a table of all updates."""
    latest = F.max_by(F.struct("version", "template", "first_line_no", "n_rows"), F.col("n_rows"))
    return updates.groupBy(*LEAF, "place").agg(latest.alias("t")).select(*LEAF, "place", "t.*")
