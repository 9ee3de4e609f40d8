"""Which leaf of the tree a shape belongs to, and a leaf while it is mined."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from riftlog.config import WILDCARD
from riftlog.functions.tokens import token_count
from riftlog.operators.lookups import lookup_join
from riftlog.session import settle

LEAF = ("n_tokens", "first_token")
# Up to so many templates a shape is compared with all of them; beyond, with those that
# an index of tokens names. Both find the same one.
SCAN = 32
# A run of the index is merged with the next as long as it is not so many times as long.
MERGE = 4


@dataclass(frozen=True)
class Tree:
    """The way from a shape to its leaf: by its number of tokens, then by its first
    ``depth`` tokens (0: by the number alone, the strict form). A node has at most
    ``children`` branches for tokens, given to those that appear first; other tokens take
    the branch of the wildcard."""

    depth: int = 1
    children: int | None = None

    def place(self, shapes: DataFrame, templates: DataFrame | None = None) -> DataFrame:
        """``shapes`` (shape, first_line_no) with ``n_tokens`` and ``first_token``, the
        tokens of the way. With ``templates`` their branches are taken, and no new ones."""
        tokens = F.split("shape", " ")
        rows = shapes.withColumns({"n_tokens": token_count(F.col("shape")), "first_token": F.lit("")})
        for level in range(self.depth):
            # A shape with fewer tokens ends on its way.
            rows = rows.withColumn("_t", F.get(tokens, F.lit(level)))
            if self.children is not None:
                rows = self._known_branches(rows, level, templates)
            way = F.concat_ws(" ", F.when(F.col("first_token") != "", F.col("first_token")), "_t")
            rows = rows.withColumn("first_token", way).drop("_t")
        return rows

    def _known_branches(self, rows: DataFrame, level: int, templates: DataFrame | None) -> DataFrame:
        node = ["n_tokens", "first_token"]
        if templates is None:
            # Further levels only add a look-up in few branches to what is written.
            rows = rows if level else settle(rows, "ways")
            first = rows.filter((F.col("_t") != WILDCARD)).groupBy(*node, "_t").agg(F.min("first_line_no").alias("_first"))
            rank = F.row_number().over(Window.partitionBy(*node).orderBy("_first", "_t"))
            branches = first.withColumn("_rank", rank).filter(F.col("_rank") <= self.children).select(*node, "_t")
        else:
            way = F.split("first_token", " ")
            branches = templates.filter(F.size(way) > level).select(
                "n_tokens", F.array_join(F.slice(way, 1, level), " ").alias("first_token"), F.get(way, F.lit(level)).alias("_t")
            ).distinct()
        branches = settle(branches.withColumn("_known", F.lit(True)), "branches")
        rows = lookup_join(rows, branches, [*node, "_t"], "left", ["shape"])
        branch = F.when(F.col("_t").isNull() | F.col("_known"), F.col("_t")).otherwise(F.lit(WILDCARD))
        return rows.withColumn("_t", branch).drop("_known")


FIRST_TOKEN = Tree()


class Leaf:
    """A leaf while it is mined: per template its tokens, the line it first appeared
    on, the number of its changes and of its rows. No shapes are kept.

    A shape joins the template with the most equal tokens, if these are ``similarity`` of
    all; a wildcard in a template says nothing about similarity; ties go to the template
    with more wildcards, then to the older one. To reach k equal tokens of n, a template
    must have one of any n - k + 1 tokens of the shape at its place, so only templates
    under the rarest such tokens of an index are looked at: the work follows what can be
    reached, not the number of templates.

    A token is a number of four bytes in a matrix, and twelve in the index: sorted runs of
    (place, token) and template, each at least ``MERGE`` times as long as the next."""

    def __init__(self, texts=(), first=(), versions=(), n_rows=()):
        self.first, self.versions, self.n_rows, self.since = [], [], [], []
        self._codes: dict[str, int] = {WILDCARD: 0}
        self._names = [WILDCARD]
        self._matrix = np.zeros((0, 0), np.int32)
        self._wild = np.zeros(0, np.int32)
        self._runs: list[tuple[np.ndarray, np.ndarray]] = []
        self._indexed = 0
        self.hold(texts, first, versions, n_rows)

    def hold(self, texts, first, versions, n_rows) -> None:
        """Take up templates that are known."""
        for text, line, version, count in zip(texts, first, versions, n_rows):
            self._new(text.split(" "), int(line), version, int(count))

    def text(self, p: int) -> str:
        return " ".join([self._names[c] for c in self._matrix[p].tolist()])

    @property
    def texts(self) -> list[str]:
        return [self.text(p) for p in range(len(self.first))]

    def _new(self, tokens: list[str], line: int, version: int, count: int) -> None:
        p = len(self.first)
        if p == len(self._matrix):
            more = max(8, p // 2)
            self._matrix = np.concatenate([self._matrix.reshape(p, len(tokens)), np.zeros((more, len(tokens)), np.int32)])
            self._wild = np.concatenate([self._wild, np.zeros(more, np.int32)])
        for place, t in enumerate(tokens):
            code = self._codes.setdefault(t, len(self._names))
            if code == len(self._names):
                self._names.append(t)
            self._matrix[p, place] = code
        self._wild[p] = tokens.count(WILDCARD)
        self.first.append(line)
        self.since.append(line)
        self.versions.append(version)
        self.n_rows.append(count)

    def _index(self) -> None:
        """Bring the index up to all templates but the last few."""
        n = len(self.first)
        if n - self._indexed < SCAN:
            return
        new = self._matrix[self._indexed : n]
        owner, place = np.nonzero(new)
        keys = (place.astype(np.int64) << 32) | new[owner, place]
        run = (keys, (owner + self._indexed).astype(np.int32))
        order = np.argsort(keys, kind="stable")
        run = (run[0][order], run[1][order])
        while self._runs and len(self._runs[-1][0]) < MERGE * len(run[0]):
            last = self._runs.pop()
            keys = np.concatenate([last[0], run[0]])
            order = np.argsort(keys, kind="stable")
            run = (keys[order], np.concatenate([last[1], run[1]])[order])
        self._runs.append(run)
        self._indexed = n

    def _near(self, row: np.ndarray, need: int) -> np.ndarray:
        """The templates, ascending, of which some may have ``need`` tokens of ``row``."""
        n = len(self.first)
        if n <= SCAN or need == 0:
            return np.arange(n)
        self._index()
        place = np.flatnonzero(row > 0)
        keys = (place << 32) | row[place]
        ends = [(np.searchsorted(k, keys), np.searchsorted(k, keys, "right")) for k, _ in self._runs]
        sizes = sum(b - a for a, b in ends)
        found = np.flatnonzero(sizes)
        late = np.arange(self._indexed, n)
        if len(found) < need:
            return late
        rare = found[np.argsort(sizes[found], kind="stable")][: len(found) - need + 1].tolist()
        lists = [own[a[i] : b[i]] for (_, own), (a, b) in zip(self._runs, ends) for i in rare if a[i] < b[i]]
        return np.concatenate([np.unique(np.concatenate(lists)), late])

    def _find(self, row: np.ndarray, similarity: float) -> int:
        width = len(row)
        need = math.ceil(similarity * width) if similarity <= 1 else width + 1
        near = self._near(row, need)
        if not len(near):
            return -1
        own = self._matrix[near]
        same = ((own == row) & (own > 0)).sum(1)
        best = int((same * (width + 1) + self._wild[near]).argmax())
        return -1 if same[best] < similarity * width else int(near[best])

    def add(self, shapes, lines, counts, similarity: float, texts: bool = True) -> tuple[set[int], list[tuple]]:
        """Learn shapes in order of appearance. How many come at a time changes
        nothing. Returns the places they joined, and with ``texts`` each change of a
        template as (place, version, text, line)."""
        joined, changes = set(), []
        for shape, line, count in zip(shapes, lines, counts):
            tokens = shape.split(" ")
            row = np.array([self._codes.get(t, -1) for t in tokens], np.int64)
            p = self._find(row, similarity)
            if p < 0:
                p = len(self.first)
                self._new(tokens, int(line), 0, 0)
                changed = True
            else:
                own = self._matrix[p]
                lost = (own != row) & (own != 0)
                changed = bool(lost.any())
                own[lost] = 0
                self._wild[p] += int(lost.sum())
            self.n_rows[p] += int(count)
            joined.add(p)
            if changed:
                self.versions[p] += 1
                self.since[p] = int(line)
                if texts:
                    changes.append((p, self.versions[p], self.text(p), int(line)))
        return joined, changes
