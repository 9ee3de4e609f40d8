"""Vectors as short codes: product quantisation in whole numbers.

Components become integers, vectors are cut into parts, and each part is replaced by the
nearest entry of its position's codebook. The nearest entry is found by matrix products
that are exact: integers are broken into limbs so narrow that every float64 product sum
stays below 2^53; the products of the limbs are put together again in int64, and the
first smallest distance wins. So codes do not depend on the order of additions, nor on
the machine.

A round is one scan: every task adds up the parts of each entry and gives its sums, again
as limbs (32 bits, so that sums of sums fit 64 bits); they meet in one aggregate by
(part, entry, component, limb), as many rows as the codebooks have numbers, whatever the
table holds. No vector is shuffled; only the sums per label are joined back.

Defined results: rows whose vector is null or holds null or non-finite components are left
out. The dimension is that of the first kept row (smallest id, then smallest vector); rows
of another length have no code and no error (null) and teach nothing. A dimension that the
parts do not divide is cut as evenly as possible. Ids may be null (they come last) and may
repeat; repeated rows count each. Fewer rows than entries give smaller codebooks. Values too
large for 64-bit distances are computed in Python integers; an error beyond 64 bits is null,
its code stays exact. Labels are compared as text, nulls together. Other columns are not
looked at. An empty table gives an empty result."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riftlog.operators.lookups import lookup_join
from riftlog.session import settle

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
ROWS_AT_ONCE = 4096
LIMB = 32  # bits of a limb of a sum


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, number), F.lit(False))


@dataclass
class Books:
    """One codebook per part: (entries, width) integers, int64 where ``bits`` allow."""

    bits: int  # of the largest integer of the table, without its sign
    parts: list[np.ndarray]

    @property
    def bounds(self) -> np.ndarray:
        return np.cumsum([0, *(b.shape[1] for b in self.parts)])

    @property
    def dimension(self) -> int:
        return int(self.bounds[-1])

    @property
    def narrow(self) -> bool:
        """Whether every squared distance is certain to fit 63 bits."""
        return 2 * (self.bits + 1) + max(self.dimension, 1).bit_length() < 63

    def digest(self) -> str:
        numbers = ",".join(str(v) for book in self.parts for entry in book for v in entry)
        return hashlib.sha256(numbers.encode()).hexdigest()


def limbs(x: np.ndarray, width: int, many: int) -> list[np.ndarray]:
    """``x`` as a sum of limbs times powers of 2^width: the last keeps the sign."""
    mask = (1 << width) - 1
    return [((x >> width * i) & mask if i < many - 1 else x >> width * i) for i in range(many)]


def exact_products(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """The matrix product a @ b.T of int64 matrices of ``bits`` bits, modulo 2^64."""
    width = (53 - max(a.shape[1], 1).bit_length()) // 2 - 1
    many = max(1, -(-(bits + 1) // width))
    left, right = ([m.astype(np.float64) for m in limbs(x, width, many)] for x in (a, b))
    out = np.zeros((len(a), len(b)), np.int64)
    with np.errstate(over="ignore"):
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                if width * (i + j) < 64:
                    out += (x @ y.T).astype(np.int64) << width * (i + j)
    return out


def nearest(x: np.ndarray, book: np.ndarray, bits: int, narrow: bool) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of each row of ``x`` and its squared distance."""
    if narrow:
        distance = (x * x).sum(1)[:, None] - 2 * exact_products(x, book, bits) + (book * book).sum(1)
    else:
        distance = np.empty((len(x), len(book)), object)
        for j, entry in enumerate(book):
            distance[:, j] = ((x - entry) ** 2).sum(1)
    code = distance.argmin(1)
    return code, distance[np.arange(len(x)), code]


def _whole(x: float) -> int:
    # Beyond 2^53 a float is a whole number, and its product may leave the floats.
    return int(x) * SCALE if abs(x) >= 2**53 else int(np.floor(x * SCALE))


def integers(flat: np.ndarray, narrow: bool) -> np.ndarray:
    """floor(SCALE * x): int64, or Python integers where those are too short."""
    return np.floor(flat * SCALE).astype(np.int64) if narrow else np.frompyfunc(_whole, 1, 1)(flat).astype(object)


def _matrices(column: pa.Array, books: Books) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, rows of the right length, and their integers, some rows at a time."""
    for a in range(0, len(column), ROWS_AT_ONCE):
        part = column.slice(a, ROWS_AT_ONCE)
        fits = np.flatnonzero(part.value_lengths().to_numpy(zero_copy_only=False) == books.dimension)
        flat = part.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
        yield a, fits, integers(flat, books.narrow).reshape(len(fits), books.dimension)


def _sums(rows: DataFrame, books: Books) -> list[np.ndarray]:
    """Per part and entry the sums of the components over the vectors given to it, and in
    the place after the last component their number: Python integers."""
    many = (books.bits + 64) // LIMB + 1
    shapes = [(len(b), b.shape[1] + 1, many) for b in books.parts]
    begin = np.cumsum([0, *(int(np.prod(s)) for s in shapes)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.int64 if books.narrow else object
        total = [np.zeros(s[:2], kind) for s in shapes]
        seen = False
        for batch in batches:
            for _, _, x in _matrices(batch.column("vector"), books):
                seen |= len(x) > 0
                for sums, book, a in zip(total, books.parts, books.bounds):
                    own = x[:, a : a + book.shape[1]]
                    code, _ = nearest(own, book, books.bits, books.narrow)
                    order = np.argsort(code, kind="stable")
                    first = np.flatnonzero(np.append(True, np.diff(code[order]) != 0)) if len(order) else order
                    if len(order):
                        sums[code[order][first], :-1] += np.add.reduceat(own[order], first, axis=0)
                        sums[:, -1] += np.bincount(code, minlength=len(book))
        if seen:
            value = np.concatenate([np.stack([v.astype(np.int64) for v in _split(s, many)], -1).ravel() for s in total])
            at = np.flatnonzero(value)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(value[at])], names=["slot", "value"])

    given = rows.mapInArrow(run, "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value"))
    found = given.toArrow()
    flat = np.zeros(begin[-1], object)
    flat[found.column("slot").to_numpy()] = [int(v) for v in found.column("value").to_pylist()]
    return [sum(flat[a:b].reshape(s)[..., i] * (1 << LIMB * i) for i in range(many)) for a, b, s in zip(begin, begin[1:], shapes)]


def _split(sums: np.ndarray, many: int) -> list[np.ndarray]:
    if sums.dtype != object and LIMB * (many - 1) > 63:  # 64 bits have no more limbs: the sign goes on
        return limbs(sums, LIMB, 2) + [np.zeros_like(sums)] * (many - 2)
    return limbs(sums, LIMB, many)


def fit(rows: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Books:
    """Codebooks of ``rows`` (id, vector): the first vectors, then rounds of assigning
    every part to its nearest entry and replacing entries by floored means."""
    if entries > 256:
        raise ValueError("an entry is written with two hex digits: 256 at the most")
    line = [F.col("id").asc_nulls_last(), F.col("vector").asc()]
    most = F.coalesce(F.array_max(F.transform("vector", F.abs)), F.lit(0.0))
    shape = rows.agg(F.max(most).alias("most"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "vector")).alias("first")).first()
    if shape["first"] is None:
        return Books(0, [np.zeros((0, 0), np.int64)] * parts)
    dimension = len(shape["first"]["vector"])
    bits = max(abs(_whole(shape["most"])), abs(_whole(-shape["most"]))).bit_length()
    start = rows.where(F.size("vector") == dimension).orderBy(*line).limit(entries).select("vector").toArrow().column("vector").combine_chunks()
    books = Books(bits, [np.zeros((0, dimension), np.int64)])
    x = integers(start.flatten().to_numpy(zero_copy_only=False), books.narrow).reshape(len(start), dimension)
    cuts = [dimension * i // parts for i in range(parts + 1)]
    books.parts = [np.ascontiguousarray(x[:, a:b]) for a, b in zip(cuts, cuts[1:])]
    for _ in range(rounds):
        new = []
        for sums, book in zip(_sums(rows, books), books.parts):
            n = sums[:, -1:]
            used = (n > 0).ravel()
            book = book.copy()
            book[used] = (sums[used, :-1] // n[used]).astype(book.dtype)
            new.append(book)
        books.parts = new
    return books


_HEX = np.array([f"{i:02x}" for i in range(ENTRIES)], "S2")


def encode(rows: DataFrame, books: Books) -> DataFrame:
    """``rows`` without the vector, with ``code`` and ``error``."""
    kept = [c for c in rows.columns if c != "vector"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            code = np.zeros((n, len(books.parts)), np.int64)
            error = np.zeros(n, np.int64 if books.narrow else object)
            known = np.zeros(n, bool)
            for first, fits, x in _matrices(batch.column("vector"), books):
                at = first + fits
                known[at] = True
                for i, (book, a) in enumerate(zip(books.parts, books.bounds)):
                    if len(at):
                        code[at, i], far = nearest(x[:, a : a + book.shape[1]], book, books.bits, books.narrow)
                        error[at] += far
            text = pa.array([b.decode() for b in _HEX[code].view(f"S{2 * len(books.parts)}").ravel()] if n else [], pa.string(), mask=~known)
            fits64 = known & (error < 2**63).astype(bool)
            far = pa.array(np.where(fits64, error, 0).astype(np.int64), pa.int64(), mask=~fits64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), text, far], names=[*kept, "code", "error"])

    return rows.mapInArrow(run, rows.select(kept).schema.add("code", "string").add("error", "long"))


def compress(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Books]:
    """(id, code, error, label_error) of every kept row, and the codebooks."""
    label = F.col(f"`{label_col}`").cast("string")
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
        F.coalesce(F.concat(F.lit("="), label), F.lit("")).alias("label"),
    ).where(finite(F.col("vector")))
    books = fit(rows.select("id", "vector"), parts=parts, entries=entries, rounds=rounds)
    coded = settle(encode(rows, books), "codes")
    total = settle(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total")), "label-errors")
    total = total.select("label", F.expr("try_cast(total AS long)").alias("label_error"))
    return lookup_join(coded, total, ["label"], spread_by=["id", "code"]).select("id", "code", "error", "label_error"), books
