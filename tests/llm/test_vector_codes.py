"""Vector codes against plain Python integers."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riftlog.llm import vector_codes
from riftlog.llm.vector_codes import compress, exact_products

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    """rows: (id, floats, label); returns {id: (code, error, label_error)} and the digest."""
    kept = [(i, [math.floor(1024 * float(np.float64(x))) if abs(x) < 2**53 else 1024 * int(x) for x in v], lab, v) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, "" if r[0] is None else r[0] if isinstance(r[0], str) else f"{r[0]:09d}", r[3]))
    d = len(kept[0][1])
    cut = [d * p // parts for p in range(parts + 1)]
    cells = [[v[cut[p] : cut[p + 1]] for p in range(parts)] for _, v, _, _ in kept]
    books = [[list(c[p]) for c in cells[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cells:
                groups[near(c[p], books[p])[1]].append(c[p])
            for j, xs in groups.items():
                books[p][j] = [sum(col) // len(xs) for col in zip(*xs)]
    out, total = [], defaultdict(int)
    for (i, _, lab, _), c in zip(kept, cells):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(e for e, _ in found), lab))
        total[lab] += out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((str(i), c, e, total[lab]) for i, c, e, lab in out)), digest


def got(frame, **options):
    coded, books = compress(frame, **options)
    return sorted((str(r["id"]), r["code"], r["error"], r["label_error"]) for r in coded.collect()), books.digest()


def vectors(n, d, scale, seed=0):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0, scale))) for _ in range(d)], rng.choice([None, 0, 1])) for i in range(n)]


@pytest.mark.parametrize("scale", [1.0, 1e4, 1e9, 1e30])
def test_equals_brute_force(spark, scale):
    rows = vectors(120, 8, scale)
    rows += [(1000 + i, list(v), 5) for i, v, _ in rows[:20]]  # ties
    want, digest = brute(rows, entries=16)
    found, own = got(spark.createDataFrame(rows, SCHEMA).repartition(5), entries=16)
    assert own == digest
    assert [r[:2] for r in found] == [r[:2] for r in want]
    if scale < 1e9:
        assert found == want
    else:  # some are too large for 64 bits
        assert all(mine == (None if e >= 2**63 else e) for (_, _, mine, _), (_, _, e, _) in zip(found, want))


def test_products_are_exact():
    rng = np.random.default_rng(0)
    for bits in (1, 10, 22, 23, 24, 27):
        for d in (1, 3, 16, 64):
            a, b = (rng.integers(-(2**bits), 2**bits, (7, d), endpoint=True) for _ in range(2))
            want = (a.astype(object) @ b.astype(object).T)
            assert (exact_products(a, b, bits + 1).astype(object) == want).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 2.0, 3.0, 4.0], 1), (None, [1.0, 2.0, 3.5, -4.0], None), (5, [1.0, 2.0, 3.0, 4.0], 1), (3, None, 1), (4, [1.0, None, 2.0, 3.0], 1),
            (1, [nan, 1.0, 1.0, 1.0], 2), (0, [inf, 1.0, 1.0, 1.0], 2), (2, [-0.5, -0.0, 1e-9, -1e-9], None)]
    want, digest = brute(rows, entries=2)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("code", F.lit("clash")).withColumn("vector", F.lit(1)).withColumn("id", F.lit("x"))
    assert got(frame, entries=2) == (want, digest)
    other = frame.union(spark.createDataFrame([(9, [1.0, 2.0], 7, "c", 1, "x")], frame.schema))
    found, same = got(other, entries=2)
    assert same == digest and ("9", None, None, None) in found and len(found) == len(want) + 1


def test_dimension_not_divisible_and_text_ids(spark):
    rows = [(f"v{i:02d}", v, lab) for i, v, lab in vectors(40, 6, 1.0, 3)]
    frame = spark.createDataFrame(rows, "vec_id string, embedding array<float>, label int")
    assert [b.shape for b in compress(frame, entries=5)[1].parts] == [(5, 1), (5, 2), (5, 1), (5, 2)]
    assert got(frame, entries=5) == brute(rows, entries=5)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], None), (2, [], 3)]])
def test_empty_tables(spark, rows):
    coded, books = compress(spark.createDataFrame(rows, SCHEMA))
    assert coded.count() == sum(v is not None for _, v, _ in rows) and len(books.digest()) == 64


def test_many_dirty_labels_and_one_hot(spark, monkeypatch):
    """The sums of labels are joined back without a broadcast when there are many."""
    monkeypatch.setattr(vector_codes.lookup_join, "__defaults__", ("left", None, 2, 10, 4))
    rows = [(i, v, 7 if i % 3 else i) for i, v, _ in vectors(60, 4, 1.0)]
    assert got(spark.createDataFrame(rows, SCHEMA), entries=4) == brute(rows, entries=4)
