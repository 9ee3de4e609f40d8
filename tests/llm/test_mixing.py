import random
import re

import pytest
from pyspark.sql import functions as F

from riftlog.llm import mixing
from riftlog.llm.queries import ORACLE, op1_mixing
from checks.compare import duck, rows_of

from .common import SF, documents, odd


def water(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by resharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > most * sizes[s]}
        if not full:
            target.update({s: weight[s] * level for s in free})
            break
        target.update({s: most * sizes[s] for s in full})
        left -= sum(most * sizes[s] for s in full)
        free -= full
    return target


def test_against_sql(spark):
    df = op1_mixing(spark, SF)
    want = duck(SF).execute(ORACLE["op1_mixing"])
    columns = [d[0] for d in want.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, want.fetchall())


def test_targets_and_hot_source(spark):
    random.seed(1)
    docs = None
    for source, n in (("hot", 900), ("b", 60), ("c", 40), ("é", 30), (None, 20)):
        own = documents(spark, ["w " * random.randint(0, 30) for _ in range(n)], first=hash(source) % 1000 * 1000, source=source)
        docs = own if docs is None else docs.union(own)
    rows = mixing.allocate(docs.repartition(16)).collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    target = water(sizes)
    for source in sizes:
        own = [r for r in rows if r["source"] == source]
        assert all(r["target"] == pytest.approx(target[source]) and r["source_size"] == sizes[source] for r in own)
        assert abs(sum(r["taken"] for r in own) - target[source]) <= 30
        assert sorted(r["position"] for r in own) == list(range(1, len(own) + 1))
    assert all(r["taken"] <= 2 * r["size"] for r in rows)


def test_sizes(spark):
    texts = ["a b", None, "", "a b c", "  x\ty\x0bz\n", "\x1c q"]
    got = {r["id"]: r["size"] for r in mixing.allocate(documents(spark, texts)).collect()}
    assert got == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in enumerate(texts)}


def test_mix_repeats_rows(spark):
    docs = odd(spark)
    plan = mixing.allocate(docs)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == plan.agg(F.sum("copies")).first()[0]
    total = mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert total == plan.agg(F.sum("taken")).first()[0]
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, mixed.collect()))


def test_empty(spark):
    assert mixing.mix(documents(spark, ["a"]).limit(0)).count() == 0
    assert mixing.allocate(documents(spark, [None, ""])).agg(F.sum("taken")).first()[0] == 0
