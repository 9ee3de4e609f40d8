import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riftlog.llm import dart_minhash as dm
from riftlog.llm.components import components
from riftlog.llm.queries import op6_dart_minhash
from riftlog.llm.text import words_of

from .common import ODD_TEXTS, documents, odd, read, words

SF = "/root/testdata/sf0.01"


def shingles(text):
    own = words(text)
    if not own:
        return {("text", text)}
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)}


class Forest:
    def __init__(self, ids):
        self.root = {i: i for i in ids}

    def find(self, x):
        while self.root[x] != x:
            x = self.root[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.root[b] = a


def brute(docs, threshold=0.8):
    """The smallest id of each group; texts only meet if they share a shingle."""
    sets = {i: shingles(t) for i, t in docs}
    holders, forest = {}, Forest(sets)
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    seen = set()
    for own in holders.values():
        for n, a in enumerate(own):
            for b in own[:n]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                        forest.join(a, b)
    return {i: forest.find(i) for i in sets}


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    element = np.arange(300, dtype=np.uint64)
    k = 4000
    for scale in (1, 0.37):
        a = np.floor(rng.uniform(0, 4, 300)) * scale
        b = np.where(rng.uniform(size=300) < 0.7, a, np.floor(rng.uniform(0, 4, 300)) * scale)
        both = np.concatenate([element[a > 0], element[b > 0]])
        start = np.array([0, (a > 0).sum(), len(both)])
        x, y = dm.signatures(both, np.concatenate([a[a > 0], b[b > 0]]), start, k)
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert (x == y).mean() == pytest.approx(want, abs=0.04)
        alone = dm.signatures(element[a > 0], a[a > 0], np.array([0, (a > 0).sum()]), k)
        assert (alone[0] == x).all()


def test_shingle_sets():
    texts = ["a b c d e f", "A-b, c d e f!", "a b", "b a", "", "...", "a a a a a a a a", None]
    piece = next(words_of(pa.array(texts)))
    element, start = dm.shingle_sets(piece)
    assert np.diff(start).tolist() == [2, 2, 1, 1, 0, 0, 1, 0]
    h = dm.set_hashes(piece, element, start)
    assert h[0] == h[1] and h[4] == h[7] and len(set(h.tolist())) == 6


def test_on_the_table(spark):
    docs = read("documents", SF)
    want = brute(list(zip(docs.doc_id.tolist(), docs.text)))
    rows = op6_dart_minhash(spark, SF).collect()
    assert {r["doc_id"]: r["group_id"] for r in rows} == want and len(rows) == len(want)
    sets = {}
    for d, t in zip(docs.doc_id.tolist(), docs.text):
        sets.setdefault(frozenset(shingles(t)), d)
    assert all(r["copy_id"] == sets[frozenset(shingles(t))] for r, t in zip(sorted(rows), docs.sort_values("doc_id").text))


def test_hot_family_in_blocks(spark):
    """One family holds most rows: copies, and copies of copies with changed words."""
    random.seed(11)
    pool = [f"w{i}" for i in range(500)]
    family = [[random.choice(pool) for _ in range(150)]]
    for _ in range(220):
        own = list(random.choice(family))
        for _ in range(random.randint(0, 5)):
            own[random.randrange(len(own))] = random.choice(pool)
        family.append(own)
    texts = [" ".join(x) for x in family] + [" ".join(random.choices(pool, k=60)) for _ in range(60)] + [" ".join(family[0])] * 100
    docs = list(enumerate(texts))
    want = brute(docs)
    for block in (16, 10_000):
        got = dm.near_duplicates(documents(spark, texts).repartition(7), block=block).collect()
        assert {r["id"]: r["group_id"] for r in got} == want


def test_one_row_per_document(spark):
    docs = odd(spark)
    rows = dm.near_duplicates(docs).collect()
    assert Counter(r["id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    alone = [tuple(r) for r in rows if r["id"] in (None, 0)]
    assert sorted(alone, key=str) == [(0, 0, 0), (0, 0, 0), (None, None, None)]


def test_one_of_each(spark):
    docs = odd(spark)
    kept = dm.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(rows, key=str) == sorted(
        [(0, None), (0, None), (None, "no id here"), (3, None)] + [(i, t) for i, t in enumerate(ODD_TEXTS) if i not in (0, 10)], key=str
    )
    assert dm.one_of_each(docs.limit(0)).count() == 0





def test_another_text_under_a_dropped_id_stays(spark):
    random.seed(14)
    text = [f"w{random.randrange(10**6)}" for _ in range(60)]
    near, other = [*text[:-1], "changed"], " ".join(f"v{i}" for i in range(40))
    rows = [(1, " ".join(text)), (2, " ".join(near)), (2, other), (3, " ".join(text)), (3, " ".join(near)), (2, other)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert sorted(tuple(r) for r in dm.one_of_each(docs).collect()) == [(1, " ".join(text)), (2, other)]
    twice = spark.createDataFrame([(7, " ".join(text)), (7, " ".join(near)), (7, " ".join(text))], "doc_id int, text string")
    assert dm.one_of_each(twice).count() == 1


def test_components(spark):
    random.seed(6)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(1, 300)]
    forest = Forest({x for e in edges for x in e})
    for a, b in edges:
        forest.join(a, b)
    got = components(spark.createDataFrame(edges, "u long, v long"))
    want = {x: forest.find(x) for x in forest.root}
    inside = {x for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in got.collect()} == {x: want[x] for x in inside}
