"""The mining tree, its index of tokens, and matching by rare tokens."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riftlog.operators import leaf as lf, templates as tpl
from riftlog.operators.leaf import Leaf, Tree


def scan(shapes, similarity):
    """Every shape against every template."""
    templates, joined = [], []
    for shape in shapes:
        s, best, rank = shape.split(" "), -1, None
        for i, t in enumerate(templates):
            same = sum(a == b != "<*>" for a, b in zip(t, s))
            if same >= similarity * len(s) and (rank is None or (same, t.count("<*>")) > rank):
                best, rank = i, (same, t.count("<*>"))
        if best < 0:
            best = len(templates)
            templates.append(s)
        else:
            templates[best] = [a if a == b else "<*>" for a, b in zip(templates[best], s)]
        joined.append(best)
    return [" ".join(t) for t in templates], joined


def random_shapes(rng, n, width, pool):
    return [" ".join(rng.choice(pool + ["<*>"]) for _ in range(width)) for _ in range(n)]


@pytest.mark.parametrize("similarity", [0.0, 0.4, 0.55, 1.0])
def test_index_finds_what_a_scan_finds(similarity):
    rng = random.Random(int(similarity * 100))
    for width, pool in ((1, 40), (2, 30), (5, 12), (9, 60)):
        shapes = random_shapes(rng, 400, width, [f"t{i}" for i in range(pool)])
        want, joined = scan(shapes, similarity)
        leaf = Leaf()
        for a in range(0, len(shapes), 37):
            places, _ = leaf.add(shapes[a : a + 37], range(37), [1] * 37, similarity)
            assert places == set(joined[a : a + 37])
        assert leaf.texts == want
        again = Leaf(want[: len(want) // 2], range(len(want) // 2), [1] * (len(want) // 2), [1] * (len(want) // 2))
        again.add(shapes[:5], range(5), [1] * 5, similarity)  # known templates go on learning


def test_index_looks_at_few_templates(monkeypatch):
    """Thousands of templates, of which hardly any can reach the similarity."""
    rng = random.Random(1)
    leaf = Leaf()
    shapes = [" ".join(f"w{rng.randrange(20_000)}" for _ in range(6)) for _ in range(3000)]
    looked = []
    real = lf.np.unique
    monkeypatch.setattr(lf.np, "unique", lambda x: looked.append(len(real(x))) or real(x))
    leaf.add(shapes, range(3000), [1] * 3000, 0.4)
    assert len(leaf.texts) > 2900 and sum(looked) < 3000 * 3


def route(shapes, depth, children):
    """Ways in order of appearance: a node's first tokens get branches."""
    known, ways = defaultdict(list), []
    for s in shapes:
        tokens, way = s.split(" "), ()
        for t in tokens[:depth]:
            node = (len(tokens), way)
            if t != "<*>" and t not in known[node] and (children is None or len(known[node]) < children):
                known[node].append(t)
            way += (t if t in known[node] else "<*>",)
        ways.append(" ".join(way))
    return ways, known


@pytest.mark.parametrize("depth, children", [(0, None), (1, None), (1, 2), (2, 3), (3, 1), (3, None)])
def test_ways_and_mining(spark, depth, children):
    rng = random.Random(depth)
    shapes = list(dict.fromkeys(s for w in (1, 2, 4) for s in random_shapes(rng, 60, w, ["ta", "tb", "tc", "td", "te", "tf"])))
    rng.shuffle(shapes)
    frame = spark.createDataFrame([(s, i) for i, s in enumerate(shapes)], "shape string, first_line_no long").repartition(3)
    ways, known = route(shapes, depth, children)
    tree = Tree(depth, children)
    got = {r["shape"]: (r["n_tokens"], r["first_token"]) for r in tree.place(frame).collect()}
    assert got == {s: (len(s.split(" ")), w) for s, w in zip(shapes, ways)}
    rows = frame.select(F.col("first_line_no").alias("line_no"), F.col("shape").alias("message"))
    mined = tpl.mine_templates(rows, tree=tree)
    leaves = defaultdict(list)
    for s, w in zip(shapes, ways):
        leaves[len(s.split(" ")), w].append(s)
    want = {(k, t) for k, own in leaves.items() for t in scan(own, 0.4)[0]}
    assert {((r["n_tokens"], r["first_token"]), r["template"]) for r in mined.collect()} == want
    # All rows, and some that no branch was made for, find the template of their leaf.
    extra = [(1000 + i, s) for i, s in enumerate(["tx tb", "tb zz tc td", "zz", "ta tb tc"])]
    more = rows.union(spark.createDataFrame(extra, "line_no long, message string"))
    tagged = {r["message"]: r["log_key"] for r in tpl.tag_rows(more, mined, tree=tree).collect()}
    key = {(r["n_tokens"], r["first_token"], r["template"]): (r["template"].split(" ").count("<*>"), int(r["log_key"].split("_")[2])) for r in mined.collect()}
    for message in [*shapes, *(m for _, m in extra)]:
        tokens, way = message.split(" "), ()
        for t in tokens[:depth]:
            free = children is None
            way += (t if free or t in known[len(tokens), way] else "<*>",)
        fits = [rank for (n, w, t), rank in key.items() if n == len(tokens) and w == " ".join(way)
                and all(a in ("<*>", b) for a, b in zip(t.split(" "), tokens))]
        assert tagged[message] == (f"LG_KEY_{min(fits)[1]}" if fits else "UNMAPPED"), message


def test_matching_does_not_multiply_by_patterns(spark):
    """Many templates of one leaf with different wildcards: a shape meets those that share
    its rarest tokens only."""
    rng = random.Random(3)
    texts = list(dict.fromkeys(
        " ".join(["go", *("<*>" if rng.random() < 0.5 else f"v{i}" for _ in range(8)), f"end{i % 10}"]) for i in range(200)))
    templates = spark.createDataFrame([(t, f"LG_KEY_{i + 1}", 10, "go") for i, t in enumerate(texts)], "template string, log_key string, n_tokens int, first_token string")
    shapes = spark.createDataFrame([(t.replace("<*>", "any"), 10, "go") for t in texts], "shape string, n_tokens int, first_token string")
    got = {r["shape"]: r["template"] for r in tpl.match_shapes(shapes, templates).collect()}
    wild = lambda t: t.count("<*>")
    for t in texts:
        shape = t.replace("<*>", "any").split(" ")
        fits = [u for u in texts if all(a in ("<*>", b) for a, b in zip(u.split(" "), shape))]
        assert got[" ".join(shape)] == min(fits, key=lambda u: (wild(u), texts.index(u)))
