"""Mining, matching and tagging."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riftlog.operators import catalogue, templates as tpl


def messages(n=400, seed=11):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "up", "down", "7x", "42", "[instance:"]
    forms = [
        lambda: f"user {rng.choice(words)} logged in from {rng.choice(words)}",
        lambda: f"user {rng.choice(words)} has gone away at {rng.randint(0, 9)}",
        lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 5))),
        lambda: f"  disk   {rng.choice(words)} full ",
    ]
    return [rng.choice(forms)() for _ in range(n)] + ["same old text"] * 200


def mine_plainly(texts, similarity):
    """One ordered pass over the distinct shapes of all leaves; copies of a shape
    only count."""
    shapes = Counter(" ".join("<*>" if any(c.isdigit() for c in t) else t for t in x.split()) for x in texts)
    leaves = {}
    for shape, n in shapes.items():
        tokens = shape.split(" ")
        groups = leaves.setdefault((len(tokens), tokens[0]), [])
        best, top = None, (-1, -1)
        for g in groups:
            same = sum(a == b and a != "<*>" for a, b in zip(g[0], tokens))
            rank = (same, g[0].count("<*>"))
            if rank > top:
                best, top = g, rank
        if best is None or top[0] < similarity * len(tokens):
            groups.append([tokens, n, 1])
        else:
            merged = [a if a == b else "<*>" for a, b in zip(best[0], tokens)]
            best[2] += merged != best[0]
            best[0], best[1] = merged, best[1] + n
    return [(" ".join(t), n, v) for groups in leaves.values() for t, n, v in groups]


def rows_of(spark, texts, parts=3):
    return spark.createDataFrame(list(enumerate(texts)), "line_no bigint, message string").repartition(parts)


@pytest.mark.parametrize("similarity", [0.4, 0.7])
def test_mining_equals_one_ordered_pass(spark, similarity):
    texts = messages()
    for parts in (1, 7):
        versions = tpl.mine_versions(tpl.distinct_shapes(tpl.with_shape(rows_of(spark, texts, parts))), similarity).collect()
        current = sorted((r["template"], r["n_rows"], r["version"]) for r in versions if r["is_current"])
        assert current == sorted(mine_plainly(texts, similarity))


@pytest.mark.parametrize("chunk", [1, 3, 50])
def test_mining_is_the_same_in_chunks_of_any_size(spark, chunk):
    shapes = tpl.distinct_shapes(tpl.with_shape(rows_of(spark, messages())))
    whole = sorted(map(str, tpl.mine_versions(shapes).collect()))
    assert sorted(map(str, tpl.mine_versions(shapes, chunk=chunk).collect())) == whole


@pytest.mark.parametrize("chunk", [2, 4096])
def test_learning_more_equals_learning_at_once(spark, chunk):
    """Known templates come first, so two logs in a row are one longer log."""
    texts = messages()
    rows = rows_of(spark, texts)
    first, second = rows.filter("line_no < 250"), rows.filter("line_no >= 250")
    known = tpl.mine_templates(first, 0.7)
    shapes = tpl.distinct_shapes(tpl.with_shape(second))
    grown = tpl.learn_more(known, shapes, 0.7, chunk).collect()
    keys = {r["log_key"]: r for r in grown}
    assert len(keys) == len(grown) and sum(r["n_rows"] for r in grown) == len(texts)
    for r in known.collect():  # known keys stay; texts only lose tokens
        if r["log_key"] in keys:
            now = keys[r["log_key"]]
            assert now["first_line_no"] == r["first_line_no"]
            assert all(a in ("<*>", b) for a, b in zip(now["template"].split(" "), r["template"].split(" ")))
    again = tpl.learn_more(known, shapes.limit(0), 0.7).collect()
    assert sorted(map(str, again)) == sorted(map(str, known.select(*again[0].asDict()).collect()))
    fresh = tpl.learn_more(known.limit(0), tpl.distinct_shapes(tpl.with_shape(rows)), 0.7)
    want = tpl.mine_templates(rows, 0.7)
    assert sorted(map(str, fresh.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    tagged = tpl.tag_rows(rows, spark.createDataFrame(grown))
    assert tagged.filter("log_key = 'UNMAPPED'").count() == 0


def test_tags_equal_brute_force(spark):
    texts = messages()
    rows = rows_of(spark, texts)
    known = tpl.mine_templates(rows.filter("line_no < 300"))
    table = [(r["template"].split(" "), r["log_key"]) for r in known.collect()]
    got = {r["line_no"]: r["log_key"] for r in tpl.tag_rows(rows, known).collect()}
    for i, text in enumerate(texts):
        tokens = ["<*>" if any(c.isdigit() for c in t) else t for t in text.split()]
        fits = [
            (t.count("<*>"), int(k.split("_")[-1]), k)
            for t, k in table
            if len(t) == len(tokens) and t[0] == tokens[0] and all(a in ("<*>", b) for a, b in zip(t, tokens))
        ]
        assert got[i] == (min(fits)[2] if fits else "UNMAPPED"), text


def test_missing_and_blank_messages(spark):
    rows = spark.createDataFrame([(0, "a b"), (1, None), (2, "   ")], "line_no bigint, message string")
    known = tpl.mine_templates(rows)
    tagged = {r["line_no"]: r["log_key"] for r in tpl.tag_rows(rows, known).collect()}
    assert tagged == {0: "LG_KEY_1", 1: None, 2: "UNMAPPED"}
    text = tpl.template_text(tpl.tag_rows(rows, known), known)
    assert {r["line_no"]: r["template"] for r in text.collect()} == {0: "a b", 1: None, 2: None}


def test_catalogue(spark):
    rng = random.Random(2)
    filled = []
    for name, template in catalogue.CATALOGUE:
        for _ in range(5):
            text = template
            while "<*>" in text:
                text = text.replace("<*>", rng.choice(["1", "abc", "10.0.0.1", "a b", "x/y(z)"]), 1)
            filled.append((name, text))
    filled.append((None, "nothing of this kind"))
    df = spark.createDataFrame(filled, "want string, message string")
    assert catalogue.match_catalogue(df).filter("not (want <=> event_id)").collect() == []
