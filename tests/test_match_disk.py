"""Matching and mining leave one table behind, and match by marks and bitmaps what fits as a whole."""

import os

import numpy as np
from pyspark.sql import functions as F

from riftlog.operators import templates as tpl
from riftlog.operators.leaf import Tree
from riftlog.session import scratch_path, scratch_root


def long_lines(spark):
    """Lines of few and of many tokens, over one small vocabulary."""
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(f"w{'abcdefgh'[j]}" for j in rng.integers(0, 8, int(rng.choice([1, 3, 150]))))) for i in range(90)]
    return spark.createDataFrame(rows + [(90, None), (91, "  ")], "line_no long, message string").repartition(3)


def kinds_after(spark, run):
    folder = f"{scratch_root(spark)}/riftlog"
    os.makedirs(folder, exist_ok=True)
    before = set(os.listdir(folder))
    out = run()
    return out, sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before)


def test_only_the_last_table_stays(spark):
    rows, tree = long_lines(spark), Tree(depth=2, children=2)
    known, left = kinds_after(spark, lambda: tpl.mine_templates(rows, tree=tree))
    assert left == ["templates"]
    tagged, left = kinds_after(spark, lambda: tpl.tag_rows(rows, known, tree=tree))
    assert left == ["matches"]
    got = {r["line_no"]: r["log_key"] for r in tagged.collect()}
    assert len(got) == 92 and got[90] is None and got[91] == "UNMAPPED"
    texts = {r["log_key"]: r["template"].split(" ") for r in known.collect()}
    for r in rows.filter("line_no < 90").collect():
        template, tokens = texts[got[r["line_no"]]], r["message"].split(" ")
        assert len(template) == len(tokens) and all(t in ("<*>", s) for t, s in zip(template, tokens))


def test_messages_do_not_move(spark):
    """Rows meet their key by a short name; a caller who asks for none moves no text."""
    rows = long_lines(spark)
    path = scratch_path(spark, "rows")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    tagged = tpl.tag_rows(rows, tpl.mine_templates(rows)).select("line_no", "log_key")
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    join = next(x for x in plan.splitlines() if "Join" in x)
    assert "_short" in join and "shape" not in join
    above = plan[: plan.index("Join")]
    assert "message" not in above


def test_rare_tokens_are_fixed_ones_and_marks_hold(spark):
    names = ["<*> <*>", "a <*>", "a b", "<*> b"]
    keyed = spark.createDataFrame([(i, t, 2, "") for i, t in enumerate(names)], "_template long, template string, n_tokens int, first_token string")
    places = {(r["_template"], r["place"]): r["at"] for r in tpl._hashed(keyed, "_template", "template").select("_template", F.posexplode("_ats").alias("place", "at")).collect()}
    found = {r["_template"]: r for r in tpl._rare_tokens(tpl._hashed(keyed, "_template", "template")).collect()}
    assert found[0]["_at"] == places[0, 0]
    assert found[1]["_at"] == places[1, 1] and found[3]["_at"] == places[3, 2] and found[2]["_at"] in (places[2, 1], places[2, 2])
    assert found[1]["_t0"] & ~found[2]["_t0"] == 0 and found[1]["_t1"] & ~found[2]["_t1"] == 0
