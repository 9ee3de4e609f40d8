"""What joins and matching move: no copies of a table, no copies of a text per token."""

from riftlog.operators import templates as tpl
from riftlog.operators.lookups import BROADCAST_BYTES, lookup_join


def test_a_large_table_moves_once(spark):
    left = spark.createDataFrame([(f"k{i % 7}", i) for i in range(50)], "k string, o bigint")
    right = spark.createDataFrame([(f"k{i}", i) for i in range(20)], "k string, v int")
    large = lookup_join(left, right, ["k"], "left", ["o"], max_rows=3)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "explode" not in plan
    # Where the session does not split hot partitions, keys are still spread.
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        spread = lookup_join(left, right, ["k"], "left", ["o"], max_rows=3, salts=4)
        assert "explode" in spread._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(str, spread.collect())) == sorted(map(str, large.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_a_broadcast_is_small(spark):
    """The driver holds a table several times while it is broadcast."""
    left = spark.createDataFrame([(i, i) for i in range(5)], "k bigint, o bigint")
    wide = spark.range(12).selectExpr("id AS k", f"repeat('x', {BROADCAST_BYTES // 8}) AS v")
    plan = lookup_join(left, wide, ["k"], "left")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower()


def test_matching_moves_no_text_per_token(spark, monkeypatch):
    calls, real = [], tpl.lookup_join

    def join(rows, table, on, *rest):
        calls.append((set(rows.columns), tuple(on)))
        return real(rows, table, on, *rest)

    monkeypatch.setattr(tpl, "lookup_join", join)
    texts = [f"go {'word ' * 30}end{chr(97 + i)}" for i in range(6)]
    rows = spark.createDataFrame(list(enumerate(texts)), "line_no bigint, message string")
    known = tpl.mine_templates(rows.filter("line_no < 4"), similarity=1.0)
    shapes = tpl.distinct_shapes(tpl.with_shape(rows))
    got = {r["shape"]: r["template"] for r in tpl.match_shapes(shapes, known).collect()}
    assert got == {t: t for t in texts[:4]}
    assert calls and not any(columns & {"shape", "template"} for columns, _ in calls)
