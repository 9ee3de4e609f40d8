"""What mining holds and how often it hands over rows."""

import random
import tracemalloc

import pandas as pd

from riftlog.operators import templates as tpl
from riftlog.operators.leaf import Leaf


def test_a_leaf_holds_tokens_as_numbers():
    rng = random.Random(4)
    shapes = [" ".join(f"w{rng.randrange(3000)}" for _ in range(50)) for _ in range(1500)]
    tracemalloc.start()
    leaf = Leaf()
    for at in range(0, len(shapes), 100):
        leaf.add(shapes[at : at + 100], range(100), [1] * 100, 0.9)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert leaf.texts == shapes and held < 45 * 50 * len(shapes)


def test_rows_of_many_chunks_and_leaves_go_out_together():
    n = 3000
    batch = pd.DataFrame({
        "n_tokens": [2] * n, "first_token": sorted(f"a{i % 500}" for i in range(n)), "shape": [f"x y{chr(97 + i % 26)}" for i in range(n)],
        "n_rows": [1] * n, "first_line_no": range(n), "known_no": pd.Series([None] * n, dtype=object),
    })
    frames = list(tpl._mine_sorted(0.9, 5)(iter([batch])))
    assert len(frames) == 1 and frames[0]["n_rows"].sum() == n and frames[0]["first_token"].nunique() == 500


def test_only_current_versions_are_asked_for(spark):
    texts = [f"go {a} {b}" for a in ("p", "q", "r") for b in ("s", "t")]
    shapes = tpl.distinct_shapes(tpl.with_shape(spark.createDataFrame(list(enumerate(texts)), "line_no bigint, message string")))
    every = tpl.mine_versions(shapes)
    last = tpl.mine_versions(shapes, versions=False)
    assert every.count() > last.count()
    assert sorted(map(str, last.collect())) == sorted(map(str, every.filter("is_current").collect()))
