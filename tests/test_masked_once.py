"""Training on a log masks each message once, whatever number of passes reads it."""

import datetime

import pytest
from pyspark.sql import functions as F

from checks import queries
from riftlog.operators import scoring, templates as tpl


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    kinds = ["click", "view", "error", "signup", "purchase"]
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, start + datetime.timedelta(seconds=i), i % 9, kinds[i % 5], i / 4, "{}") for i in range(400)]
    path = str(tmp_path_factory.mktemp("log"))
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    events.write.parquet(f"{path}/events.parquet")
    return path


def test_training_masks_a_message_once(spark, folder, monkeypatch):
    lines = queries.cleaned(spark, folder).count()
    seen, plain = spark.sparkContext.accumulator(0), tpl.shape_of

    @F.udf("string")
    def counted(shape):
        seen.add(1)
        return shape

    monkeypatch.setattr(tpl, "shape_of", lambda message: counted(plain(message)))
    sequences, windows = queries._training(spark, folder)
    assert sequences.count() and windows.count()
    assert 0 < seen.value <= lines


def test_given_shapes_change_nothing(spark, folder):
    rows = queries.stored(queries.cleaned(spark, folder))
    shaped = queries.stored(tpl.with_shape(rows))
    plain = lambda df, *c: sorted(map(str, df.select(*c).collect()))
    known, again = tpl.mine_templates(rows), tpl.mine_templates(shaped, masked="shape")
    assert plain(known, *known.columns) == plain(again, *known.columns)
    want = tpl.tag_rows(rows, known)
    assert plain(want, *want.columns) == plain(tpl.tag_rows(shaped, known, masked="shape"), *want.columns)
    want = scoring.with_unit(rows, "template", known, "message")
    assert plain(want, *want.columns) == plain(scoring.with_unit(shaped, "template", known, "message", masked="shape"), *want.columns)
