"""Registered queries at the smallest scale."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
SOME = ("parse_log", "request_id_top50", "template_keys", "session_pieces", "tfidf_capped", "context_payload")


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert all(callable(q) for q in entry.queries().values())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["session_id", "piece", "n_events", "sequence"] and df.count() > 0


@pytest.mark.parametrize("name", SOME)
def test_against_sql(spark, name):
    ok, note = compare(spark, duck(SF), name, SF)
    assert ok, note
