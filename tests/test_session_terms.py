"""Training rows of sessions from long tables of words."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riftlog.operators import lookups, session_terms as st, training
from riftlog.operators.features import fit_tfidf, tfidf_full
from riftlog.operators.sequences import session_sequences
from riftlog.sources.models import load_model, save_model
from riftlog.operators.scoring import ForestModel, score_forest


@pytest.fixture(scope="module")
def events(spark):
    rows = []
    for i in range(900):
        # One session holds half of all events; others are small; some are odd.
        key = "rca-system" if i % 2 else f"req-{i % 23:02d}"
        rows.append((key, i, f"word{i % 7} call <*> Node{i % 5} done_{i % 3}"))
    rows += [("only-marks", 1000, "<*> <*>"), ("blank", 1001, ""), (None, 1002, "lost"), ("x", 1003, None), ("two-blanks", 1004, ""), ("two-blanks", 1005, "")]
    return spark.createDataFrame(rows, "request_id string, line_no long, template string").repartition(6)


def dense(row, dim):
    out = np.zeros(dim)
    out[list(row["features"]["indices"])] = row["features"]["values"]
    return out


@pytest.mark.parametrize("limit", [4, 1000])
def test_rows_equal_those_of_texts(events, limit):
    sequences = session_sequences(events).filter("sequence <> ''")
    old = fit_tfidf(sequences, limit=limit)
    want = {r["session_id"]: r for r in old.features(sequences).collect()}
    terms = st.session_terms(events)
    new = terms.fit(limit)
    assert new == old
    ids = {r["row_no"]: r["session_id"] for r in terms.sessions.collect()}
    got = {ids[r["row_no"]]: r for r in terms.features(new).collect()}
    assert set(got) == set(want) and "blank" not in got and "two-blanks" in got
    for k, r in got.items():
        assert r["features"]["indices"] == want[k]["features"]["indices"]
        assert np.allclose(r["features"]["values"], want[k]["features"]["values"], rtol=0, atol=1e-15)
    assert [ids[i] for i in range(len(ids))] == sorted(want)


def test_all_words_and_scoring_form(spark, events, tmp_path, monkeypatch):
    terms = st.session_terms(events)
    table = terms.fit_all()
    words = [r["term"] for r in table.vocab.orderBy("idx").collect()]
    assert words == sorted(words) and table.dim == len(words)
    sequences = session_sequences(events).filter("sequence <> ''")
    want = {(r["session_id"], r["term"]): r["weight"] for r in tfidf_full(sequences, "session_id").collect()}
    got = {(r["session_id"], r["term"]): r["weight"] for r in terms.weights(table).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)
    # A vocabulary too large for the driver scores the same as a small one.
    small = st.TermTable.from_table(table.vocab)
    monkeypatch.setattr(st, "is_small", lambda *a: False)
    large = st.TermTable.from_table(table.vocab)
    assert isinstance(large, st.TermTable) and not isinstance(small, st.TermTable)
    windows = spark.createDataFrame([(1, ["word1", "call", "call"]), (2, []), (3, None), (4, ["unknown"])], "line_no long, words array<string>")
    a, b = ({r["line_no"]: r["features"] for r in m.features(windows, "words").collect()} for m in (small, large))
    assert a.keys() == b.keys() and all(a[k]["indices"] == b[k]["indices"] and np.allclose(a[k]["values"], b[k]["values"], atol=1e-15) for k in a)


def test_spread_joins_change_nothing(events, monkeypatch):
    terms = st.session_terms(events)
    want = {tuple(r) for r in terms.weights(terms.fit(30)).withColumn("weight", F.round("weight", 12)).collect()}
    monkeypatch.setattr(lookups.is_small, "__defaults__", (2, 10))
    monkeypatch.setattr(lookups, "is_small", lambda *a, **k: False)
    again = st.session_terms(events)
    assert {tuple(r) for r in again.weights(again.fit(30)).withColumn("weight", F.round("weight", 12)).collect()} == want


def test_vectors_without_python(events):
    terms = st.session_terms(events)
    model = terms.fit(30)
    rows = st.with_vectors(terms.features(model), model.dim).withColumn("x", vector_to_array("vector")).collect()
    assert rows and all(np.array_equal(r["x"], dense(r, model.dim)) for r in rows)


def test_training_from_terms_equals_training_from_texts(spark, events, tmp_path):
    sequences, terms = session_sequences(events), st.session_terms(events)
    trials = [{"run_no": 0, "n_trees": 12, "contamination": 0.1, "max_samples": 1.0}]
    windows = spark.createDataFrame([(i, [f"word{i % 9}", "call", "done_1"]) for i in range(20)], "line_no long, words array<string>")
    models = [training.train_forest(x, trials=trials)[0] for x in (sequences, terms)]
    path = save_model(spark, models[1], str(tmp_path / "forest"))
    models.append(load_model(spark, ForestModel, path))
    scores = [{r["line_no"]: r["anomaly_score"] for r in score_forest(windows, m).collect()} for m in models]
    assert scores[0] == scores[1] == scores[2] and len(set(scores[0].values())) > 1
    logs = [training.train_kmeans(x, k=3, seeds=(0,))[1] for x in (sequences, terms)]
    values = [{r["key"]: r["value"] for r in log.collect()} for log in logs]
    assert values[0].keys() == values[1].keys()
    assert all(Counter(v for k, v in x.items() if k.endswith("_count")) for x in values)


def test_nothing_to_learn_from(spark):
    rows = spark.createDataFrame([], "request_id string, template string")
    terms = st.session_terms(rows)
    assert terms.sessions.count() == terms.terms.count() == 0 and terms.fit(5).dim == 0 and terms.fit_all().dim == 0
