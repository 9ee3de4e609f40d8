"""Toxicity, quality and language: held-out accuracy, planted cases and odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riftlog.llm import language_id, quality_model, toxicity
from riftlog.llm.queries import op8_language, op9_toxicity, op10_quality
from riftlog.llm.text import words_of
import pyarrow as pa

from .common import documents, odd, read, words

SF = "/root/testdata/sf0.01"


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_words():
    texts = ["Ab, cd", "", "éa b9", None, "x" * 5000 + " y", "a b c d e f"]
    array = pa.array(["skipped", *texts])[1:]
    for size in (3, 2_000_000):
        seen = {}
        for piece in words_of(array, size):
            for r in range(piece.rows):
                a, b = piece.row_start[r], piece.row_start[r + 1]
                raw = (texts[piece.first + r] or "").encode()
                seen[piece.first + r] = [raw[s:e].decode().lower() for s, e in zip(piece.start[a:b], piece.end[a:b])]
                assert (piece.row[a:b] == r).all()
        assert seen == {i: words(t) for i, t in enumerate(texts)}
    whole = next(words_of(pa.array(["a b a b a", "b a"])))
    grams, at = whole.ngrams(2)
    assert list(at) == [0, 1, 2, 3, 5] and grams[0] == grams[2] and grams[1] == grams[4] and grams[0] != grams[1]


def test_language(spark):
    rows = op8_language(spark, SF).toPandas().merge(read("documents", SF), on="doc_id")
    assert len(rows) == 1000 and (rows.held_out == rows.doc_id.map(held)).all()
    own = rows[rows.held_out]
    assert (own.lang == own.lang_pred).mean() > 0.98 and rows.score.between(0, 1).all()


@pytest.mark.parametrize("query,label,least", [(op9_toxicity, "toxic", 0.93), (op10_quality, "quality", 0.97)])
def test_held_out(spark, query, label, least):
    rows = query(spark, SF).toPandas()
    assert len(rows) == 1000 and (rows.held_out == rows.doc_id.map(held)).all() and rows.score.between(0, 1).all()
    own = rows.merge(read("labels", SF), on="doc_id").query("held_out")
    assert (own.predicted == own[label]).mean() > least


def test_offending_sentences(spark):
    random.seed(2)
    pool = [f"word{i}" for i in range(300)]
    texts, bad = [], {}
    for d in range(400):
        sentences = [" ".join(random.choices(pool, k=8)) for _ in range(6)]
        if d % 4 == 0:
            bad[d] = random.randrange(6)
            sentences[bad[d]] = f"you nasty word{d % 300} scoundrel"
        texts.append(". ".join(sentences) + ".")
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(d, int(d in bad)) for d in range(400)] + [(None, 1), (1, None), (900, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    for r in toxicity.score(docs, model).select("row.doc_id", "toxicity", "offending").collect():
        d = r["doc_id"]
        assert (r["toxicity"] >= 0.7) == (d in bad)
        if d in bad:
            first = len(words(". ".join(texts[d].split(". ")[: bad[d]])))
            assert [(s["first_word"], s["last_word"]) for s in r["offending"]] == [(first, first + 3)]


def test_odd_rows(spark):
    docs = odd(spark)
    n = docs.count()
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.withColumn("toxic", F.lit(None).cast("int")).withColumn("quality", F.lit(1))):
        assert toxicity.score(docs, toxicity.learn(docs, known)).where("toxicity between 0 and 1").count() == n
        assert quality_model.classify(docs, known).where("quality between 0 and 1").count() == n
    for where in (None, F.lit(False)):
        got = language_id.predict(docs, language_id.fit(docs, where=where)).select("row.text", "lang_pred", "cosine").collect()
        assert len(got) == n and all(0 <= r["cosine"] <= 1 for r in got)
        for r in got:
            letter = any(c.isalpha() for c in r["text"] or "")
            assert r["lang_pred"] == ("en" if letter and where is None else "und")
    none = docs.limit(0)
    assert toxicity.score(none, toxicity.learn(none, labels)).count() == 0
    assert quality_model.classify(none, labels).count() == 0
    assert language_id.predict(none, language_id.fit(none)).count() == 0


def test_trees_against_plain_traversal():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(quality_model.STATISTICS))).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality_model.fit_trees(x[:400], y[:400])
    assert ((model.scores(x[400:]) > 0.5) == y[400:]).mean() > 0.9
    for i in range(20):
        total = model.base
        for feature, threshold, value in zip(model.feature, model.threshold, model.value):
            node = 0
            for _ in range(quality_model.DEPTH):
                node = 2 * node + 1 + (x[i, feature[node]] > threshold[node])
            total += value[node - (2**quality_model.DEPTH - 1)]
        assert model.raw_scores(x[i : i + 1])[0] == pytest.approx(total)
