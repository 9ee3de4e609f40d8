"""The pipeline against a brute-force version, and on odd rows."""

from collections import Counter

import corpus_pipeline
from riftlog.llm import decontaminate, toxicity
from riftlog.session import settle

from .common import SCHEMA, SF, odd, read, words
from .test_dart_minhash import brute as groups
from .test_mixing import water
from .test_scans import best_run
from .test_suffix_dedup import brute as passages


def test_against_brute_force(spark):
    docs, bench = read("documents"), read("benchmark")
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.learn(table, spark.read.parquet(f"{SF}/labels.parquet"))
    score = {r["doc_id"]: r["toxicity"] for r in toxicity.score(table, model).select("row.doc_id", "toxicity").collect()}
    kept = {d: t for d, t in zip(docs.doc_id.tolist(), docs.text) if score[d] < 0.7}
    first = groups(list(kept.items()))
    kept = {d: t for d, t in kept.items() if first[d] == d}
    _, cut = passages(list(kept.items()))
    left = {d: [w for i, w in enumerate(words(t)) if i not in cut.get(d, ())] for d, t in kept.items()}
    kept = {d: t for d, t in kept.items() if left[d] or d not in cut}
    items = [words(t) for t in bench.text]
    bad = {d for d in kept for i in items if len(i) >= 8 and best_run(left[d], i) >= min(12, -(-len(i) * 8 // 10))
           and set(left[d]) & set(i)}
    want = {d: left[d] for d in kept if d not in bad}

    source = dict(zip(docs.doc_id.tolist(), docs.source))
    stages, seen = dict(corpus_pipeline.STAGES), table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = settle(stage(spark, seen, SF), name)
        assert seen.columns == table.columns
    rows = seen.collect()
    assert {r["doc_id"]: words(r["text"]) for r in rows} == want and len(rows) == len(want)
    assert all(r["n_chars"] == len(r["text"]) and r["source"] == source[r["doc_id"]] for r in rows)
    mixed = stages["mixture"](spark, seen, SF).collect()
    size = {r["doc_id"]: len(r["text"].split()) for r in rows}
    sizes, taken, most = Counter(), Counter(), Counter()
    for d, n in size.items():
        sizes[source[d]] += n
        most[source[d]] = max(most[source[d]], n)
    for r in mixed:
        taken[r["source"]] += size[r["doc_id"]]
    target = water(sizes)
    assert all(abs(taken[s] - target[s]) <= most[s] for s in sizes)
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 2
    assert {r["doc_id"]: r["text"] for r in mixed}.items() <= {r["doc_id"]: r["text"] for r in rows}.items()
    assert Counter(r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()) == Counter(r["doc_id"] for r in mixed)


def test_odd_and_empty(spark):
    for docs in (odd(spark), odd(spark).limit(0), spark.createDataFrame([], SCHEMA)):
        for name, stage in corpus_pipeline.STAGES:
            docs = settle(stage(spark, docs, SF), name)
            assert docs.schema.names[:5] == [x.split()[0] for x in SCHEMA.split(", ")]


def test_two_texts_under_one_id(spark):
    """A copy and a text of its own under one id: the stages keep the latter whole."""
    alone, copy = " ".join(f"word{i}" for i in range(120)), " ".join(f"other{i}" for i in range(120))
    rows = [(1, copy, "en", "s", len(copy)), (2, copy, "en", "s", len(copy)), (2, alone, "en", "s", len(alone))]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        docs = settle(stage(spark, docs, SF), name)
    assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == [(1, copy), (2, alone)]


def test_registered():
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert sorted(int(q[2:].split("_")[0]) for q in entry.queries() if q.startswith("op") and q[2].isdigit()) == list(range(1, 14))
