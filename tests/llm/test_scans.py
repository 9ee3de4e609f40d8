"""Token counts, decontamination and license scans against brute force."""

import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, normalizers

from riftlog.llm import decontaminate, license_scan, token_counts
from riftlog.llm.queries import op2_token_counts, op3_decontamination, op5_license_scan
from riftlog.llm.text import words_of
from riftlog.session import settle

from .common import ODD_TEXTS, SF, documents, odd, read, words


def reference(vocabulary, byte_fallback):
    tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback))
    tokenizer.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_token_counts_on_the_table(spark):
    count = reference(token_counts.read_vocabulary(), True)
    text = dict(read("documents")[["doc_id", "text"]].itertuples(index=False))
    rows = op2_token_counts(spark, SF).collect()
    assert len(rows) == len(text)
    assert all(r["n_tokens"] == count(text[r["doc_id"]]) and r["n_chars"] == len(text[r["doc_id"]]) for r in rows)


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_token_counts_ties(byte_fallback):
    random.seed(5)
    vocabulary = [("<unk>", 0.0)] + [(p, float(-random.randint(1, 3))) for p in
                  ("▁", "▁a", "a", "b", "ab", "ba", "aab", "abab", "▁ab", "bb", "c", "cab", "é", "▁▁")]
    if byte_fallback:
        vocabulary += [(f"<0x{b:02X}>", -50.0) for b in range(256)]
    counter, count = token_counts.Counter(vocabulary), reference(vocabulary, byte_fallback)
    for _ in range(3000):
        text = "".join(random.choice("aaabbbc é\nz€ ") for _ in range(random.randint(0, 14)))
        assert counter.count(text) == count(text), text


def test_token_counts_odd(spark):
    rows = token_counts.count_tokens(odd(spark), token_counts.read_vocabulary()).select("row.*", "n_tokens").collect()
    assert len(rows) == odd(spark).count()
    count = reference(token_counts.read_vocabulary(), True)
    assert all(r["n_tokens"] == (count(r["text"]) if r["text"] else 0) for r in rows)


def best_run(doc, item):
    """Most equal words in the best-scoring aligned run, over all shifts."""
    most = 0
    for shift in range(-len(item) + 1, len(doc)):
        score = equal = best = best_equal = 0
        for j in range(max(0, -shift), min(len(item), len(doc) - shift)):
            same = item[j] == doc[j + shift]
            score, equal = score + (1 if same else -decontaminate.PRICE), equal + same
            if score < 0:
                score = equal = 0
            if score > best:
                best, best_equal = score, equal
        most = max(most, best_equal)
    return most


def test_overlaps_planted(spark):
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    items = [[random.choice(vocabulary) for _ in range(random.choice((5, 9, 20, 40)))] for _ in range(30)]
    texts, want = [], set()
    for d in range(120):
        doc = [random.choice(vocabulary) for _ in range(60)]
        if d % 2:
            i = d % len(items)
            own = list(items[i])
            for _ in range(len(own) // 12):
                own[random.randrange(len(own))] = "changed"
            doc[20:20] = own
        texts.append(" ".join(doc).title())
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            needed = min(12, -(-len(item) * 8 // 10))
            if len(item) >= decontaminate.SHORTEST and best_run(words(t), item) >= needed:
                want.add((d, i))
    bench = spark.createDataFrame([(i, " ".join(x) + ".") for i, x in enumerate(items)] + [(99, None), (98, "")], "item_id long, text string")
    docs = documents(spark, texts)
    for block_bytes in (4_000_000, 800):
        got = decontaminate.overlaps(docs, bench, block_bytes=block_bytes).select("row.doc_id", F.explode("hits.item").alias("i")).collect()
        assert {tuple(r) for r in got} == want and len(want) > 20
    kept = decontaminate.overlaps(docs, bench, clean_only=True).select("row.*")
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(range(120)) - {d for d, _ in want}


@pytest.mark.parametrize("n", range(8, 18))
def test_every_accepted_overlap_has_a_seed(n):
    """Items of n words with every choice of up to n / 3 changed words."""
    item = [f"w{i}" for i in range(n)]
    needed = min(12, -(-n * 8 // 10))
    docs = [[f"x{i}" if i in changed else w for i, w in enumerate(item)]
            for k in range(n // 3 + 1) for changed in itertools.combinations(range(n), k)]
    want = {d for d, own in enumerate(docs) if best_run(own, item) >= needed}
    found = next(words_of(pa.array([" ".join(own) for own in docs])))
    assert found.rows == len(docs)
    assert set(decontaminate.Index([" ".join(item)]).hits(found)[0].tolist()) == want and len(want) > 1


def test_benchmark_in_bounded_blocks(spark, monkeypatch):
    """Copies of one item don't fill a block, one block is held at a time, all are reported."""
    random.seed(6)
    items = [" ".join(random.choices([f"w{i}" for i in range(900)], k=20)) for _ in range(40)]
    rows = list(enumerate(items)) + [(7, items[7])] * 60 + [(100 + i, items[8]) for i in range(30)]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    docs = documents(spark, [f"a b {t} c d" for t in items])
    held, written = [], []
    monkeypatch.setattr(decontaminate, "settle", lambda df, label: written.append(label) or settle(df, label), raising=False)
    frame = type(docs)
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: held.append(collect(self)) or held[-1])
    found = decontaminate.overlaps(docs, bench, block_bytes=2_000)
    monkeypatch.undo()
    held = [part for part in held if part and "text" in part[0]]  # not the size
    assert len(held) > 4 and written.count("block") == len(held)
    assert max(sum(len(r["text"]) for r in part) for part in held) < 4_000
    got = sorted((r["doc_id"], r["i"]) for r in found.select("row.doc_id", F.explode("hits.item").alias("i")).collect())
    assert got == sorted((items.index(t), i) for i, t in rows)


def test_overlaps_on_the_table(spark):
    docs, bench = read("documents"), read("benchmark")
    got = {(r["doc_id"], r["item_id"]) for r in op3_decontamination(spark, SF).collect()}
    want = {(d, i) for d, t in zip(docs.doc_id, docs.text) for i, b in zip(bench.item_id, bench.text) if b in t}
    assert want and want <= got


def test_overlaps_odd(spark):
    bench = spark.createDataFrame([(1, "word " * 20)], "item_id long, text string")
    got = decontaminate.overlaps(odd(spark), bench).select("row.doc_id", "hits").collect()
    assert len(got) == odd(spark).count() and {r["doc_id"] for r in got if r["hits"]} == {6}
    assert decontaminate.overlaps(odd(spark), bench.limit(0)).where(F.size("hits") > 0).count() == 0
    assert decontaminate.overlaps(odd(spark).limit(0), bench).count() == 0


def places(own, phrase):
    p = phrase.split()
    return [i for i in range(len(own) - len(p) + 1) if own[i : i + len(p)] == p]


def brute_labels(own):
    found, score = set(), 0.0
    for label, texts in license_scan.TEMPLATES.items():
        for t in texts:
            t = t.split()
            size = -(-len(t) * 10 // 9)
            blocks = [own[i : i + size] for i in range(max(1, len(own) - size + 1))]
            most = max(len(set(b) & set(t)) for b in blocks)
            score = max(score, most / len(set(t)))
            if most >= license_scan.THRESHOLD * len(set(t)) - 1e-9:
                found.add(label)
    return found, score


def check_license(rows, text):
    for r in rows:
        own = words(text[r["doc_id"]])
        at = {label: places(own, p) for p, label in license_scan.PHRASES.items()}
        starts = sorted(i for x in at.values() for i in x)
        base = {label for label, x in at.items() if x}
        met, score = brute_labels(own)
        assert r["n_words"] == len(own) and r["n_base"] == len(starts)
        assert (r["first_word"], r["last_word"]) == ((starts[0], starts[-1]) if starts else (None, None))
        assert r["base_labels"] == ",".join(sorted(base)) and r["labels"] == ",".join(sorted(base | met))
        if base or met:  # below the threshold blocks without a rare word aren't looked at
            assert r["score"] == pytest.approx(1.0 if base else score)
        assert 0 <= r["score"] <= 1


def test_license_scan_on_the_table(spark):
    text = dict(read("documents")[["doc_id", "text"]].itertuples(index=False))
    rows = op5_license_scan(spark, SF).collect()
    assert len(rows) == len(text) and any(r["base_labels"] for r in rows)
    check_license(rows, text)


def test_license_scan_planted(spark):
    random.seed(8)
    pool = " ".join([*license_scan.PHRASES, *(t for ts in license_scan.TEMPLATES.values() for t in ts)]).split() + ["of", "x", "y"]
    texts = [" ".join(random.choice(pool) for _ in range(random.randint(0, 60))) for _ in range(150)]
    for ts in license_scan.TEMPLATES.values():
        for t in ts:
            own = t.split()
            texts += [t.upper(), "x " * 40 + t + " y", " ".join(own[1:] + own[:1]), " ".join(own[:-1]), " ".join(own[:3] + ["x"] + own[3:])]
    rows = license_scan.scan(documents(spark, texts), keep=["doc_id"]).select("row.doc_id", "*").collect()
    check_license(rows, dict(enumerate(texts)))


def test_license_scan_odd(spark):
    rows = license_scan.scan(odd(spark)).select("row.*", "n_words", "labels", F.col("score")).collect()
    assert len(rows) == odd(spark).count()
    assert all(r["n_words"] == len(words(r["text"])) and r["labels"] == "" for r in rows)
