"""Collocations against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riftlog.llm import collocations
from riftlog.llm.collocations import collocations as mine, phrase_counts

from .common import lower, odd


def brute(rows, least, top):
    """rows: (text, lang)."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i : i + n])] += 1
    out = set()
    for lang, f in counts.items():
        big = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in big.items():
            inside = any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in big.items())
            if not inside:
                score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return out


def corpus(n, seed=1):
    random.seed(seed)
    vocabulary = ["the", "of", "A", "a", "x\x01", "é", "Zug", "b", "..", "c", "dd", "É", "state"]
    rows = []
    for _ in range(n):
        words = [random.choice(vocabulary) + random.choice(["", "", "", "", ",", ".", "\n"]) for _ in range(random.randint(0, 40))]
        if random.random() < 0.4:
            words[1:1] = ["new", "york", "City", "hall", "of", "fame", "of", "the", "the", "the"]
        rows.append((random.choice([" ", "  ", "\t "]).join(words), random.choice(["en", "en", "de", None, "und"])))
    return rows


def got(frame):
    return {tuple(r) for r in frame.collect()}


@pytest.mark.parametrize("prefix_rows, top", [(1 << 14, 2000), (200, 2000), (15, 7)])
def test_equals_brute_force(spark, prefix_rows, top):
    rows = corpus(400)
    frame = spark.createDataFrame(rows, "text string, lang string")
    assert got(mine(frame, least=12, top=top, prefix_rows=prefix_rows, group_words=200)) == brute(rows, 12, top)


def test_saturated_bitmaps_and_small_chunks(spark, monkeypatch):
    """What the bitmaps let through by chance is counted exactly; texts are cut at breaks."""
    rows = corpus(150, 2) + [(" ".join(t for t, _ in corpus(100, 3)), "en")]
    frame = spark.createDataFrame(rows, "text string, lang string")
    bits = collocations.bitmap

    def full(hashed):
        found = bits(hashed)
        found.raw[:] = 255
        return found

    monkeypatch.setattr(collocations, "bitmap", full)
    assert got(mine(frame, least=8)) == brute(rows, 8, 2000)


def test_a_long_text_is_cut_at_breaks_only():
    import pyarrow as pa

    random.seed(4)
    text = "".join(random.choice(["ab cd", " ", ". ", "ef\n", "é "]) for _ in range(1_500_000))
    parts = list(collocations.texts(pa.RecordBatch.from_arrays([pa.array([text]), pa.array(["en"])], names=["text", "lang"])))
    assert len(parts) > 1
    pieces = []
    for p in parts:
        line = p.words.take(pa.array(p.number)).to_pylist()
        cuts = [0, *(i + 1 for i, x in enumerate(p.linked) if not x), len(line)]
        pieces += [line[a:b] for a, b in zip(cuts, cuts[1:])]
    assert pieces == [w for x in re.split(r"[.,;:!?\x0A-\x0D]", text) if (w := re.findall(r"[^\x20\x09]+", x))]


def test_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame(
        [("en", "p q", 2, 10**13), ("en", "p", 1, 3 * 10**13 + 1), ("en", "q", 1, 10**13 + 7)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("en", 10**14 + 3)], "lang string, n long")
    (row,) = collocations.scored(counts, totals).collect()
    assert row["score"] == 1000 * 10**13 * (10**14 + 3) // ((3 * 10**13 + 1) * (10**13 + 7))


def test_odd_rows(spark):
    frame = odd(spark).withColumn("phrase", F.lit(1)).withColumn("n", F.lit(None).cast("int"))
    rows = [(r["text"], r["lang"]) for r in frame.collect()]
    assert got(mine(frame, least=3)) == brute(rows, 3, 2000)
    counts, totals = phrase_counts(frame, least=10**6)
    words = Counter()
    for text, lang in rows:
        words[lang or "und"] += len(re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", text or ""))
    assert counts.count() == 0 and {tuple(r) for r in totals.collect()} == set(words.items())


def test_empty_table(spark):
    frame = spark.createDataFrame([], "text string, lang string")
    assert mine(frame).count() == 0
    assert mine(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).count() == 0
