import hashlib
import random

import pytest

from riftlog.llm import lz_fingerprint as lz
from riftlog.llm.queries import op7_lz_fingerprint

from .common import SF, documents, odd, read


def phrases(text):
    found, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in found:
            found.add(text[start:end])
            start = end
    return found


def check(rows, docs):
    """``docs``: (doc_id, text) by descending id."""
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(docs)
    prints = {}
    for i, (doc_id, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        r = got[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == lz.as_text(lz.fingerprint(text)) and r["edited_fingerprint"] == lz.as_text(lz.fingerprint(changed))
        assert r["near_edited"] == lz.likeness(lz.fingerprint(text), lz.fingerprint(changed))
        assert r["near_next"] == lz.likeness(lz.fingerprint(text), lz.fingerprint(following))
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]


def test_phrase_sets():
    random.seed(1)
    for n in (0, 1, 2, 7, 300, 5000):
        text = "".join(random.choice("abcé\U0001F600") for _ in range(n))
        ends, _ = lz.parse(text)
        found = [text[a:b] for a, b in zip([0, *ends], ends)]
        assert set(found) == phrases(text) and len(found) == len(set(found))
        h = lz.phrase_hashes(text, ends)
        own = dict(zip(found, h))
        other = lz.phrase_hashes("xyz" + text, [3, *[e + 3 for e in ends]])[1:]
        assert len(set(h.tolist())) == len(h) and (other == h).all() and len(own) == len(h)
        half = n // 2
        _, ends2 = lz.parse(text, half, "zz" + text[:half])
        changed = text[: n - half] + "zz" + text[:half]
        assert {changed[a:b] for a, b in zip([0, *ends2], ends2)} == phrases(changed)


def test_likeness_estimates_the_sets():
    random.seed(4)
    pool = [f"w{i} " for i in range(500)]
    a = [random.choice(pool) for _ in range(3000)]
    for share in (0.1, 0.5, 0.9):
        b = [x if random.random() < share else random.choice(pool) for x in a]
        x, y = phrases("".join(a)), phrases("".join(b))
        assert lz.likeness(lz.fingerprint("".join(a)), lz.fingerprint("".join(b))) == pytest.approx(len(x & y) / len(x | y), abs=0.2)
    small, other = "abcab", "abcxx"
    assert lz.likeness(lz.fingerprint(small), lz.fingerprint(other)) == len(phrases(small) & phrases(other)) / len(phrases(small) | phrases(other))


def test_on_the_table(spark):
    docs = read("documents").sort_values("doc_id", ascending=False)
    check(op7_lz_fingerprint(spark, SF).collect(), list(zip(docs.doc_id.tolist(), docs.text)))


@pytest.mark.parametrize("ids", [[5], [0, 1], [-9, -1, 4, 2**40, 7, 0]])
def test_few(spark, ids):
    random.seed(7)
    rows = [(i, "".join(random.choice("ab c") for _ in range(random.randint(0, 40)))) for i in ids]
    got = lz.neighbours(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(got, sorted(rows, reverse=True))


def test_odd(spark):
    got = lz.neighbours(odd(spark)).collect()
    assert len(got) == odd(spark).count()
    for r in got:
        if r["doc_id"] is None:
            assert r["n_chars"] == len("no id here") and r["near_next"] == 0.0
        if r["n_chars"] == 0:
            assert r["fingerprint"] == r["edited_fingerprint"] == "" and r["near_edited"] == 1.0
    assert lz.neighbours(odd(spark).limit(0)).count() == 0
    assert lz.neighbours(documents(spark, ["x"]).selectExpr("cast(null as long) doc_id", "text")).count() == 1
