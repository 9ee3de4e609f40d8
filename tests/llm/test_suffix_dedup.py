import random

import pyarrow as pa
import pytest

from riftlog.llm import suffix_dedup as sd
from riftlog.llm.queries import op4_suffix_array
from riftlog.llm.text import words_of

from .common import documents, odd, read, words

SF = "/root/testdata/sf0.01"


def brute(docs):
    """Words inside a run of LENGTH words that another document has too."""
    holders = {}
    own = {i: words(t) for i, t in docs}
    for i, w in own.items():
        for a in range(len(w) - sd.LENGTH + 1):
            holders.setdefault(tuple(w[a : a + sd.LENGTH]), set()).add(i)
    covered, cut = {}, {}
    for i, w in own.items():
        for a in range(len(w) - sd.LENGTH + 1):
            who = holders[tuple(w[a : a + sd.LENGTH])]
            if len(who) > 1:
                covered.setdefault(i, set()).update(range(a, a + sd.LENGTH))
                if i != min(who):
                    cut.setdefault(i, set()).update(range(a, a + sd.LENGTH))
    return covered, cut


def covered(spans):
    out = {}
    for i, first, last in spans:
        out.setdefault(i, set()).update(range(first, last))
    return out


def span(row):
    return row["id"], row["first"], row["last"]


def test_every_run_holds_one_retained_place():
    random.seed(2)
    for pool in (5, 2000):
        text = [f"w{random.randrange(pool)}" for _ in range(700)]
        array = pa.array(["a b", " ".join(text[:300]), " ".join(text[300:]), "", " ".join(text[250:420])])
        piece = next(words_of(array))
        at, key, fewest, most = sd.retained(piece)
        places = {r: [p - piece.row_start[r] for p in at if piece.row[p] == r] for r in range(5)}
        assert not places[0] and not places[3]
        for r in (1, 2, 4):
            n = piece.row_start[r + 1] - piece.row_start[r]
            runs = sorted(p - d for p, x, y in zip(at - piece.row_start[r], fewest, most) if 0 <= p < n for d in range(x, y + 1))
            assert runs == list(range(n - sd.LENGTH + 1))  # each has one place of its own
        if pool == 2000:
            assert len(at) < 2.6 * len(piece.hash) / (sd.SIDE + 2)


def test_on_the_table(spark):
    docs = read("documents", SF)
    want, _ = brute(list(zip(docs.doc_id.tolist(), docs.text)))
    rows = op4_suffix_array(spark, SF).collect()
    got = covered([(r["doc_id"], r["first_word"], r["last_word"] + 1) for r in rows])
    assert got == want and want
    ordered = sorted((r["doc_id"], r["first_word"], r["last_word"]) for r in rows)
    assert all(a[0] != b[0] or a[2] + 1 < b[1] for a, b in zip(ordered, ordered[1:]))


@pytest.mark.parametrize("pieces", [1, 7])
def test_planted_and_hot(spark, pieces):
    """Passages of 49 to 120 words in a few or most documents, families with changed words."""
    random.seed(5)
    pool = [f"w{i}" for i in range(3000)]
    take = lambda n: random.choices(pool, k=n)
    hot, some = take(60), [take(n) for n in (49, 50, 51, 90, 120)]
    texts = []
    for d in range(160):
        own = take(40)
        if d % 3:
            own += hot + take(30)
        if d % 4 == 0:
            own += some[d // 4 % 5] + take(20)
        texts.append(own)
    base = take(220)
    for _ in range(40):
        own = list(base)
        for _ in range(3):
            own[random.randrange(len(own))] = random.choice(pool)
        texts.append(own)
    line = take(7)
    texts += [["on"] * random.randint(40, 400) for _ in range(20)] + [take(9) + line * random.randint(5, 60) + take(5) for _ in range(20)]
    docs = [(d, " ".join(t).capitalize()) for d, t in enumerate(texts)]
    want, cut = brute(docs)
    table = documents(spark, [t for _, t in docs])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(pieces))
    try:
        spans, cuts = sd.repeats(table)
        got, got_cut = covered(map(span, spans.collect())), covered(map(span, cuts.collect()))
        left = sd.cut_repeats(table, length_col="n_chars").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == want
    assert got_cut == cut
    after = {r["doc_id"]: r for r in left}
    for d, t in docs:
        own = [w for i, w in enumerate(words(t)) if i not in cut.get(d, ())]
        assert (d in after) == bool(own)
        if own:
            assert words(after[d]["text"]) == own and after[d]["n_chars"] == len(after[d]["text"])
            assert d in cut or after[d]["text"] == t


def test_run_between_many_variants(spark):
    """A hot phrase between headers and footers that are each shared by more rows than a
    piece: two holders of a run on both sides of the seed are far apart in either order."""
    random.seed(8)
    pool = [f"w{i}" for i in range(3000)]
    take = lambda n: random.choices(pool, k=n)
    phrase, heads, feet = take(20), [take(15) for _ in range(12)], [take(15) for _ in range(12)]
    texts = [take(30) + h + phrase + f + take(30) for h in heads for f in feet for _ in range(2)]
    random.shuffle(texts)
    docs = [(d, " ".join(t)) for d, t in enumerate(texts)]
    want, cut = brute(docs)
    names = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        spans, cuts = sd.repeats(documents(spark, [t for _, t in docs]))
        got, got_cut = covered(map(span, spans.collect())), covered(map(span, cuts.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(want) == len(docs) and got == want and got_cut == cut


@pytest.mark.parametrize("gather", [25, 400])
def test_beginnings_larger_than_a_piece(spark, gather, monkeypatch):
    """A passage in hundreds of surroundings, in copies and in near-copies, is compared by
    classes; a handful of them stand for all its places."""
    random.seed(9)
    pool = [f"w{i}" for i in range(3000)]
    take = lambda n: random.choices(pool, k=n)
    hot, copy = take(70), take(150)
    texts = [take(random.randint(0, 60)) + hot[: random.choice([70, 70, 55])] + take(random.randint(0, 60)) for _ in range(300)] + [copy] * 60
    for _ in range(60):
        own = list(copy)
        own[random.randrange(len(own))] = "changed"
        texts.append(own)
    docs = [(d, " ".join(t)) for d, t in enumerate(texts)]
    random.shuffle(docs)
    want, cut = brute(docs)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    rows = sd.suffixes(table, "doc_id", "text")
    spans = sd._merge(sd.class_spans(rows.where("id IS NOT NULL")).where("kind = 0").drop("kind"))
    assert covered(map(span, spans.collect())) == want  # all of them by classes
    monkeypatch.setattr(sd, "GATHER", gather)
    spans, cuts = sd.repeats(table)
    assert covered(map(span, spans.collect())) == want and covered(map(span, cuts.collect())) == cut


def test_spans_joined():
    rng = random.Random(12)
    for _ in range(50):
        spans = [(rng.randint(1, 3), rng.randint(-1, 1), a, a + rng.randint(1, 9)) for a in (rng.randint(0, 60) for _ in range(rng.randint(0, 30)))]
        columns = [sd.np.array([s[i] for s in spans], dtype=sd.np.int64) for i in range(4)]
        got = list(zip(*(c.tolist() for c in sd._joined(*columns))))
        cover = lambda xs: {(i, t, w) for i, t, a, b in xs for w in range(a, b)}
        assert cover(got) == cover(spans) and len(got) <= len(spans)
        assert all(x[:2] != y[:2] or x[3] < y[2] for x, y in zip(got, got[1:]))


def test_classes_of_a_hot_passage_are_few(spark):
    random.seed(10)
    take = lambda n: [f"w{random.randrange(10**8)}" for _ in range(n)]
    hot, runs = take(60), []
    for n in (100, 400):
        table = documents(spark, [" ".join(take(60) + hot + take(60)) for _ in range(n)])
        members = sd.suffixes(table, "doc_id", "text")
        sides = ["key", "after", "before"]
        classes = members.groupBy(*sides).agg(sd.F.min("id").alias("least"), sd.F.max("id").alias("most"))
        for side in ("after", "before"):
            order = ["key", side, "least", "most"]
            classes = classes.coalesce(1).sortWithinPartitions(*order).mapInArrow(sd.shared_words(side), sd.T.StructType([*classes.schema, sd.T.StructField(f"{side}_words", sd.T.IntegerType())]))
        left = classes.where(sd.F.col("after_words") + sd.F.col("before_words") >= sd.SIDE)
        runs.append(left.selectExpr("key", "substring(after, 1, 3 * after_words) a", "substring(before, 1, 3 * before_words) b").distinct().count())
    assert runs[1] <= 2 * runs[0] <= 20


def test_two_texts_under_one_id_and_text_ids(spark):
    random.seed(11)
    take = lambda n: [f"u{random.randrange(10**6)}" for _ in range(n)]
    shared, alone = take(80), " ".join(take(100))
    rows = [("a", " ".join(shared)), ("b", " ".join(take(10) + shared + take(5))), ("b", alone), ("c", alone + " more"), ("b", None), (None, " ".join(shared))]
    table = spark.createDataFrame(rows, "doc_id string, text string")
    spans, cuts = sd.repeats(table)
    found = {(r["id"], r["first"], r["last"]) for r in spans.collect()}
    assert found == {("a", 0, 80), ("b", 10, 90), ("b", 0, 100), ("c", 0, 100)}
    assert cuts.count() == 2
    numbered = spark.createDataFrame([(5, " ".join(take(10) + shared)), (4, " ".join(shared)), (5, alone)], "doc_id int, text string")
    left = sorted((r["doc_id"], len(words(r["text"]))) for r in sd.cut_repeats(numbered).collect())
    assert left == [(4, 80), (5, 10), (5, 100)]


@pytest.mark.parametrize("bits", [3, 16, 25])
def test_no_cut_is_missed_by_the_bitmap(spark, bits, monkeypatch):
    monkeypatch.setattr(sd, "BITS", bits)
    rows = spark.range(-2000, 2000).selectExpr("id AS _own_id", "xxhash64(id) AS _own_text")
    cuts = rows.where("pmod(_own_id, 5) = 0").toDF("_cut_id", "_cut_text")
    found = sd.with_chance(rows, cuts)
    assert found.where("pmod(_own_id, 5) = 0 AND NOT _chance").count() == 0 and found.count() == 4000
    assert bits < 20 or found.where("_chance").count() < 810


def test_odd(spark):
    docs = odd(spark)
    spans, cuts = sd.repeats(docs)
    assert spans.count() == cuts.count() == 0
    kept = sd.cut_repeats(docs)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert sd.cut_repeats(docs.limit(0)).count() == 0
    whole = documents(spark, ["w " * 60, None, "w " * 55, "x"])
    assert sorted(r["doc_id"] for r in sd.cut_repeats(whole).collect()) == [0, 1, 3]
