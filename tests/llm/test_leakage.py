import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.llm import leakage as L
from tracewright.llm.textkit import plain_words


@pytest.fixture(scope="module")
def texts():
    random.seed(4)
    vocabulary = [f"word{k}" for k in range(90)] + ["the", "of", "und"]
    items = [(k, " ".join(random.choice(vocabulary) for _ in range(random.choice([5, 12, 13, 14, 40])))) for k in range(25)] + [(25, None), (26, ""), (0, "word1 " * 20)]
    docs = []
    for k in range(300):
        words = [random.choice(vocabulary + ["other", "thing"]) for _ in range(60)]
        if k % 4 == 0:
            src = plain_words(items[k % 25][1])
            n = min(len(src), random.choice([11, 12, 13, 14, 30]))
            at = random.randint(0, len(src) - n)
            words[20:20] = [w.upper() if k % 8 else w[:2] + "​" + w[2:] for w in src[at : at + n]]
        docs.append((k, (", " if k % 3 else "\n") .join(words)))
    return items, docs + [(900, None), (901, ""), (902, "x" * 200_000), (903, "word1 " * 5000), (5, docs[5][1])]


def test_leaks_equal_brute_force(spark, texts):
    items, docs = texts
    grams: dict = {}
    for i, t in items:
        w = plain_words(t)
        for k in range(len(w) - 12):
            grams.setdefault(tuple(w[k : k + 13]), set()).add(i)
    want = {(d, i) for d, t in docs for w in [plain_words(t)] for k in range(len(w) - 12) for i in grams.get(tuple(w[k : k + 13]), ())}
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("terms", F.lit(1)).withColumn("words", F.lit("clash"))
    i = spark.createDataFrame(items, "item_id bigint, text string")
    got = L.leaks(d, i).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) > 20
    assert min(r.words for r in got) >= 13


def test_empty_tables(spark, texts):
    d = spark.createDataFrame(texts[1], "doc_id bigint, text string")
    i = spark.createDataFrame(texts[0], "item_id bigint, text string")
    assert L.leaks(d.limit(0), i).count() == 0 and L.leaks(d, i.limit(0)).count() == 0


def test_blocks_give_the_same(spark, texts, monkeypatch):
    d = spark.createDataFrame(texts[1], "doc_id bigint, text string")
    i = spark.createDataFrame(texts[0], "item_id bigint, text string")
    whole = {tuple(r) for r in L.leaks(d, i).collect()}
    monkeypatch.setattr(L, "ITEMS_PER_BLOCK", 7)
    assert {tuple(r) for r in L.leaks(d, i).collect()} == whole


def test_paraphrases_survive_a_changed_word(spark):
    item = "assume that palette glacier ships without runner cluster and describe how partial branch can still render flaky payload"
    words = item.split()
    words[6] = "lacking"
    d = spark.createDataFrame([(1, "well " + " ".join(words) + " indeed"), (2, "completely different content about other matters that share nothing")], "doc_id bigint, text string")
    i = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    got = L._searched(d, i, L.paraphrases, "doc_id bigint, item_id bigint, cosine double, common_words int").collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 7)} and L.leaks(d, i).count() == 0


def test_paraphrases_between_windows_at_ends_and_of_short_items(spark):
    long = [f"term{k}" for k in range(30)]
    short = "palette glacier ships without runner cluster today".split()

    def reworded(words, *at):
        return " ".join("changed" if k in at else w for k, w in enumerate(words))

    docs = [(1, "begin " + reworded(long[4:17], 3, 8) + " end"), (2, "so " + reworded(long[17:30], 2, 5) + " end"), (3, "and " + reworded(short, 3) + " end"), (4, "nothing in common here at all")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame([(7, " ".join(long)), (8, " ".join(short)), (9, "changed")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in L._searched(d, i, L.paraphrases, "doc_id bigint, item_id bigint, cosine double, common_words int").collect()}
    assert got == {(1, 7), (2, 7), (3, 8)}


def test_the_index_finds_nine_tenths_of_brute_force():
    """Of pairs of a cosine of 0.8 or more, many of them just above, and all equal vectors."""
    rng = np.random.default_rng(6)
    right = L._unit(rng.standard_normal((3000, 48)))
    left = L._unit(np.repeat(right[:500], 4, axis=0) + np.repeat([0.0, 0.03, 0.069, 0.105], 500)[np.arange(2000) % 4 * 500, None] * rng.standard_normal((2000, 48)))
    i, j = np.nonzero(left @ right.T >= 0.8)
    want = set(zip(i.tolist(), j.tolist()))
    a, b, _ = L._pairs_above(left, right, 0.8)
    assert set(zip(a.tolist(), b.tolist())) == want
    for keys, least in (((40, 12), 0.9), (L.EXACT_KEYS, 0.0)):
        a, b, c = L.PlaneIndex(right, *keys).above(left, 0.8)
        got = set(zip(a.tolist(), b.tolist()))
        assert got <= want and len(got) >= least * len(want) and (c >= 0.8).all()
        assert {(4 * k, k) for k in range(500)} <= got
    assert len(want) > 1500 and not len(L.PlaneIndex(right[:0], 4, 16).above(left, 0.8)[0]) and not len(L.PlaneIndex(right, 4, 16).above(left[:0], 0.8)[0])


def test_planted_paraphrases_are_recalled(spark):
    """Passages with every fifth word or so replaced or swapped; at least nine tenths are found, nothing else."""
    random.seed(9)
    vocabulary = [f"term{k}" for k in range(400)]
    items = [(k, " ".join(random.choice(vocabulary) for _ in range(40))) for k in range(60)]
    docs = []
    for k in range(120):
        words = items[k % 60][1].split()[k % 7 : k % 7 + 26]
        for at in random.sample(range(len(words)), 4):
            words[at] = random.choice(["so", "thing", "other"])
        at = random.randrange(len(words) - 1)
        words[at], words[at + 1] = words[at + 1], words[at]
        filler = [random.choice(vocabulary + ["so", "thing", "other"] * 40) for _ in range(60)]
        docs.append((k, " ".join(filler[:30] + words + filler[30:])))
    docs += [(1000 + k, " ".join(random.choice(vocabulary) for _ in range(80))) for k in range(100)]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in L._searched(d, i, L.paraphrases, "doc_id bigint, item_id bigint, cosine double, common_words int").collect()}
    want = {(k, k % 60) for k in range(120)}
    assert len(got & want) >= 0.9 * len(want) and len(got - want) <= 3


def test_common_subsequences_equal_the_plain_table():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 4, (200, 13)), rng.integers(0, 4, (200, 13))

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for p in a:
            last = 0
            for k, q in enumerate(b, 1):
                last, row[k] = row[k], last + 1 if p == q else max(row[k], row[k - 1])
        return row[-1]

    assert L._common_subsequences(x, y).tolist() == [plain(a, b) for a, b in zip(x.tolist(), y.tolist())]
