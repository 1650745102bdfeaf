import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.llm import hyperminhash as H
from tracewright.llm.components import components
from tracewright.llm.neardup import expand, near_duplicates


def sets(text, n):
    w = text.lower().split() if text else []
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(rows, n, threshold):
    s = {k: sets(t, n) for k, t in rows if sets(t, n)}
    return {(a, b) for a in s for b in s if a < b and len(s[a] & s[b]) / len(s[a] | s[b]) >= threshold}


@pytest.fixture(scope="module")
def corpus():
    random.seed(11)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, k = [], 0
    for _ in range(30):
        base = [random.choice(vocabulary) for _ in range(random.choice([6, 20, 80, 300]))]
        for _ in range(4):
            words = list(base)
            for _ in range(random.randint(0, max(1, len(words) // 12))):
                at = random.randrange(len(words))
                words[at : at + 1] = random.choice([[], [random.choice(vocabulary)], [words[at], "new"]])
            rows.append((k, " ".join(words)))
            k += 1
    rows += [(k + j, rows[0][1].upper()) for j in range(40)]  # a hot group of copies
    return rows + [(9000, None), (9001, ""), (9002, "two words"), (9003, "w " * 30_000)]


@pytest.mark.parametrize(("n", "threshold"), [(3, 0.7), (5, 0.8)])
def test_pairs_equal_brute_force(spark, corpus, n, threshold):
    df = spark.createDataFrame(corpus, "rec_id bigint, text string").withColumn("rep", F.lit(1)).withColumn("band", F.lit(2))
    members, links = near_duplicates(df, words=n, threshold=threshold)
    got = {(r.rec_a, r.rec_b) for r in expand(members, links).distinct().collect()}
    assert got == brute(corpus, n, threshold)


def test_empty_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "rec_id bigint, text string")
    members, links = near_duplicates(df)
    assert sorted((r.rec_id, r.rep) for r in members.collect()) == [(1, 1), (2, 1)] and links.count() == 0
    members, links = near_duplicates(df.limit(0))
    assert members.count() == 0 and links.count() == 0


def test_estimates_and_collisions():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (4000, 800, 800))
    x, y = np.unique(np.concatenate([shared, a])), np.unique(np.concatenate([shared, b]))
    k = 1024
    e = H.jaccard_estimate(H.registers(x, k)[None], H.registers(y, k)[None], np.array([len(x)]), np.array([len(y)]))[0]
    assert abs(e - 4000 / 5600) < 0.06
    far = [rng.integers(0, 2**63, 3000).astype(np.uint64) for _ in range(40)]
    regs = [H.registers(f, k) for f in far]
    seen = np.mean([(regs[i] == regs[i + 1]).mean() for i in range(39)])
    want = H.collision_rate(np.array([3000.0]), np.array([3000.0]), k)[0]
    assert 0.5 * want < seen + 2e-4 and seen < 3 * want + 2e-4


def test_components_equal_union_find(spark):
    random.seed(2)
    edges = [(f"v{random.randrange(300)}", f"v{random.randrange(300)}") for _ in range(260)] + [("hub", f"leaf{k}") for k in range(150)] + [("x", "x"), (None, "y"), ("v1", "v2"), ("v2", "v1")]
    parent: dict = {}

    def find(v):
        parent.setdefault(v, v)
        while parent[v] != v:
            v = parent[v]
        return v

    for u, v in edges:
        if u is not None and v is not None:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    want = {}
    for v in parent:
        want.setdefault(find(v), []).append(v)
    want = {v: min(vs) for vs in want.values() for v in vs}
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "u string, v string")).count() == 0
