import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tracewright.llm import mixture as M


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.floats(0, 1), st.integers(0, 4)), min_size=1, max_size=7), st.floats(0, 5000))
def test_water_fill(rows, total):
    tokens, shares, caps = ([r[k] for r in rows] for k in range(3))
    take = M.water_fill(tokens, shares, caps, total)
    limits = [t * c for t, c in zip(tokens, caps)]
    assert all(-1e-6 <= x <= m + 1e-6 for x, m in zip(take, limits))
    usable = sum(m for m, s in zip(limits, shares) if s > 0)
    assert abs(sum(take) - min(total, usable)) < 1e-3 * max(1, total) + 1e-6
    free = [(x, s) for x, s, m in zip(take, shares, limits) if s > 1e-6 and m > 0 and x < m - 1e-6]
    if len(free) > 1 and total > 1e-3:
        ratio = [x / s for x, s in free]
        assert max(ratio) - min(ratio) < 1e-6 * max(ratio) + 1e-9


@pytest.fixture(scope="module")
def sized(spark):
    rows = [(k, "a", 10 + k % 7) for k in range(2000)] + [(5000 + k, "b", 9) for k in range(200)] + [(9000, "c", 0), (9001, "unwanted", 50)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")


def test_draw_meets_goals(spark, sized):
    targets = spark.createDataFrame([("A ", 0.5, 1), ("b", 0.5, 3), ("gone", 0.1, 2), ("c", None, None)], "source string, target_share double, max_repeats int")
    mixture = M.plan(sized, targets)
    drawn = M.draw(sized, mixture).collect()
    got = {s: sum(r.n_tokens * r.copies for r in drawn if r.source == s) for s in ("a", "b", "unwanted")}
    take = dict(zip(mixture["source"], mixture["take"]))
    assert abs(got["a"] - take["a"]) <= 16 and abs(got["b"] - take["b"]) <= 9 and got["unwanted"] == 0
    assert max(r.copies for r in drawn if r.source == "b") <= 3 and max(r.copies for r in drawn if r.source == "a") == 1
    assert sorted(map(tuple, drawn)) == sorted(map(tuple, M.draw(sized, mixture).collect()))


def test_empty(spark, sized):
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    assert M.draw(sized.limit(0), M.plan(sized.limit(0), targets)).count() == 0
    docs = spark.createDataFrame([(1, None, None), (2, "", "x"), (3, "hi there", " X")], "doc_id bigint, text string, source string").selectExpr("*", "5 as n_tokens", "'q' as lot")
    assert sorted((r.doc_id, r.source, r.n_tokens > 0) for r in M.sized_documents(docs).collect()) == [(1, "unknown", False), (2, "x", False), (3, "x", True)]
