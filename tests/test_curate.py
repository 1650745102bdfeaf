import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import message
from tracewright.operators import curate as C

U = lambda n, s="s": [message("system", s), message("user", "q")] + [message("assistant", "a")] * (n - 2)


def test_prefix_dedupe_ties(sessions, spark):
    from tests.conftest import MSG

    def survivor(rows):
        df = spark.createDataFrame([(k, U(n), e) for k, (n, e) in enumerate(rows)], f"o bigint, messages array<{MSG}>, _split string")
        r = C.prefix_dedupe(df, "o").collect()
        assert len(r) == 1
        return r[0].o, r[0]._split

    assert survivor([(3, None), (5, "train"), (5, None)]) == (1, "train")
    assert survivor([(3, "eval"), (5, "train"), (5, None)]) == (1, "eval")
    assert survivor([(5, None), (5, "eval"), (5, "eval")]) == (2, "eval")
    assert survivor([(5, "eval"), (5, None)]) == (0, "eval")


def test_prefix_dedupe_keys(sessions):
    df = sessions([(1, U(3)), (2, U(3, "other")), (3, None)]).withColumn("_split", F.lit(None).cast("string"))
    assert C.prefix_dedupe(df, "sample_id").count() == 3 and C.prefix_dedupe(df.limit(0), "sample_id").count() == 0


def brute_greedy(rows, threshold, k=3):
    def sh(t):
        w = (t or "").lower().split()
        return set() if not w else {" ".join(w)} if len(w) < k else {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)}

    def alike(a, b):
        return (1.0 if not a and not b else 0.0 if not a or not b else len(a & b) / len(a | b)) >= threshold

    kept = []
    for key, t in sorted(rows):
        s = sh(t)
        if not any(alike(s, o) for _, o in kept):
            kept.append((key, s))
    return {x[0] for x in kept}


def test_greedy_near_dedupe(spark):
    random.seed(6)
    v = [f"w{i}" for i in range(40)]
    rows = []
    for c in range(14):
        words = [random.choice(v) for _ in range(30)]
        for j in range(6):
            if j:
                words = list(words)
                words[random.randrange(len(words))] = random.choice(v)  # chains: neighbours alike, ends not
            rows.append((c * 10 + j, " ".join(words)))
    rows += [(900, None), (901, ""), (902, "a b"), (903, "A  b"), (904, rows[0][1])]
    df = spark.createDataFrame(rows, "id bigint, text string").withColumn("s", F.lit("clash"))
    got = {r.id for r in C.greedy_near_dedupe(df, "id", "text").collect()}
    assert got == brute_greedy(rows, 0.8)
    assert C.greedy_near_dedupe(df.limit(0), "id", "text").count() == 0


def test_decontaminate(spark):
    long = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, "x " + long.upper().replace(" ", "\n")), (2, " ".join(long.split()[:12])), (3, None), (4, "")], "id int, t string")
    bench = spark.createDataFrame([(long,), (None,)], "b string")
    assert {r.id for r in C.decontaminate(docs, "id", "t", bench, "b").collect()} == {2, 3, 4}
    assert C.decontaminate(docs, "id", "t", bench.limit(0), "b").count() == 4


def test_markers(spark):
    markers = spark.createDataFrame([("p", 0, "Alpha"), ("p", 1, "beta"), ("q", 0, "gamma(")], "problem string, pos int, marker string")
    rows = spark.createDataFrame([(1, "BETA and alpha"), (2, "x GAMMA( y"), (3, None), (4, "none")], "id int, t string")
    assert sorted(map(tuple, C.marker_hits(rows, "id", "t", markers).collect())) == [(1, "p", "Alpha"), (2, "q", "gamma(")]
    assert {r.id for r in C.drop_marked(rows, "id", "t", markers).collect()} == {3, 4}
    assert tuple(C.contamination_counts(rows, C.marker_hits(rows, "id", "t", markers), "id").first()) == (4, 2)


def test_balance_counts(spark):
    df = spark.createDataFrame([(k, "big") for k in range(500)] + [(1000 + k, "mid") for k in range(40)] + [(2000 + k, "small") for k in range(10)], "id bigint, source string")
    n = {r.source: r["count"] for r in C.balance(df, "source", "id", 2.5).groupBy("source").count().collect()}
    assert n == {"big": 25, "mid": 25, "small": 10}
    assert C.balance(df, "source", "id", 0).count() == 550 and C.balance(df.where("source = 'big'"), "source", "id", 2).count() == 500


def test_group_split(spark):
    df = spark.createDataFrame([(k, f"g{k % 37}" if k % 5 else None) for k in range(400)], "id bigint, g string")
    rows = C.hash_group_split(df, "g", 0.2).collect()
    by: dict = {}
    for r in rows:
        by.setdefault(r.g, set()).add(r._split)
    assert len(rows) == 400 and all(len(v) == 1 for v in by.values())
    assert sum(v == {"eval"} for v in by.values()) == round(0.2 * len(by))
    out = C.hash_group_split(df, "g", 0.2)
    C.assert_no_leak(out.where("_split = 'train'"), out.where("_split = 'eval'"), "g")
    with pytest.raises(ValueError, match="share"):
        C.assert_no_leak(df, df.where("g is not null"), "g")


def test_sanitise(sessions):
    text = "You are powered by the model named Foo Max. The exact model ID is foo-max-1\nPath /tmp/improver-replay-abc_1/x and improver-replay-abc_1; foo-max-1 says hi"
    df = sessions([(1, [message("system", text), message("assistant", "I am foo-max-1", [("i", "read", '{"p":"/tmp/improver-replay-abc_1/y"}')])]), (2, None)]).withColumn("tools", F.lit("foo-max-1"))
    r = {x.sample_id: x for x in C.sanitise(df, "m$1", "/work/clean").collect()}
    system, reply = r[1].messages
    assert "foo" not in system.content.lower() and "/work/clean/x and clean;" in system.content and system.content.endswith("m$1 says hi")
    assert reply.content == "I am m$1" and reply.tool_calls[0].function.arguments == '{"p":"/work/clean/y"}' and r[1].tools == "m$1" and r[2].messages is None


def test_recipes_run(sessions, spark):
    df = sessions([(k, U(3 + k % 3, f"s{k % 4}")) for k in range(12)]).selectExpr("*", "sample_id as _ord", "'src' as source", "'t' as tools", "cast(null as string) as _split", "concat('g', sample_id % 3) as _group")
    recipe = C.Recipe("sample_id", spark.createDataFrame([("zzz " * 13,)], "b string"), "b", spark.createDataFrame([("p", 0, "nowhere")], "problem string, pos int, marker string"))
    assert recipe.library(df).count() == 4 and recipe.command(df).count() == 4
    raw = recipe.raw(df).collect()
    assert len(raw) == 12 and {r._split for r in raw} == {"train", "eval"}


def test_small_selectors(spark):
    df = spark.createDataFrame([(k, s) for k, s in enumerate(["a", "b", "c", "b", None])], "id bigint, source string")
    assert sorted(r.id for r in C.allowed_sources(df, "source", " a, b ,").collect()) == [0, 1, 3] and C.allowed_sources(df, "source", "").count() == 5
    assert [r.id for r in C.by_source_rank(df, "source", ["b", "a"], "id").collect()][:3] == [1, 3, 0]
    places = list(range(5))
    random.Random(0).shuffle(places)
    assert {r.id for r in C.shuffled_split(df, "id", 2).where("_split = 'eval'").collect()} == set(places[:2])
    with pytest.raises(ValueError, match="hash_group_split"):
        C.shuffled_split(df, "id", 2, most=3)
    assert sorted(r._split for r in C.resplit(df.where("id < 2"), df.where("id = 2").drop("source")).collect()) == ["eval", "train", "train"]
