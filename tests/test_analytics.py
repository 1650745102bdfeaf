import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import MSG, message
from tracewright.operators import evals as E
from tracewright.operators import series as S
from tracewright.operators import tasks as K
from tracewright.operators import usage as U
from tracewright.operators import vectors as V


def test_usage_fallbacks(spark):
    u = "struct<prompt_tokens:bigint,input_tokens:bigint,completion_tokens:bigint,output_tokens:bigint,total_tokens:bigint,prompt_tokens_details:struct<cached_tokens:bigint>,completion_tokens_details:struct<reasoning_tokens:bigint>,cost:double>"
    df = spark.createDataFrame([(1, ((None, 5, 7, None, None, None, None, None),)), (2, ((1, 9, None, None, 50, (3,), (2,), 0.5),)), (3, None)], f"k int, response struct<usage:{u}>")
    got = [tuple(r.u) for r in df.orderBy("k").select(U.usage(F.col("response")).alias("u")).collect()]
    assert got == [(5, 7, 12, 0, 0, 0.0, True), (1, 0, 50, 3, 2, 0.5, True), (0, 0, 0, 0, 0, 0.0, False)]


def attach_by_search(requests, gap):
    """The rule as stated: look at every session for each request."""
    sessions, out = [], []
    for sig, ts in requests:
        fits = [s for s in sessions if s["sig"][: min(len(sig), len(s["sig"]))] == sig[: len(s["sig"])]]
        depth = max((min(len(sig), len(s["sig"])) for s in fits), default=0)
        fits = [s for s in fits if min(len(sig), len(s["sig"])) == depth]
        best = max(fits, key=lambda s: (s["ts"] is not None, s["ts"] or 0, -s["no"]), default=None)
        if best and len(sig) <= len(best["sig"]) and ts is not None and best["ts"] is not None and abs(ts - best["ts"]) > gap:
            best = None
        if best is None:
            best = {"no": len(sessions), "sig": sig, "ts": None}
            sessions.append(best)
        if len(sig) > len(best["sig"]):
            best["sig"] = sig
        best["ts"] = ts if ts is not None else best["ts"]
        out.append(best["no"])
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 1), min_size=1, max_size=5), st.one_of(st.none(), st.integers(0, 40))), max_size=30))
def test_attacher_equals_search(requests):
    requests = sorted(requests, key=lambda r: (r[1] is None, r[1] or 0))
    a = U.Attacher(5)
    assert [a.add(s, t) for s, t in requests] == attach_by_search(requests, 5)


def test_attach_sessions(spark):
    base = dt.datetime(2026, 1, 1)
    m = lambda *ts: [message("user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(ts)]
    rows = [
        (1, base, m("a")), (2, base + dt.timedelta(minutes=1), m("a", "b", "c")), (3, base + dt.timedelta(minutes=2), m("a", "x")),
        (4, base + dt.timedelta(minutes=40), m("a", "b", "c")), (5, base + dt.timedelta(minutes=3), m("a", "b", "c", "d", "e")), (6, None, m("a", "b")), (7, base, []), (8, base + dt.timedelta(minutes=200), m("a", "b", "c", "d", "e", "f", "g")),
    ]
    df = spark.createDataFrame(rows, f"record_id bigint, ts timestamp, messages array<{MSG}>")
    got = {r.record_id: r.session_key.rsplit("-", 1)[1] for r in U.attach_sessions(df).collect()}
    assert got[1] == got[2] == got[5] == got[8] and got[3] != got[1] and got[4] != got[1] and 7 not in got


def test_timeline_without_span(spark):
    df = spark.createDataFrame([(k, dt.datetime(2026, 1, 1), 1.0) for k in range(96)], "k int, ts timestamp, v double")
    got = U.timeline(df, "ts", {"v": "v"}, order="k").orderBy("bin").collect()
    assert [r.calls for r in got] == [2] * 48


def test_session_page(spark):
    schema = "id string, title string, parent_id string, directory string, model string, cost double, tokens_input bigint, tokens_output bigint, tokens_reasoning bigint, tokens_cache_read bigint, time_created bigint, time_updated bigint"
    df = spark.createDataFrame([("a", "100% done_x", None, "/d", "m", 1.0, 0, 1, 1, 5, 1, 10), ("b", "other", None, "/d", "m", 3.0, 10, 1, 1, 5, 1, 30), ("c", "child", "a", "/d", "m", 2.0, 1, 1, 1, 1, 1, 20)], schema)
    assert [r.id for r in U.session_page(df).collect()] == ["b", "a"]
    assert [r.id for r in U.session_page(df, search="0% DONE_").collect()] == ["a"] and U.session_page(df, limit=0).count() == 1
    assert [(r.id, r.cache_rate) for r in U.session_page(df, sort="cache_rate", subagents=True).collect()] == [("c", 1.0), ("b", 0.5), ("a", 0.0)]
    message_ = spark.createDataFrame([("m1", "a", 1, '{"role":"assistant"}'), ("m2", "a", 2, '{"role":"user"}'), ("m3", "b", 1, "bad")], "id string, session_id string, time_created bigint, data string")
    part = spark.createDataFrame([("p1", "m1", "a", 1, '{"type":"tool","state":{"output":"fatal: x"}}'), ("p2", "m1", "a", 0, '{"type":"text"}')], "id string, message_id string, session_id string, time_created bigint, data string")
    counts = {r.id: (r.steps, r.tool_calls, r.dead_ends) for r in U.with_child_counts(U.session_page(df), message_, part).collect()}
    assert counts == {"a": (1, 1, 1), "b": (0, 0, 0)}
    nested = {r.id: r.messages for r in U.nest_export(df, message_, part).collect()}
    assert [len(m.parts) for m in nested["a"]] == [2, 0] and '"text"' in nested["a"][0].parts[0] and nested["b"] == [] and nested["c"] == []
    assert {r.root_id: r.n_sessions for r in U.root_rollup(df, "cost").collect()} == {"a": 2, "b": 1}


@pytest.mark.parametrize(("text", "want"), [("exit_code=0", True), ("exit_code=2 5 passed", False), ("FAILED x", False), ("0 failed, 3 passed", True), ("2 failed", False), ("5 passed", True), ("", False), (None, False)])
def test_passed_by_text(spark, text, want):
    assert bool(spark.createDataFrame([(text,)], "t string").select(E.passed_by_text(F.col("t"))).first()[0]) is want


def test_failures_and_summary(spark):
    text = "FAILED a.py::test_x - AssertionError: one\nE   AssertionError: one\nE   AssertionError: " + "y" * 300 + "\n"
    df = spark.createDataFrame([("k", text), ("ok", "3 passed")], "k string, t string")
    rows = E.failures(df, "k", "t").orderBy("n").collect()
    assert [(r.n, r.test, len(r.message)) for r in rows] == [(1, "test_x", 3), (2, None, 180)]
    s = {r.k: (r.passed, r.failure_count, r.headline) for r in E.summarise_verification(df, "k", "t").collect()}
    assert s == {"k": (False, 2, "one (+1 more failing check)"), "ok": (True, 0, None)}


def test_headlines_by_hints(spark):
    rows = [("a", "FAILED a.py::t - AssertionError: one", "Write the final answer for this run HERE", "x"), ("b", "exit_code=1 SyntaxError", None, " "), ("c", "2 failed", "", None), ("d", "exit_code=2 Errors During Collection", "ok", "x")]
    df = spark.createDataFrame(rows, "k string, t string, answer string, diff string")
    got = {r.k: r.headline for r in E.summarise_verification(df, "k", "t", "answer", "diff").collect()}
    assert got == {"a": E.NO_ANSWER_HEADLINE, "b": E.NO_CHANGE_HINT, "c": E.DEFAULT_HEADLINE, "d": "Pytest failed while collecting tests."}


def test_calls_pair_their_sides(spark):
    """A reply goes to the request right before it; a lost request, a lost reply, a late stamp and copies."""
    u = "struct<prompt_tokens:bigint,input_tokens:bigint,completion_tokens:bigint,output_tokens:bigint,total_tokens:bigint,prompt_tokens_details:struct<cached_tokens:bigint>,completion_tokens_details:struct<reasoning_tokens:bigint>,cost:double>"
    ask, reply = lambda m: (m,), lambda n: ("stop", (None, None, None, None, n, None, None, 0.5))
    stamp = lambda k: f"20260101-00000{k}"
    rows = [(1, "s", stamp(1), ask("m1"), None), (2, "s", stamp(2), None, reply(10)), (2, "s", stamp(2), None, reply(10)), (3, "s", stamp(3), None, reply(20)), (4, "s", stamp(4), ask("m2"), None), (5, "s", stamp(5), ask("m3"), None), (6, "s", stamp(6), None, reply(30)), (7, "s", None, None, reply(40)), (8, None, stamp(1), ask("m1"), None), (9, None, stamp(2), None, reply(50)), (10, "t", stamp(1), ask("m4"), reply(60)), (11, "t", stamp(2), None, reply(70)), (None, "t", stamp(3), ask(None), None), (None, "t", stamp(3), ask(None), None)]
    df = spark.createDataFrame(rows, f"record_id bigint, session_id string, timestamp string, request struct<model:string>, response struct<finish_reason:string,usage:{u}>").selectExpr("*", "cast(null as string) as project_id", "'' as upstream", "current_timestamp() as ingested_at", "'clash' as ts", "1 as call")
    got = sorted((r.record_id or 0, r.model, r.total, r.has_usage) for r in U.calls(df).collect())
    assert got == [(0, "unknown", 0, False), (0, "unknown", 0, False), (1, "m1", 10, True), (3, "m1", 20, True), (4, "m2", 0, False), (5, "m3", 30, True), (7, "unknown", 40, True), (8, "m1", 0, False), (9, "unknown", 50, True), (10, "m4", 60, True), (11, "m4", 70, True)]
    assert U.calls(df.limit(0)).count() == 0 and U.priced(U.calls(df)).count() == 7


def test_knowledge_grade(spark):
    ref = "`alpha beta` in pkg/core/app.py uses load_cache and CacheReader"
    rows = [("alpha beta load_cache", ["/wt/pkg/core/app.py"]), ("alpha beta load_cache", []), ("alpha beta load_cache", None), ("", ["xapp.py"])]
    df = spark.createDataFrame([(ref, a, v) for a, v in rows], "r string, a string, v array<string>")
    got = [round(x[0], 3) for x in df.select(E.grade_knowledge(F.col("r"), F.col("a"), F.col("v"))).collect()]
    assert got == [0.75, 0.25, 0.5, 0.0]
    assert spark.createDataFrame([("two things", "x")], "r string, a string").select(E.grade_knowledge(F.col("r"), F.col("a"))).first()[0] is None


def test_pack_summary_leaves_out_zeros(spark):
    df = spark.createDataFrame([("a", True, 100, 4, 10, 1), ("b", False, 0, None, 0, 2), ("c", False, None, 2, None, None)], "id string, passed boolean, tokens bigint, steps bigint, tool_calls bigint, tool_errors bigint")
    r = E.pack_summary(df).first()
    assert (r.passed, r.total, r.mean_tokens, r.mean_steps, r.tokens_per_solve, r.tool_error_rate) == (1, 3, 100.0, 3.0, 100.0, 0.3)
    none = E.pack_summary(df.where("false")).first()
    assert none.total == 0 and none.mean_tokens is None and none.rate is None


def test_flips(spark):
    a = spark.createDataFrame([("t1", True), ("t2", False), ("t3", True), ("t4", True)], "t string, passed boolean")
    b = spark.createDataFrame([("t1", False), ("t2", True), ("t3", True), ("t5", True)], "t string, passed boolean")
    assert {r.t: r.outcome for r in E.flips(a, b, "t").collect()} == {"t1": "regression", "t2": "gain", "t3": "tie", "t4": "only_one", "t5": "only_one"}


def test_merge_latest(spark):
    random.seed(1)
    rows = [(f"k{random.randrange(6)}", random.randrange(4), random.random(), o) for o in range(60)]
    want: dict = {}
    for k, a, s, o in rows:
        if k not in want or a >= want[k][0]:
            want[k] = (a, s, o)
    got = {r.k: (r.a, r.s, r.o) for r in E.merge_latest(spark.createDataFrame(rows, "k string, a int, s double, o int"), "k", "a", "o").collect()}
    assert got == want


def test_skip_weight_status(spark):
    df = spark.createDataFrame([("g", "ok", 4.2), ("g", "ok", -1.0), ("g", "skip", 0.9), ("s", "skip", 1.0), ("g", "ok", None)], "g string, status string, score double")
    assert {r.g: (r.total, r.skipped, r.mean_score) for r in E.skip_aware(df, "g").collect()} == {"g": (4, 1, 0.333333), "s": (1, 1, 0.0)}
    w = spark.createDataFrame([(1.0, 3.0), (0.0, 1.0), (1.0, 0.0), (1.0, None)], "s double, w double")
    assert tuple(E.weighted_score(w, "s", "w").first()) == (4, 0.75)
    st_ = spark.createDataFrame([("pass",)] * 4 + [("fail",), ("odd",), ("skip",), ("skip",)], "status string")
    r = E.status_rates(st_).first()
    assert (r.n_pass, r.n_error, r.n_skip, r.rate) == (4, 1, 2, 0.666667)


def test_harness_mechanics(spark):
    df = spark.createDataFrame([("s", "edit", "error"), ("s", "edit", "ok"), ("s", "read", "error"), ("s", None, "ok")], "k string, tool string, status string")
    r = E.harness_mechanics(df, "k").first()
    assert (r.calls_by_name, r.tool_errors, r.edit_errors) == ({"edit": 2, "read": 1}, 2, 1)


def test_asof_and_interval(spark):
    left = spark.createDataFrame([("r", 5, "a"), ("r", 1, "b"), ("q", 9, "c")], "by string, at int, id string")
    right = spark.createDataFrame([("r", 2, "x", 1), ("r", 5, "y", 2), ("r", 5, "z", 3)], "by string, rt int, v string, tie int")
    assert {r.id: r.v for r in K.asof_join(left, right, "by", "at", "rt", "v", "tie").collect()} == {"a": "z", "b": None, "c": None}
    spans = spark.createDataFrame([("r", "s1", 0, 5), ("r", "s2", 6, 4), ("r", "s3", 5, 50)], "by string, sid string, s int, e int")
    assert sorted((r.id, r.sid) for r in K.interval_join(left, spans, "at", "s", "e", "by", 3).collect()) == [("a", "s1"), ("a", "s3"), ("b", "s1")]


@pytest.mark.parametrize("bucket", [None, 7, 1000])
def test_asof_in_buckets(spark, bucket):
    random.seed(9)
    left = [(random.choice("ab"), random.randrange(100), k) for k in range(80)]
    right = [(random.choice("ab"), random.randrange(100), random.choice([k, None]), k) for k in range(25)]
    want = {i: max(((rt, t, v) for b, rt, v, t in right if b == k and rt <= at and v is not None), default=(0, 0, None))[2] for k, at, i in left}
    got = K.asof_join(spark.createDataFrame(left, "by string, at int, id int"), spark.createDataFrame(right, "by string, rt int, v int, tie int"), "by", "at", "rt", "v", "tie", bucket)
    assert {r.id: r.v for r in got.collect()} == want


def test_rank_over_parts(spark):
    from tracewright.session import with_rank

    rows = [(v,) for v in random.Random(3).sample(range(5000), 700)]
    got = sorted((r["rank"], r.v) for r in with_rank(spark.createDataFrame(rows, "v int"), ["v"]).collect())
    assert got == list(enumerate(sorted(r[0] for r in rows)))


def test_turn_trimming(spark):
    long = "x" * 250
    rows = [(1, 1, "how does it work?", long), (1, 2, "fix it", long), (1, 3, "why?", long), (2, 1, "fix it", long), (3, 1, "what is it?", "short"), (4, 1, "what?", "s"), (4, 2, "and why?", long)]
    df = spark.createDataFrame(rows, "k int, turn_no int, prompt string, answer string")
    assert sorted((r.k, r.turn_no) for r in K.cut_at_mutation(df, "k").collect()) == [(1, 1), (4, 1), (4, 2)]


def test_commits(spark):
    commits = spark.createDataFrame([(s, "p", None, t, "") for s, t in [("a", "Rework the cache so that it holds"), ("b", "Merge branch of the other people"), ("c", "short subject 19 chr"[:19]), ("d", "Rework many of the files at once"), ("e", "Rework only a tiny little thing")]], "sha string, parent string, ts timestamp, subject string, body string")
    stat = spark.createDataFrame([("a", "10", "src/{x => y}/a.py"), ("a", "-", "logo.png"), ("b", "10", "b.py"), ("c", "10", "c.py"), ("e", "4", "e.py")] + [("d", "5", f"d{k}.py") for k in range(11)], "sha string, added string, path string")
    r = K.code_commits(commits, stat).collect()
    assert [(x.sha, x.changed_files, x.insertions) for x in r] == [("a", ["logo.png", "src/y/a.py"], 10)]


def test_resolve_model(spark):
    offered = spark.createDataFrame([("x/foo-1", 1), ("foo-1-long", 0), ("foo-1", 5)], "model string, rank int")
    wanted = spark.createDataFrame([("foo-1",), ("FOO-1-L",), ("zzz",)], "wanted string")
    assert {r.wanted: r.model for r in K.resolve_model(wanted, offered).collect()} == {"foo-1": "foo-1", "FOO-1-L": "foo-1-long", "zzz": None}


def test_subsets(spark):
    df = spark.createDataFrame([("p-01", "repair", "easy"), ("p-02", "comprehension", "hard"), ("p-03", "repair", "easy"), ("p-09", "repair", "easy"), ("p-15", "implement", "hard")], "id string, kind string, difficulty string")
    ids = lambda w: sorted(r.id for r in K.subset(df, w).collect())
    assert ids("smoke") == ["p-01", "p-02", "p-03"] and ids("new") == ["p-15"] and ids("hard") == ["p-02", "p-15"] and len(ids("all")) == 5


def series_df(spark, values, key="k"):
    return spark.createDataFrame([(key, i, float(v)) for i, v in enumerate(values)], "key string, idx int, value double")


def values(df):
    return [round(r.value, 9) for r in df.orderBy("idx").collect()]


def test_series(spark):
    df = series_df(spark, [1, 2, 3, 4, 5])
    assert values(S.rolling(df, "key", "idx", "value", 3)) == [1, 1.5, 2, 3, 4] and values(S.rolling(series_df(spark, [10, 20]), "key", "idx", "value", 5)) == [10, 15]
    assert values(S.cumsum(df, "key", "idx", "value")) == [1, 3, 6, 10, 15] and values(S.diff(df, "key", "idx", "value")) == [1, 1, 1, 1]
    assert values(S.minmax(series_df(spark, [7, 7]), "key", "idx", "value")) == [0, 0] and S.outliers(series_df(spark, [7]), "key", "value").count() == 0
    with pytest.raises(ValueError, match="width"):
        S.rolling(df, "key", "idx", "value", 0)
    with pytest.raises(ValueError, match="alpha"):
        S.ewma(df, "key", "idx", "value", 0)
    with pytest.raises(ValueError, match="unknown stage"):
        S.pipeline(df, '[{"stage": "nope"}]', "key", "idx", "value")
    with pytest.raises(ValueError, match="takes"):
        S.pipeline(df, [{"stage": "smooth"}], "key", "idx", "value")


@pytest.mark.parametrize("alpha", [0.05, 0.5, 0.99, 1.0])
def test_ewma_over_blocks(spark, alpha):
    random.seed(2)
    x = [random.uniform(-5, 5) for _ in range(900)]
    want = [x[0]]
    for v in x[1:]:
        want.append(alpha * v + (1 - alpha) * want[-1])
    assert max(abs(a - b) for a, b in zip(values(S.ewma(series_df(spark, x), "key", "idx", "value", alpha)), want)) < 1e-6


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 100), st.floats(0, 5)), max_size=30), st.floats(0.5, 5), st.floats(0, 2))
def test_token_bucket_never_overspends(requests, capacity, rate):
    from tracewright.streaming.streams import spend

    requests = sorted(requests)
    granted, level, _ = spend(requests, capacity, rate)
    spent = sum(c for (_, c), g in zip(requests, granted) if g)
    span = requests[-1][0] - requests[0][0] if requests else 0
    assert spent <= capacity + rate * span + 1e-6 and -1e-9 <= level <= capacity + 1e-9


def test_cosine(spark):
    df = spark.createDataFrame([(50, [1.0, 0.0], 1), (51, [1.0, 1.0], 1), (52, [0.0, 0.0], 1), (100, [1.0, 0.0], 1), (7, [1.0, 0.0], 2)], "id int, v array<double>, b int")
    got = {(r.a, r.b): r.cosine for r in V.cosine_to_queries(df, "id", "v", "b", 50).collect()}
    assert got == {(50, 51): 0.70711, (50, 52): None, (50, 100): 1.0, (51, 100): 0.70711, (52, 100): None}


def test_cosine_neighbours_meet_all_labels(spark, tmp_path):
    import random

    import __spark_entry__ as entry

    random.seed(3)
    rows = [(k, [random.uniform(-1, 1) for _ in range(6)], None if k == 7 else k % 4) for k in range(120)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {(r.a, r.b): r.cosine for r in entry.queries()["cosine_neighbours"](spark, str(tmp_path)).collect()}
    size = lambda v: sum(x * x for x in v) ** 0.5
    want = {(a, b): sum(p * q for p, q in zip(x, y)) / size(x) / size(y) for a, x, _ in rows for b, y, _ in rows if a < b and (a % 50 == 0 or b % 50 == 0)}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 2e-5 for k in want)


def test_one_hot_key_spreads_and_keeps_its_order(spark):
    """Previous values and running sums of a key cut into several parts; null keys and values, an empty table."""
    import random

    from tracewright.session import with_previous, with_running_sum

    random.seed(1)
    rows = [(None if k % 97 == 0 else "hot" if k % 5 else f"k{k % 7}", k, None if k % 11 == 0 else random.randint(-5, 9)) for k in range(1500)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i int, v int").withColumn("part", F.lit("clash"))
    want_sum, want_last, total, last = {}, {}, {}, {}
    for g, i, v in sorted(rows, key=lambda r: r[1]):
        want_last[i] = last.get(g)
        if v is not None:
            total[g], last[g] = total.get(g, 0) + v, v
        want_sum[i] = total.get(g)
    assert {r.i: r.s for r in with_running_sum(df, "g", ["i"], F.col("v"), "s").collect()} == want_sum
    assert {r.i: r.p for r in with_previous(df, "g", ["i"], {"p": F.col("v")}).collect()} == want_last
    assert with_running_sum(df.limit(0), "g", ["i"], F.col("v"), "s").count() == 0 and with_previous(df.limit(0), "g", ["i"], {"p": F.col("v")}).count() == 0
