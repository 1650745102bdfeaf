import pytest
from pyspark.sql import functions as F

from tests.conftest import message
from tracewright.operators import messages as M
from tracewright.operators import quality as Q
from tracewright.operators import trace as T

C = lambda n, a="{}", i=None: (i, n, a)


@pytest.fixture(scope="module")
def mixed(sessions):
    u, a, t = (lambda c: message("user", c)), (lambda c=None, calls=None, r=None: message("assistant", c, calls, None, r)), (lambda c, i: message("tool", c, None, i))
    loop = [C("read", '{"filePath":"x"}', "1"), C("read", '{"filePath":"x"}', "2"), C("read", '{"filePath":"x"}', "3")]
    return sessions(
        [
            (1, [u("how?"), a("answer")]),
            (2, [u("go"), a("x"), u("that's wrong"), a("sorry")]),
            (3, [u("no, thanks"), a("ok")]),
            (4, [u("go"), a(None, [C("read", None, "1")])]),
            (5, [u("go"), a(None, [C("read", "{} x", "1")])]),
            (6, [u("go"), a(None, loop[:2]), a(None, loop[2:])]),
            (7, [u("go"), a(None, loop[:2]), a("done")]),
            (8, [u("still broken"), a(None, loop)]),
            (9, None),
            (10, []),
        ]
    )


def test_drop_reasons(mixed):
    got = {r.sample_id: r.drop_reason for r in Q.drop_reasons(mixed, "sample_id").collect()}
    assert got == {1: None, 2: "correction", 3: None, 4: "malformed", 5: "malformed", 6: "loop", 7: None, 8: "correction", 9: None, 10: None}
    assert {r.sample_id for r in Q.drop_reasons(mixed, "sample_id", 5).where("drop_reason = 'long'").collect()} >= {1, 3, 7}
    assert Q.drop_reasons(mixed.limit(0), "sample_id").count() == 0


def test_loops(mixed):
    calls = mixed.select("sample_id", F.posexplode(M.calls(F.col("messages"))).alias("pos", "c")).select("sample_id", "pos", "c.function.*")
    got = {r.sample_id: r.loops for r in Q.loop_counts(calls, "sample_id", ["pos"], "name", ["name", "arguments"]).collect()}
    assert got == {4: 0, 5: 0, 6: 1, 7: 0, 8: 1}


def test_turn_pairs(sessions):
    s = sessions([(1, [message("system", "s"), message("user", "a"), message("assistant", "1"), message("assistant", " "), message("user", "b"), message("user", "c"), message("assistant", "3")]), (2, None)])
    assert sorted((r.turn_no, r.prompt, r.answer) for r in M.turn_pairs(s, "sample_id").collect()) == [(1, "a", "1"), (3, "c", "3")]
    assert M.turn_pairs(s, "sample_id", 2).count() == 0


@pytest.mark.parametrize(
    ("content", "sft", "trace", "harvest"),
    [("plain", "plain", "plain", "plain"), (None, "", "", ""), ('[{"type":"text","text":"a"},{"type":"text","text":"b"}]', "a\nb", "a\nb", "ab"), ('["x",{"type":"thinking","thinking":"t"}]', "x", "x\nt", "x"), ("[not json", "[not json", "[not json", "[not json")],
)
def test_content_text(spark, content, sft, trace, harvest):
    df = spark.createDataFrame([(content,)], "c string")
    got = df.select(*[M.content_text(F.col("c"), m).alias(m) for m in ("sft", "trace", "harvest")]).first()
    assert tuple(got) == (sft, trace, harvest)


def test_steps_and_metrics(sessions):
    s = sessions(
        [
            (1, [message("assistant", "early", None, None, "think"), message("user", "go"), message("assistant", "t", [C("edit", '{"filePath":"a.py"}', "1"), C("bash", '{"command":"ls"}', "2")]), message("tool", "ok", None, "1"), message("tool", "Permission denied", None, "2"), message("tool", "fatal: no", None, "2")]),
            (2, [message("assistant", None, [C("task", "{}"), C("bash", '{"command":"rm x"}')]), message("tool", "r1"), message("tool", "r2")]),
            (3, None),
        ]
    )
    rows = {(r.sample_id, r.turn_no, r.step_no): r for r in T.steps(s, "sample_id").collect()}
    assert [rows[1, 0, k].type for k in (0, 1)] == ["thinking", "text"]
    assert (rows[1, 1, 1].cat, rows[1, 1, 1].parallel, rows[1, 1, 1].summary, rows[1, 1, 1].dead) == ("mutating", True, "a.py", False)
    assert rows[1, 1, 2].result == "fatal: no" and rows[1, 1, 2].dead and rows[1, 1, 2].cat == "readonly"
    assert (rows[2, 0, 0].cat, rows[2, 0, 0].result, rows[2, 0, 1].cat, rows[2, 0, 1].result) == ("subagent", "r1", "mutating", "r2")
    m = {r.sample_id: (r.turns, r.tool_calls, r.dead_ends, r.writes, r.subagents, r.thinking) for r in T.metrics(s, "sample_id").collect()}
    assert m == {1: (1, 2, 1, 1, 0, 1), 2: (1, 2, 0, 1, 1, 0), 3: (0, 0, 0, 0, 0, 0)}


@pytest.mark.parametrize(("name", "args", "want"), [("Dispatch_Agent", "{}", "subagent"), ("my_agent", "{}", "subagent"), ("todowrite", None, "planning"), ("write_file", None, "mutating"), ("shell", '{"cmd":"git commit -m x"}', "mutating"), ("shell", '{"cmd":"git status"}', "readonly"), ("grep_all", None, "readonly"), ("zzz", None, "other"), (None, None, "other")])
def test_tool_class(spark, name, args, want):
    assert spark.createDataFrame([(name, args)], "n string, a string").select(T.tool_class(F.col("n"), F.col("a"))).first()[0] == want


def test_integrity(sessions):
    a = lambda *calls: message("assistant", "x", list(calls) or None)
    t = lambda i: message("tool", "r", None, i)
    u = message("user", "q")
    cases = [([u, a(C("r", i="1"), C("r", i="2")), t("2"), t("1"), a()], None), ([u, a(C("r", i="1")), a()], "unanswered call"), ([u, a(C("r", i="1")), t("1"), t("1"), a()], "orphan result"), ([u, a(C("r", i="1")), t("1"), a(C("r", i="1")), t("1")], "id used twice"), ([u, t("9")], "orphan result"), ([u, a(C("r", i="1"))], "unanswered call")]
    s = sessions([(k, m) for k, (m, _) in enumerate(cases)])
    got = {r.sample_id: r.f for r in s.select("sample_id", Q.integrity_reason(F.col("messages")).alias("f")).collect()}
    assert got == {k: f for k, (_, f) in enumerate(cases)}


def test_judge(spark):
    rows = [(1, (4.0, 4.0, 4.0, None)), (2, (1.5, 5.0, 5.0, None)), (3, (4.0, 4.0, 4.0, 2.0)), (4, (4.0, 4.0, 4.0, 3.0)), (5, (3.0, 3.0, 4.0, None)), (6, (None, 4.0, 4.0, None)), (7, None)]
    df = spark.createDataFrame(rows, "k int, s struct<coherence:double,tool_use:double,faithfulness:double,recovery:double>")
    assert {r.k for r in df.where(Q.judge_keep(F.col("s"))).collect()} == {1, 4}


def test_generations(spark):
    keyed = "<think>why</think>Hi <tool_call>read\n<arg_key>p</arg_key><arg_value>1</arg_value><arg_key>p</arg_key><arg_value>2</arg_value></tool_call><|im_end|>"
    other = "x<tool_call>nothing</tool_call><tool_call><function=grep><parameter=q>a b</parameter></function></tool_call>"
    df = spark.createDataFrame([(keyed, other)], "k string, f string")
    k, f = df.select(M.parse_generation(F.col("k")), M.parse_generation(F.col("f"), "functional")).first()
    assert (k.content, k.reasoning_content, k.tool_calls[0].name, k.tool_calls[0].arguments) == ("Hi", "why", "read", {"p": "2"})
    assert f.content == "x" and [(c.id, c.name, c.arguments) for c in f.tool_calls] == [("call_1", "grep", {"q": "a b"})]


def test_tagged_turns(spark):
    rows = [("p", 0, "user", "untagged first"), ("p", 1, "assistant", "a0"), ("p", 2, "user", "ignored"), ("p", 3, "assistant", "a1"), ("p", 4, "user", "<user_query> q2 </user_query>"), ("p", 5, "assistant", " "), ("p", 6, "assistant", "a2"), ("p", 7, "user", "<user_query>q3</user_query>")]
    got = sorted((r.turn_no, r.prompt, r.answer) for r in M.tagged_turns(spark.createDataFrame(rows, "path string, line_no int, role string, text string")).collect())
    assert got == [(1, "untagged first", "a1"), (2, "q2", "a2")]


def test_abort_after_streak(spark):
    rows = [("k", i, b) for i, b in enumerate([True, True, False, True, True, True, False, True])]
    df = spark.createDataFrame(rows, "k string, i int, bad boolean")
    assert T.abort_after_streak(df, "k", ["i"], F.col("bad")).count() == 6


def test_export_messages(spark):
    rows = [("s", 0, "user", " ", None, None), ("s", 1, "user", "go", None, None), ("s", 2, "assistant", None, "r", [("c", "read", "{}", None, "ok")]), ("s", 3, "assistant", None, None, None)]
    df = spark.createDataFrame(rows, "k string, ord int, role string, text string, reasoning string, parts array<struct<call_id:string,tool:string,input:string,output:string,status:string>>")
    got = M.export_messages(df, "k").first().messages
    assert [(m.role, m.content, m.tool_call_id) for m in got] == [("user", "go", None), ("assistant", "", None), ("tool", "", "c")]


def test_tool_classes_count_every_call(spark, sessions, tmp_path):
    import __spark_entry__ as entry

    calls = [("bash", '{"command": "ls -l"}'), ("bash", '{"command": "rm -r x"}'), ("Shell", '{"cmd": "git commit"}'), (None, "{}"), ("read", "{}"), ("bash", None)]
    sessions([(1, [message("assistant", "", [(str(k), n, a) for k, (n, a) in enumerate(calls)])]), (2, [message("assistant", "", [("9", "read", "{}")])])]).write.parquet(str(tmp_path / "sft_dataset.parquet"))
    got = {(r.name, r["cat"]): r.calls for r in entry.queries()["tool_classes"](spark, str(tmp_path)).collect()}
    assert got == {("bash", "readonly"): 2, ("bash", "mutating"): 1, ("Shell", "mutating"): 1, (None, "other"): 1, ("read", "readonly"): 2}


def test_drop_reason_cascade_has_the_length_gate(spark, sessions, tmp_path):
    import __spark_entry__ as entry

    sessions([(1, [message("user", "go"), message("assistant", "word " * 80_000)]), (2, [message("user", "go")])]).write.parquet(str(tmp_path / "sft_dataset.parquet"))
    got = {r.drop_reason: r.n for r in entry.queries()["drop_reason_cascade"](spark, str(tmp_path)).collect()}
    assert got == {"long": 1, "kept": 1}
