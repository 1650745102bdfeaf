import json

import pytest
from pyspark.sql import functions as F

from tracewright.functions import arrays as A
from tracewright.functions import jsonx as J
from tracewright.functions import registry
from tracewright.functions import text as X


def one(spark, column, **values):
    names = list(values)
    schema = ", ".join(f"{n} {'array<string>' if isinstance(v, list) and (not v or isinstance(v[0], str)) else 'array<int>' if isinstance(v, list) else 'double' if isinstance(v, float) else 'bigint' if isinstance(v, int) else 'string'}" for n, v in values.items())
    return spark.createDataFrame([tuple(values[n] for n in names)], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize(("text", "want"), [("that's wrong", True), ("no, thanks", False), ("It doesn't work at all", True), ("still broken", True), ("fine", False), (None, False)])
def test_correction(spark, text, want):
    assert one(spark, X.is_correction(F.col("t")), t=text) is want


@pytest.mark.parametrize(("text", "mutation", "question"), [("Please fix the loop", True, False), ("how do I run it?", False, True), ("can you explain the cache", False, True), ("ok, run it", True, False), ("The cache is slow", False, False)])
def test_intent(spark, text, mutation, question):
    assert one(spark, X.is_mutation(F.col("t")), t=text) is mutation and one(spark, X.is_question(F.col("t")), t=text) is question


def test_ngrams_and_shingles(spark):
    assert one(spark, X.ngrams(F.col("t"), 3), t=" A  b\nC d ") == ["a b c", "b c d"]
    assert one(spark, X.ngrams(F.col("t"), 3), t="a b") == [] and one(spark, X.ngrams(F.col("t"), 3), t="") == []
    assert one(spark, X.shingles(F.col("t")), t="a b") == ["a b"] and one(spark, X.shingles(F.col("t")), t="") == []
    assert one(spark, X.jaccard(F.col("a"), F.col("b")), a=["x"], b=["x", "y"]) == 0.5
    assert one(spark, X.jaccard(F.col("a"), F.col("b")), a=[], b=[]) == 1.0 and one(spark, X.jaccard(F.col("a"), F.col("b")), a=[], b=["x"]) == 0.0


def test_entities_and_files(spark):
    got = one(spark, X.entities(F.col("t")), t="See `the Cache`, ./pkg/core/app.py and load_cache in CacheReader; `file` and data")
    assert set(got) == {"./pkg/core/app.py", "the cache", "load_cache", "cachereader"}
    assert one(spark, X.reference_files(F.col("t")), t="@./pkg/App.py and pkg/app.py") == ["pkg/app.py"]


def test_djb2(spark):
    h = 5381
    for c in "hello world":
        h = (h * 33 + ord(c)) & 0xFFFFFFFF
    digits = ""
    while h:
        digits = "0123456789abcdefghijklmnopqrstuvwxyz"[h % 36] + digits
        h //= 36
    assert one(spark, X.djb2(F.col("t")), t="hello world") == digits


def test_djb2_counts_utf16_units(spark):
    text = "a😀é"
    h = 5381
    raw = text.encode("utf-16-be")
    for k in range(0, len(raw), 2):
        h = (h * 33 + int.from_bytes(raw[k : k + 2], "big")) & 0xFFFFFFFF
    assert int(one(spark, X.djb2(F.col("t")), t=text), 36) == h and int(one(spark, X.djb2(F.col("t")), t=""), 36) == 5381


@pytest.mark.parametrize(("args", "want"), [('{"command":"ls","description":"list"}', "list"), ('{"cmd":"x","path":"a/b"}', "a/b"), ('{"todos":[{"a":1}]}', "1 todo item"), ('{"todos":[1,2]}', "2 todo items"), ('{"questions":["q"]}', '["q"]'), ('{"name":"n"}', '{"name":"n"}'), ("not json", "not json")])
def test_argument_summaries(spark, args, want):
    assert one(spark, X.summarise_args(F.col("t")), t=args) == want


def test_instants(spark):
    for text in ("20260530-093414", "20260530093414", "20260530T093414Z", "2026-05-30T09:34:14Z", "2026-05-30T11:34:14+02:00", "1780133654000"):
        assert one(spark, F.unix_seconds(X.instant(F.col("t"))), t=text) == 1780133654
    assert one(spark, X.instant(F.col("t")), t="soon") is None


def test_dead_ends_differ(spark):
    assert one(spark, X.dead_end_sql(F.col("t")), t="bash: x: Command not found") and not one(spark, X.dead_end_sql(F.col("t")), t="ENOENT here")
    assert one(spark, X.dead_end_trace(F.col("t")), t="ENOENT here") and one(spark, X.dead_end_trace(F.col("t")), t="error: x")
    assert not one(spark, X.dead_end_trace(F.col("t")), t="a" * 6000 + " error: x") and one(spark, X.dead_end_sql(F.col("t")), t=None) is False


@pytest.mark.parametrize(("fn", "text", "want"), [(X.slugify, "A  b/C!", "a-b-c"), (X.short_model, "a/b/c", "c"), (X.strip_wrapping_quotes, ' "a b" ', "a b"), (X.short_title, " ", "(untitled)"), (X.rename_target, "a/{x => y}/b", "a/y/b"), (X.rename_target, "x => y", "y"), (X.model_from_prompt, "You are powered by the model named Foo. The exact model ID is bar-1", "bar-1"), (X.normalise_model, "openrouter/local/m", "m"), (X.user_query, "<user_query>\n q \n</user_query>", "q")])
def test_labels(spark, fn, text, want):
    assert one(spark, fn(F.col("t")), t=text) == want


def test_slug_of_nothing_is_an_error(spark):
    with pytest.raises(Exception, match="empty slug"):
        one(spark, X.slugify(F.col("t")), t="!!")


@pytest.mark.parametrize(("n", "want"), [(999, "999"), (1234, "1.2k"), (2_500_000, "2.5M"), (3_100_000_000, "3.1B")])
def test_compact_number(spark, n, want):
    assert one(spark, X.compact_number(F.col("n")), n=n) == want


@pytest.mark.parametrize(("text", "want"), [('{"a":1}', True), ("{} x", False), ("1 2", False), ("", False), (None, False), ("NaN", True), ("{bad", False)])
def test_strict_json(spark, text, want):
    assert one(spark, J.strict_json(F.col("t")), t=text) is want


def test_json_turns(spark):
    assert json.loads(one(spark, J.normalise_keys(F.col("t")), t='{"a-b": [{"c-d": 1}]}')) == {"a_b": [{"c_d": 1}]}
    assert json.loads(one(spark, J.flatten_json(F.col("t")), t="[1, [2, [3, []]]]")) == [1, 2, 3] and one(spark, J.flatten_json(F.col("t")), t="{}") is None
    assert one(spark, F.to_json(J.json_lenient(F.col("t"))), t='x\n```json\n{"a": 1}\n```') == '{"a":1}'


def brute_mask(ids, response, end):
    out, i, n = [0] * len(ids), 0, len(ids)
    while i < n:
        if response and ids[i : i + len(response)] == response:
            i += len(response)
            while i < n:
                if end and ids[i : i + len(end)] == end:
                    for k in range(i, min(n, i + len(end))):
                        out[k] = 1
                    i += len(end)
                    break
                out[i] = 1
                i += 1
        else:
            i += 1
    return out


@pytest.mark.parametrize("ids", [[1, 9, 8, 5, 6, 7, 2, 9, 8, 4], [9, 8, 7], [5, 6], [9, 8, 3, 7, 9, 8, 7, 1], []])
def test_masks(spark, ids):
    got = one(spark, A.response_mask(F.col("i"), F.col("r"), F.col("e")), i=ids, r=[9, 8], e=[7]) if ids else []
    assert got == brute_mask(ids, [9, 8], [7])
    if ids:
        assert one(spark, A.labels(F.col("i"), A.response_mask(F.col("i"), F.col("r"), F.col("e"))), i=ids, r=[9, 8], e=[7]) == [t if m else -100 for t, m in zip(ids, got)]


def test_spans_padding_one_hot(spark):
    assert one(spark, A.mask_spans(F.col("m")), m=[0, 1, 1, 0, 1]) == 2
    df = spark.createDataFrame([(1, [1, 2], [1, 1]), (1, [3], [1]), (2, [4], [1])], "b int, ids array<int>, attn array<int>")
    got = sorted((r.b, r.ids, r.attn) for r in A.pad_batches(df, "b", {"ids": 0, "attn": 0}, left=True).collect())
    assert got == [(1, [0, 3], [0, 1]), (1, [1, 2], [1, 1]), (2, [4], [1])]
    assert one(spark, A.one_hot(F.col("t"), ["a", "b"]), t="b") == [0, 1] and one(spark, A.one_hot(F.col("t"), ["a", "b"]), t=None) == [0, 0]


def test_sql_functions(spark):
    registry.register(spark)
    assert spark.sql("SELECT is_valid_json('{} x') AS v").first().v is False
    rows = spark.sql("""SELECT * FROM trace_steps('[{"role":"user","content":"hi"},{"role":"assistant","tool_calls":[{"function":{"name":"read","arguments":"{}"}}]}]')""").collect()
    assert [(r.kind, r.name) for r in rows] == [("text", None), ("tool", "read")]


@pytest.mark.parametrize(("text", "non_answer", "ephemeral"), [("Could you clarify the path?", True, False), ("I don't see it", True, False), ("/tmp/x", False, True), ("/home/a-replay-b", False, True), ("fine", False, False), (None, False, False)])
def test_non_answers(spark, text, non_answer, ephemeral):
    assert one(spark, X.is_non_answer(F.col("t")), t=text) is non_answer and one(spark, X.is_ephemeral(F.col("t")), t=text) is ephemeral
    assert one(spark, X.enough_entities(F.col("t")), t=text) is False
