import base64
import random

import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from tracewright.llm import tokens as T  # noqa: E402


@pytest.fixture(scope="module")
def reference():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda t: len(enc.encode_ordinary(t))


def test_counts_equal_the_library(reference):
    random.seed(3)
    texts = ["Hello world's  tabs\t\n\nend ", "aaaaaaaaaaaaa", "naïve café 你好，世界 🎉", "x" * 5000, "".join(random.choice("abcdefghij") for _ in range(4000)), "", " ", "def f(x):\n    return x_1 + 22\n"]
    texts += ["".join(random.choice("ab c.é\n1世") for _ in range(random.randint(0, 60))) for _ in range(300)]
    assert T.TokenCounter(T.MergeTable())(texts) == [reference(t) for t in texts]


def test_long_pieces_agree_with_short_ones():
    m = T.MergeTable()
    random.seed(5)
    for _ in range(40):
        piece = "".join(random.choice("abcdeilnorst") for _ in range(120)).encode()
        assert m.count([piece])[0] == m._count_long(piece)


def test_null_empty_and_repeated_rows(spark, reference):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "hello there"), (3, "hello there")], "id bigint, text string")
    got = sorted((r.id, r.n_tokens, r.text_lang) for r in T.with_token_counts(df, "text", ["id"], with_language=True).collect())
    assert got == [(1, 0, None), (2, 0, None), (3, reference("hello there"), got[2][2]), (3, reference("hello there"), got[3][2])]


def test_budget_sums_and_clean_labels(spark):
    rows = [(1, "the cat and the dog are in the house", "EN", " Frontier", "note"), (2, "der Hund und die Katze sind im Haus", None, "frontier", "note"), (3, None, "fr-CA", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, doc_kind string").withColumn("n_tokens", F.lit("clash")).withColumn("label", F.lit(1))
    per = {r.id: r for r in T.document_tokens(docs).collect()}
    assert [per[k].lang for k in (1, 2, 3)] == ["en", "de", "fr"] and per[3].source == "unknown" and per[3].n_tokens == 0
    budget = {(r.source, r.model, r.lang, r.domain): r for r in T.token_budget(T.document_tokens(docs)).collect()}
    assert budget[("all", "all", "all", "all")].n_records == 3
    assert budget[("frontier", "all", "all", "all")].n_tokens == per[1].n_tokens + per[2].n_tokens
    assert T.token_budget(T.document_tokens(docs.limit(0))).count() == 0


def test_session_strings(spark, sessions):
    from tests.conftest import message

    s = sessions([(1, [message("user", "hello"), message("assistant", None, [("a", "read", "{}")])]), (2, None), (3, [])]).withColumn("source", F.lit("x")).withColumn("model", F.lit("openrouter/local/M-1")).withColumn("task_type", F.lit(None).cast("string"))
    got = {r.id: (r.n_tokens, r.model, r.domain) for r in T.session_tokens(s).collect()}
    assert got[1][0] > 2 and got[2][0] == 0 and got[3][0] == 0 and got[1][1:] == ("m-1", "unknown")
