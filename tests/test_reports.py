import hashlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import message
from tracewright.operators import reports as R


@pytest.mark.parametrize(("event", "want"), [('{"id":"a","category":"c","latency_ms":0}', True), ('{"id":"a","category":"c","latency_ms":10000}', True), ('{"id":"a","category":"c","latency_ms":10001}', False), ('{"id":"a","category":"c","latency_ms":true}', False), ('{"id":1,"category":"c","latency_ms":1}', False), ('{"id":"","category":"c","latency_ms":1}', False), ('{"id":"a","latency_ms":1.5}', False), ('{"id":"a","category":"c","latency_ms":1.5}', True), ("{bad", False), (None, False)])
def test_valid_event(spark, event, want):
    assert spark.createDataFrame([(event,)], "e string").select(R.valid_event(F.col("e"))).first()[0] is want


def test_audit(spark):
    df = spark.createDataFrame([("b", "y", 1.0), ("a", "x", 2.0), ("c", "x", 0.15), ("d", "y", 0.0)], "id string, category string, latency_ms double")
    r = R.audit_summary(df).first()
    assert (r["count"], r.top_category, r.mean_latency) == (4, "x", 0.8)
    assert R.ids_token(df, "live") == hashlib.sha256(b"live:a,b,c,d").hexdigest()[:12]
    assert R.audit_summary(df.limit(0)).first()["count"] == 0


def test_registries(spark):
    df = spark.createDataFrame([("a b\nc",), (None,), ("",), ("a b\nc",)], "text string")
    assert sorted(r.n_words for r in R.SERVICES.call("word_count", df).collect()) == [0, 0, 3, 3]
    assert sorted((r.n_lines, r.longest_line) for r in R.SERVICES.call("line_stats", df).collect())[-1] == (2, 3)
    assert R.SERVICES.call("dedupe", df).count() == 3
    with pytest.raises(TypeError, match="text: string"):
        R.SERVICES.call("word_count", df.select(F.lit(1).alias("text")))
    with pytest.raises(KeyError, match="unknown"):
        R.SERVICES.call("nope", df)
    sections = R.Sections()
    sections.add("count")(lambda d: d.agg(F.count(F.lit(1)).alias("value")).withColumn("label", F.lit("rows")))
    sections.add("blank")(lambda d: d.where("text = ''").select(F.lit("blank").alias("label"), F.lit(1).alias("value")))
    assert [tuple(r) for r in sections.render(df).orderBy("section_no").collect()] == [(0, "count", "rows", "4"), (1, "blank", "blank", "1")]
    agents = spark.createDataFrame([("a", "x"), ("b", "x")], "label string, command string")
    assert R.roster(agents).count() == 2
    with pytest.raises(ValueError, match="not unique: a"):
        R.roster(agents.union(agents.where("label = 'a'")))


def test_small_ones(spark, sessions):
    s = sessions([(1, [message("user", "  a   title "), message("assistant", "x", [("i", "n", "{}")])]), (2, None)])
    got = {r.sample_id: (r.title, r.n_messages, r.n_calls) for r in R.session_meta(s, "sample_id").collect()}
    assert got[1] == ("a title", 2, 1) and got[2][0] == "(untitled)" and got[2][1] == 0
    df = spark.createDataFrame([(1, [1, 2], [0, 1]), (2, [1, 2, 3], [0, 1, 0]), (3, [1], [0])], "k int, ids array<int>, mask array<int>")
    assert [r.k for r in R.trainable(df, "ids", "mask", 3).collect()] == [1]
    assert [r.k for r in R.head(df, 2, "k").collect()] == [1, 2] and R.head(df, 0).count() == 3
    n = spark.createDataFrame([(1, "b"), (2, "A"), (3, None)], "k int, s string")
    assert [r.k for r in R.dashboard_order(n, "s", "k", False).collect()] == [3, 2, 1]
    y = {r.stage: (r.n, r.percent) for r in R.yield_report(spark.createDataFrame([("x",), (None,), (None,)], "failed_stage string")).collect()}
    assert y == {"x": (1, 33.33), "kept": (2, 66.67)}
    assert spark.range(1).select(R.default_usage().alias("u")).first().u.total == 0
