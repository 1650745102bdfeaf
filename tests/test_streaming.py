import json

import pytest
from pyspark.sql import functions as F

from tracewright.streaming import streams as S

EVENTS = [
    {"choices": [{"delta": {"content": "Hel"}}]}, {"choices": [{"delta": {"content": "lo", "reasoning": "why"}}]},
    {"choices": [{"delta": {"tool_calls": [{"index": 1, "id": "b", "function": {"name": "gr", "arguments": "{"}}]}}]}, {"choices": [{"delta": {"tool_calls": [{"index": 0, "id": "a", "function": {"name": "read", "arguments": "{}"}}, {"index": 1, "function": {"name": "ep", "arguments": "}"}}]}, "finish_reason": "tool_calls"}]},
    {"usage": {"total_tokens": 7}},
]
RAW = "".join(f"data: {json.dumps(e)}\n\n" for e in EVENTS[:3]) + ": comment\ndata: {bad\n" + "".join(f"data: {json.dumps(e)}\n" for e in EVENTS[3:]) + "data: [DONE]\n"


def chunks(size):
    return [("s", k, RAW[at : at + size]) for k, at in enumerate(range(0, len(RAW), size))] + [("t", 0, 'data: {"choices":[{"delta":{"content":""}}]}\n')]


@pytest.mark.parametrize("size", [7, 1000])
def test_reassembly(spark, size):
    rows = {r.stream_id: r for r in S.reassemble(spark.createDataFrame(chunks(size), "stream_id string, seq int, bytes string")).collect()}
    s = rows["s"]
    assert (s.content, s.reasoning, s.finish_reason, json.loads(s.usage)) == ("Hello", "why", "tool_calls", {"total_tokens": 7})
    assert json.loads(s.tool_calls) == [{"id": "a", "name": "read", "arguments": "{}"}, {"id": "b", "name": "grep", "arguments": "{}"}] and rows["t"].content is None


def test_folder_watch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text("1\n2\n")
    (src / "b.bin").write_text("x\n")

    def run():
        q = S.watch_folder(spark, str(src)).writeStream.foreachBatch(lambda df, _: S.append_indexed(df, str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination(60)

    run()
    (src / "c.txt").write_text("3\n")
    run()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.value for r in got) == ["1", "2", "3"] and len({r.idx for r in got}) == 3


def test_stateful_streams(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    src = tmp_path / "b"
    spark.createDataFrame([("k", float(t), 1.0) for t in (0, 0, 0, 10)], "key string, ts double, cost double").coalesce(1).write.json(str(src))
    stream = spark.readStream.schema("key string, ts double, cost double").json(str(src))
    q = S.token_bucket_stream(stream, 2.0, 0.1).writeStream.format("memory").queryName("bucket").option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.ts, r.granted) for r in spark.table("bucket").collect()) == [(0.0, False), (0.0, True), (0.0, True), (10.0, True)]


def test_batch_bucket(spark):
    rows = [("a", 0.0, 1.0), ("a", 0.0, 1.0), ("a", 0.0, 1.0), ("a", 100.0, 1.0), ("a", 100.0, 3.0), ("b", 0.0, 2.0)]
    got = sorted((r.key, r.ts, r.cost, r.granted) for r in S.token_bucket(spark.createDataFrame(rows, "key string, ts double, cost double"), 2.0, 1.0).collect())
    assert got == [("a", 0.0, 1.0, False), ("a", 0.0, 1.0, True), ("a", 0.0, 1.0, True), ("a", 100.0, 1.0, True), ("a", 100.0, 3.0, False), ("b", 0.0, 2.0, True)]


def test_dispatch(spark):
    df = spark.createDataFrame([("x", 5.0, None), ("x", 50.0, None), ("heartbeat", 1.0, 3)], "kind string, amount double, ttl int")
    out = S.dispatch(df, {"x": 10, "heartbeat": 10})
    assert sorted((r.kind, r.accepted, r.ttl) for r in out.collect()) == [("heartbeat", True, 2), ("x", False, None), ("x", True, None)]
    with pytest.raises(Exception, match="unknown kind"):
        S.dispatch(df, {"x": 10}).collect()
    assert {r.kind: (r.accepted, r.rejected) for r in S.dispatch_counts(out).collect()} == {"x": (1, 1), "heartbeat": (1, 0)}


def test_sessions(spark):
    df = spark.sql("SELECT 'u' AS u, timestamp'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, m) AS ts FROM VALUES (0), (10), (45) AS t(m)")
    assert sorted(r.n_events for r in S.sessions(df, "u", "ts").collect()) == [1, 2]
