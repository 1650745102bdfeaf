"""Streams (S-13, S-24, T-1..T-6): folder watch, SSE reassembly, token bucket, dispatch, sessions.

The stateful operators keep a small state for each key (transformWithStateInPandas), the rest are
stateless projections or built-in windowed aggregations with a watermark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

WATERMARK = "30 minutes"


def watch_folder(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """(file, value) of new .json, .jsonl and .txt files, each file once (T-2, S-13)."""
    rows = spark.readStream.option("maxFilesPerTrigger", max_files).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return rows.where(F.lower("file").rlike(r"\.(json|jsonl|txt)$"))


def append_indexed(batch: DataFrame, path: str) -> None:
    """foreachBatch body (T-3): appends rows with indices that go on from those there, each its own.

    The next free index is kept in a one-row table beside the rows, so no batch reads them; where it is
    missing it is found from the rows.  Only a path that does not exist yet counts as empty."""
    spark = batch.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    there = lambda p: hadoop.Path(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop.Path(p))
    mark = f"{path.rstrip('/')}.next"
    if there(mark):
        start = spark.read.schema("next bigint").json(mark).agg(F.max("next")).first()[0]
    elif there(path):
        start = spark.read.parquet(path).agg(F.max("idx") + 1).first()[0]
    else:
        start = 0
    start = start or 0
    placed = batch.withColumn("idx", F.monotonically_increasing_id() + F.lit(start))
    placed.write.mode("append").parquet(path)
    top = spark.read.parquet(path).where(F.col("idx") >= start).agg(F.max("idx") + 1).first()[0]
    if top is not None:
        spark.createDataFrame([(top,)], "next bigint").coalesce(1).write.mode("append").json(mark)


# --- server-sent events ---------------------------------------------------------------------------

_CALL = "index int, id string, type string, function struct<name: string, arguments: string>"
_EVENT = f"choices array<struct<finish_reason: string, delta: struct<content: string, reasoning_content: string, reasoning: string, tool_calls: array<struct<{_CALL}>>>>>, usage string"


def _joined(parts: Column) -> Column:
    """The texts one after the other; null if nothing is in them."""
    return F.nullif(F.array_join(F.filter(parts, lambda x: x.isNotNull()), ""), F.lit(""))


def _last(values: Column) -> Column:
    return F.try_element_at(F.filter(values, lambda x: x.isNotNull() & (x != "")), F.lit(-1))


def message_of(body: Column) -> Column:
    """Struct (content, reasoning, tool_calls, finish_reason, usage, message) of an event stream's text (T-1, S-24).

    Lines that begin with data: hold one JSON event each; other lines, the end mark and unreadable events
    count for nothing.  Texts are joined in order, parts of a call by its index; empty texts are null.
    tool_calls holds id, name and arguments of each call, message the whole reply (both JSON)."""
    data = F.transform(F.filter(F.split(body, r"\r?\n"), lambda line: F.ltrim(line).startswith("data:")), lambda line: F.trim(F.substring(F.ltrim(line), 6, 1 << 30)))
    events = F.filter(F.transform(data, lambda t: F.when(t.startswith("{"), F.from_json(F.when(F.try_parse_json(t).isNotNull(), t), _EVENT))), lambda e: e.isNotNull())
    choices = F.flatten(F.transform(events, lambda e: F.coalesce(e["choices"], F.expr("from_json('[]', 'array<struct<finish_reason: string, delta: struct<content: string, reasoning_content: string, reasoning: string, tool_calls: array<struct<index: int, id: string, type: string, function: struct<name: string, arguments: string>>>>>>')"))))
    parts = F.flatten(F.filter(F.transform(choices, lambda c: c["delta"]["tool_calls"]), lambda t: t.isNotNull()))
    place = lambda p: F.coalesce(p["index"], F.lit(0))

    def call(at: Column) -> Column:
        mine = F.filter(parts, lambda p: place(p) == at)
        get = lambda f: F.transform(mine, f)
        return F.struct(
            _last(get(lambda p: p["id"])).alias("id"), F.coalesce(_last(get(lambda p: p["type"])), F.lit("function")).alias("type"),
            F.struct(F.coalesce(_joined(get(lambda p: p["function"]["name"])), F.lit("")).alias("name"), F.coalesce(_joined(get(lambda p: p["function"]["arguments"])), F.lit("")).alias("arguments")).alias("function"),
        )

    calls = F.transform(F.array_sort(F.array_distinct(F.transform(parts, place))), call)
    flat = F.transform(calls, lambda c: F.struct(c["id"].alias("id"), c["function"]["name"].alias("name"), c["function"]["arguments"].alias("arguments")))
    content = _joined(F.transform(choices, lambda c: c["delta"]["content"]))
    thought = _joined(F.transform(choices, lambda c: F.coalesce(F.nullif(c["delta"]["reasoning_content"], F.lit("")), c["delta"]["reasoning"])))
    some = F.size(calls) > 0
    message = F.to_json(F.struct(F.lit("assistant").alias("role"), content.alias("content"), thought.alias("reasoning_content"), F.when(some, calls).alias("tool_calls")))
    return F.struct(
        content.alias("content"), thought.alias("reasoning"), F.when(some, F.to_json(flat, {"ignoreNullFields": "false"})).alias("tool_calls"),
        _last(F.transform(choices, lambda c: c["finish_reason"])).alias("finish_reason"), _last(F.transform(events, lambda e: e["usage"])).alias("usage"), message.alias("message"),
    )


def reassemble(chunks: DataFrame) -> DataFrame:
    """Messages of whole streams (stream_id, seq, bytes), batch form; one stream is one reply and small.

    Null chunks are empty; chunks of equal seq go by their text; a stream without an event gives nulls."""
    bodies = chunks.groupBy("stream_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.coalesce("bytes", F.lit("")).alias("bytes")))), lambda c: c["bytes"]), "").alias("body"))
    return bodies.select("stream_id", message_of(F.col("body")).alias("m")).select("stream_id", "m.*")


class Gatherer(StatefulProcessor):
    """Keeps the text of each stream and gives it out whole when its end mark has come."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.text = handle.getValueState("text", "body string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        part = pd.concat(rows).sort_values("seq")
        body = (self.text.get()[0] if self.text.exists() else "") + "".join(part["bytes"].dropna())
        if END_MARK in body:
            self.text.clear()
            yield pd.DataFrame({"stream_id": [key[0]], "body": [body]})
        else:
            self.text.update((body,))

    def close(self) -> None:
        pass


END_MARK = "[DONE]"


def reassemble_stream(chunks: DataFrame) -> DataFrame:
    """The streaming form of reassemble; needs the RocksDB state store.  Only the gathering of a stream's
    text is Python, the reply is read out of it as in the batch form."""
    whole = chunks.groupBy("stream_id").transformWithStateInPandas(Gatherer(), "stream_id string, body string", "Append", "None")
    return whole.select("stream_id", message_of(F.col("body")).alias("m")).select("stream_id", "m.*")


# --- token bucket ---------------------------------------------------------------------------------

def spend(requests: Iterable[tuple[float, float]], capacity: float, rate: float, level: float | None = None, last: float | None = None) -> tuple[list[bool], float, float | None]:
    """Which of (time, cost) requests a bucket grants (T-4): it fills at ``rate`` up to ``capacity``; a
    denied request spends nothing, an earlier time refills nothing."""
    level = capacity if level is None else level
    out = []
    for at, cost in requests:
        if last is not None:
            level = min(capacity, level + max(0.0, at - last) * rate)
        last = at if last is None else max(last, at)
        granted = cost <= level
        if granted:
            level -= cost
        out.append(granted)
    return out, level, last


def token_bucket(requests: DataFrame, capacity: float, rate: float) -> DataFrame:
    """key, ts, cost, granted of requests (key, ts, cost), batch form.

    A bucket is sequential by nature; its requests stream through in time order in Arrow batches, with the
    level carried over, so a hot key is sorted on disk and never gathered."""
    ordered = requests.select("key", F.col("ts").cast("double").alias("ts"), F.col("cost").cast("double").alias("cost")).repartition("key").sortWithinPartitions("key", "ts", "cost")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, level, last = None, None, None
        for part in parts:
            granted = []
            for k, at, cost in zip(part["key"], part["ts"], part["cost"]):
                if k != key:
                    key, level, last = k, None, None
                ok, level, last = spend([(at, cost)], capacity, rate, level, last)
                granted.extend(ok)
            yield part.assign(granted=granted)

    return ordered.mapInPandas(run, "key string, ts double, cost double, granted boolean")


class Bucket(StatefulProcessor):
    """The bucket of one key as streaming state."""

    def __init__(self, capacity: float, rate: float):
        self.capacity, self.rate = capacity, rate

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("bucket", "level double, last double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        level, last = self.state.get() if self.state.exists() else (None, None)
        for part in rows:
            part = part.sort_values("ts")
            granted, level, last = spend(zip(part["ts"], part["cost"]), self.capacity, self.rate, level, last)
            yield part.assign(granted=granted)[["key", "ts", "cost", "granted"]]
        if level is not None:
            self.state.update((level, last))

    def close(self) -> None:
        pass


def token_bucket_stream(requests: DataFrame, capacity: float, rate: float) -> DataFrame:
    return requests.groupBy("key").transformWithStateInPandas(Bucket(capacity, rate), "key string, ts double, cost double, granted boolean", "Append", "None")


# --- dispatch and sessions ------------------------------------------------------------------------

def dispatch(events: DataFrame, limits: dict[str, float], ttl: int = 3) -> DataFrame:
    """Events (kind, amount, ttl) with ``accepted`` and the new ttl (T-5): accepted up to the kind's limit,
    a heartbeat takes one from its ttl; unknown kinds are errors."""
    known = F.col("kind").isin(list(limits))
    limit = F.lit(None).cast("double")
    for kind, most in limits.items():
        limit = F.when(F.col("kind") == kind, F.lit(float(most))).otherwise(limit)
    checked = F.when(known, limit).otherwise(F.raise_error(F.concat(F.lit("unknown kind: "), F.coalesce("kind", F.lit("null")))))
    return events.withColumn("accepted", F.col("amount") <= checked).withColumn("ttl", F.when(F.col("kind") == "heartbeat", F.coalesce("ttl", F.lit(ttl)) - 1).otherwise(F.col("ttl")))


def dispatch_counts(dispatched: DataFrame) -> DataFrame:
    """accepted and rejected by kind; also on a stream."""
    return dispatched.groupBy("kind").agg(F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"))


def sessions(events: DataFrame, user: str, ts: str, gap: str = "30 minutes") -> DataFrame:
    """Event counts of sessions that end after a gap (T-6); on a stream late rows beyond the watermark are dropped."""
    rows = events.withWatermark(ts, WATERMARK) if events.isStreaming else events
    out = rows.groupBy(user, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n_events"))
    return out.select(user, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n_events")
