"""Problem 5: rebuilding conversations from message rows.

Rows are an event log.  Deliveries of one ``record_id`` fold to the version ingested last; what is kept
of a row before that shuffle is only its instant and, for each message, role, visibility and call ids.
Messages are then ordered by (instant, place in the row).  All checks but the order-dependent ones are
plain aggregates.  Those two (replies, adjacent assistant messages) are folded over range-sorted chunks:
each chunk of a session gives one small summary, and summaries join associatively, so a session that
holds a third of all rows is spread over many tasks and no task ever holds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.session import durable, shuffle_partitions, table

#: Spellings of the four roles.
ROLES = {"user": ["user", "human", "customer"], "assistant": ["assistant", "model", "ai", "bot"], "system": ["system", "developer"], "tool": ["tool", "function", "tool_result"]}
VISIBLE = r"[^\s\p{Z}\p{C}\x{2800}\x{3164}\x{115F}\x{1160}\x{FFA0}\x{034F}]"


def role_name(col: Column) -> Column:
    """user, assistant, system or tool; any other spelling stays as it is, in lower case."""
    plain = F.lower(F.trim(col))
    out = plain
    for name, spellings in ROLES.items():
        out = F.when(plain.isin(spellings), F.lit(name)).otherwise(out)
    return out


def instant_micros(col: Column) -> Column:
    """Microseconds since the epoch of a stamp, null where it is missing or unreadable.

    Read are compact stamps in UTC with any one separator or none, ISO-8601 with or without zone
    (without: UTC), epoch seconds (10 digits) and epoch milliseconds (13 digits)."""
    s = F.trim(col)
    compact = F.regexp_extract(s, r"^(\d{8})[^0-9]?(\d{6})Z?$", 1)
    clock = F.regexp_extract(s, r"^(\d{8})[^0-9]?(\d{6})Z?$", 2)
    iso = r"^(\d{4}-\d{2}-\d{2})[Tt ](\d{2}:\d{2})(:\d{2})?(\.\d{1,9})?\s*([Zz]|[+-]\d{2}:?\d{2})?$"
    zone = F.regexp_extract(s, iso, 5)
    zone = F.when(F.upper(zone).isin("", "Z"), F.lit("+00:00")).otherwise(F.regexp_replace(zone, r"^([+-]\d{2}):?(\d{2})$", "$1:$2"))
    seconds = F.coalesce(F.nullif(F.regexp_extract(s, iso, 3), F.lit("")), F.lit(":00"))
    fraction = F.rpad(F.substring(F.regexp_replace(F.regexp_extract(s, iso, 4), r"\.", ""), 1, 6), 6, "0")
    iso_text = F.concat(F.regexp_extract(s, iso, 1), F.lit("T"), F.regexp_extract(s, iso, 2), seconds, zone)
    return (
        F.when(s.rlike(r"^\d{13}$"), s.try_cast("bigint") * 1000)
        .when(s.rlike(r"^\d{10}$"), s.try_cast("bigint") * 1_000_000)
        .when(s.rlike(r"^\d{8}[^0-9]?\d{6}Z?$"), F.unix_micros(F.try_to_timestamp(F.concat(compact, clock), F.lit("yyyyMMddHHmmss"))))
        .when(s.rlike(iso), F.unix_micros(F.try_to_timestamp(iso_text, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))) + F.coalesce(fraction.try_cast("bigint"), F.lit(0)))
    )


def row_messages() -> Column:
    """The messages of a row of proxy_records: the request's, then the reply; none of a failed reply."""
    reply = F.when(F.col("response.message").isNotNull(), F.array(F.col("response.message"))).otherwise(F.expr("filter(request.messages, x -> false)"))
    asked = F.filter(F.coalesce(F.col("request.messages"), F.expr("filter(array(response.message), x -> false)")), lambda m: m.isNotNull())
    return F.concat(asked, F.coalesce(reply, F.expr("filter(array(response.message), x -> false)")))


def folded_rows(records: DataFrame) -> DataFrame:
    """One light row for each record_id: session_id, record_id, at (micros or null), msgs.

    The version ingested last wins; of equal ones, whichever sorts last.  Rows without a session are
    left out; a null record_id stands for itself."""
    light = _light_messages()
    rows = records.where("session_id is not null").select("session_id", "record_id", instant_micros(F.col("timestamp")).alias("at"), light.alias("msgs"), "ingested_at")
    kept = rows.where("record_id is not null").groupBy("session_id", "record_id").agg(F.max(F.struct(F.col("ingested_at"), F.col("at"), F.col("msgs"))).alias("v"))
    return kept.select("session_id", "record_id", "v.at", "v.msgs").unionByName(rows.where("record_id is null").select("session_id", "record_id", "at", "msgs"))


def _light_messages() -> Column:
    return F.transform(
        row_messages(),
        lambda m: F.struct(
            role_name(m["role"]).alias("role"),
            F.coalesce(m["content"].rlike(VISIBLE), F.lit(False)).alias("visible"),
            F.when(m["tool_call_id"].isNotNull(), F.xxhash64(m["tool_call_id"])).alias("answers"),
            F.transform(F.coalesce(m["tool_calls"], F.array()), lambda c: F.when(c["id"].isNotNull(), F.xxhash64(c["id"]))).alias("calls"),
        ),
    )


def ordered_messages(rows: DataFrame) -> DataFrame:
    """session_id, at, record_id, pos and the message's light fields, one row a message."""
    return rows.select("session_id", "at", "record_id", F.posexplode("msgs").alias("pos", "m")).select("session_id", "at", "record_id", "pos", "m.*")


def _chunk_summaries(messages: DataFrame) -> DataFrame:
    """Summaries of range-sorted chunks: what a later fold needs of each session's part of a chunk."""
    spread = messages.select("session_id", "at", "record_id", "pos", "role", "visible", (F.size("calls") > 0).alias("calling"))
    order = ["session_id", "at", "record_id", "pos"]
    spread = spread.repartitionByRange(max(2, shuffle_partitions(messages.sparkSession)), *order).sortWithinPartitions(*order)
    fields = "session_id string, at bigint, record_id bigint, pos int, first_role string, last_role string, adjacent boolean, has_user boolean, early_reply boolean, unanswered boolean, waiting boolean"

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), *[pa.bool_()] * 5]

    def packed(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in fields.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []  # the last one is still open: a session has one summary in a chunk, however long
        for batch in batches:
            for session, at, record, pos, role, visible, calling in zip(*(c.to_pylist() for c in batch.columns)):
                if not out or session != out[-1][0]:
                    out.append([session, at, record, pos, None, None, False, False, False, False, False])
                s = out[-1]
                if role == "system":
                    continue
                if s[4] is None:
                    s[4] = role
                elif role == "assistant" == s[5]:
                    s[6] = True
                s[5] = role
                if role == "user":
                    s[9] = s[9] or s[10]
                    s[7], s[10] = True, visible
                elif role == "assistant" and visible and not calling:
                    if s[7]:
                        s[10] = False
                    else:
                        s[8] = True
            if len(out) > 1:
                yield packed(out[:-1])
                del out[:-1]
        if out:
            yield packed(out)

    return spread.mapInArrow(run, fields)


def _fold(chunks: DataFrame) -> DataFrame:
    """session_id, first_role, adjacent, unanswered after joining a session's chunk summaries in order."""
    ordered = chunks.groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("at", "record_id", "pos", "first_role", "last_role", "adjacent", "has_user", "early_reply", "unanswered", "waiting"))).alias("c"))
    start = F.struct(F.lit(None).cast("string").alias("first_role"), F.lit(None).cast("string").alias("last_role"), F.lit(False).alias("adjacent"), F.lit(False).alias("unanswered"), F.lit(False).alias("waiting"))

    def join(a: Column, b: Column) -> Column:
        meets = F.coalesce((a["last_role"] == "assistant") & (b["first_role"] == "assistant"), F.lit(False))
        still = a["waiting"] & ~b["early_reply"]
        return F.struct(
            F.coalesce(a["first_role"], b["first_role"]).alias("first_role"),
            F.coalesce(b["last_role"], a["last_role"]).alias("last_role"),
            (a["adjacent"] | b["adjacent"] | meets).alias("adjacent"),
            (a["unanswered"] | b["unanswered"] | (b["has_user"] & still)).alias("unanswered"),
            F.when(b["has_user"], b["waiting"]).otherwise(still).alias("waiting"),
        )

    folded = ordered.select("session_id", F.aggregate("c", start, join).alias("f"))
    return folded.select("session_id", "f.first_role", "f.adjacent", (F.col("f.unanswered") | F.col("f.waiting")).alias("unanswered"))


def session_verdicts(records: DataFrame) -> DataFrame:
    """session_id and reason (empty, broken, missing_reply or null for a whole session), one row a session.

    Rows of equal record_id count once.  Sessions whose rows hold no message are empty.  Null session
    ids are left out; an empty table gives an empty result."""
    rows = durable(folded_rows(records))
    messages = ordered_messages(rows)
    base = rows.groupBy("session_id").agg(
        F.bool_or(F.col("at").isNull()).alias("unstamped"),
        F.bool_or(F.exists("msgs", lambda m: (m["role"] == "user") & m["visible"])).alias("asked"),
    )
    place = F.struct("at", "record_id", "pos")
    called = messages.where("size(calls) > 0").select("session_id", F.explode("calls").alias("call"), place.alias("place"), F.lit(True).alias("is_call"))
    answered = messages.where("role = 'tool'").select("session_id", F.col("answers").alias("call"), place.alias("place"), F.lit(False).alias("is_call"))
    by_call = called.unionByName(answered).groupBy("session_id", "call").agg(
        F.min(F.when(F.col("is_call"), F.col("place"))).alias("first_call"),
        F.min(F.when(~F.col("is_call"), F.col("place"))).alias("first_answer"),
    )
    loose = by_call.groupBy("session_id").agg(
        F.bool_or(F.col("call").isNull() | F.col("first_call").isNull() | F.col("first_answer").isNull() | F.coalesce(F.col("first_answer") < F.col("first_call"), F.lit(False))).alias("loose")
    )
    folded = _fold(_chunk_summaries(messages))
    joined = base.join(loose, "session_id", "left").join(folded, "session_id", "left")
    broken = F.col("unstamped") | (F.coalesce("first_role", F.lit("")) != "user") | F.coalesce("adjacent", F.lit(False)) | F.coalesce("loose", F.lit(False))
    reason = F.when(~F.coalesce("asked", F.lit(False)), "empty").when(broken, "broken").when(F.coalesce("unanswered", F.lit(False)), "missing_reply")
    return joined.select("session_id", reason.alias("reason"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions to drop, each with the first reason that holds."""
    return session_verdicts(table(spark, sf_dir, "proxy_records")).where("reason is not null")


def conversations(records: DataFrame) -> DataFrame:
    """The surviving sessions as ordered turns: session_id, turn_no (from 0), role, content, tool_call_id,
    call_names.  A turn stays a row, so a session of any length is never gathered in one place; turn
    numbers are local ranks of range-sorted parts plus the parts' offsets."""
    keep = session_verdicts(records).where("reason is null").select("session_id")
    # The version is chosen as folded_rows chooses it; rows without a record_id each stand for themselves.
    rows = records.where("session_id is not null").select("session_id", "record_id", "ingested_at", instant_micros(F.col("timestamp")).alias("at"), _light_messages().alias("light"), row_messages().alias("msgs")).join(keep, "session_id", "left_semi")
    kept = rows.where("record_id is not null").groupBy("session_id", "record_id").agg(F.max(F.struct("ingested_at", "at", "light", "msgs")).alias("v"))
    latest = kept.select("session_id", "record_id", "v.at", "v.msgs").unionByName(rows.where("record_id is null").select("session_id", "record_id", "at", "msgs"))
    turns = latest.select("session_id", "at", "record_id", F.posexplode("msgs").alias("pos", "m"))
    order = ["session_id", "at", "record_id", "pos"]
    parts = turns.repartitionByRange(max(2, shuffle_partitions(records.sparkSession)), *order).sortWithinPartitions(*order)
    placed = durable(parts.withColumn("part", F.spark_partition_id()).withColumn("line", F.monotonically_increasing_id()))
    spans = placed.groupBy("session_id", "part").agg(F.min("line").alias("start"), F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("session_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part, not for each turn
    before = spans.select("session_id", "part", "start", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    return placed.join(before, ["session_id", "part"]).select(
        "session_id",
        (F.col("line") - F.col("start") + F.col("offset")).alias("turn_no"),
        role_name(F.col("m.role")).alias("role"),
        F.col("m.content").alias("content"),
        F.col("m.tool_call_id").alias("tool_call_id"),
        F.transform(F.coalesce("m.tool_calls", F.array()), lambda c: c["function"]["name"]).alias("call_names"),
    )


def p5_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(table(spark, sf_dir, "proxy_records"))


QUERIES = {"p5_found": p5_found, "p5_conversations": p5_conversations}
