"""Queries through the readers, writers and the session database: whole tables go out in a format and come back."""

from __future__ import annotations

import json
import sqlite3
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.functions import text as X
from tracewright.operators import usage as U
from tracewright.plans.contract import query
from tracewright.plans.usage import _CALLS
from tracewright.session import MESSAGE, scratch, table
from tracewright.sources import readers as R
from tracewright.sources import sessiondb
from tracewright.sources import sinks as K

_CONTENTS = "md5(array_to_string(list_transform(messages, lambda m: m.role || ':' || coalesce(m.content, '-')), chr(10)))"
_NESTED = T.StructType([T.StructField("sample_id", T.LongType()), T.StructField("messages", T.ArrayType(MESSAGE)), T.StructField("tools", T.StringType()), T.StructField("source", T.StringType()), T.StructField("model", T.StringType())])


def _contents(messages="messages"):
    return F.md5(F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), F.coalesce(m["content"], F.lit("-")))), "\n"))


def _sft(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sft_dataset")


@query("jsonl_round_trip", f"SELECT sample_id, source, model, md5(tools) AS tools, len(messages)::BIGINT AS n_messages, {_CONTENTS} AS digest FROM sft_dataset")
def jsonl_round_trip(s, d):
    """K-1 and S-2: sessions written as JSON lines and read strictly."""
    path = scratch(s)
    K.write_jsonl(_sft(s, d).select("sample_id", "messages", "tools", "source", "model", F.lit(1).alias("_internal")), path)
    back = R.jsonl_strict(s, path, _NESTED)
    return back.select("sample_id", "source", "model", F.md5("tools").alias("tools"), F.when(F.col("messages").isNotNull(), F.size("messages")).cast("bigint").alias("n_messages"), _contents().alias("digest"))


@query("lenient_sessions", f"SELECT coalesce(source, 'none') AS source, count(*) AS n, sum(len(messages))::BIGINT AS n_messages, md5(string_agg({_CONTENTS}, ',' ORDER BY {_CONTENTS})) AS digest FROM sft_dataset WHERE messages IS NOT NULL GROUP BY 1")
def lenient_sessions(s, d):
    """S-1: malformed lines and rows without a message list are skipped."""
    path = scratch(s)
    good = _sft(s, d)
    lines = good.select(K.as_json_line(good.drop("_group", "_split")).alias("value"))
    bad = s.createDataFrame([("{bad",), ("",), ("[1]",), ('{"messages": 3}',)], "value string")
    lines.unionByName(bad).write.text(path)
    back = R.jsonl_lenient(s, path).select("source", "messages", _contents().alias("c"))
    return back.groupBy(F.coalesce("source", F.lit("none")).alias("source")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("messages")).alias("n_messages"), F.md5(F.array_join(F.array_sort(F.collect_list("c")), ",")).alias("digest"))


@query("split_files", "SELECT CASE WHEN _split = 'eval' THEN 'eval' ELSE 'train' END AS part, count(*) AS n, sum(sample_id)::BIGINT AS ids FROM sft_dataset GROUP BY 1")
def split_files(s, d):
    """K-2: train and eval files."""
    folders = K.write_splits(_sft(s, d).select("sample_id", "source", "_split"), scratch(s))
    parts = [R.jsonl_strict(s, f, T.StructType([T.StructField("sample_id", T.LongType())])).select(F.lit(f.rsplit("/", 1)[1]).alias("part"), "sample_id") for f in folders]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("sample_id").alias("ids"))


@query("clean_lines", "SELECT doc_id, length(text) AS n_chars, md5(text) AS digest FROM documents WHERE text IS NOT NULL")
def clean_lines(s, d):
    """K-7: raw lines written as they were read."""
    raw, out = scratch(s), scratch(s)
    docs = table(s, d, "documents").where("text is not null").select("doc_id", "text")
    K.write_jsonl(docs, raw)
    K.write_clean(R.lines(s, raw).withColumnRenamed("value", "_raw"), out)
    back = R.jsonl_strict(s, out, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]))
    return back.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest"))


@query("written_bytes", "SELECT count(*) AS lines FROM events")
def written_bytes(s, d):
    """K-9: the manifest's lines, which must be those written and its bytes those of the files' lines."""
    rows, path = table(s, d, "events"), scratch(s)
    K.write_jsonl(rows, path)
    there = s.read.text(path).agg(F.sum(F.octet_length("value") + 1).alias("b"))
    return K.manifest(rows).crossJoin(there).select(F.when(F.col("bytes") == F.col("b"), F.col("lines")).alias("lines"))  # two rows of one


@query("csv_column", "SELECT count(*) AS n, count(o_totalprice) AS known, round(sum(o_totalprice), 2) AS total FROM orders")
def csv_column(s, d):
    """S-16: a number column of a CSV file."""
    path = scratch(s)
    table(s, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").write.option("header", True).csv(path)
    return R.csv_column(s, path, "o_totalprice").agg(F.count(F.lit(1)).alias("n"), F.count("o_totalprice").alias("known"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("messy_csv", "SELECT n_nationkey::VARCHAR AS n_nationkey, n_name FROM nation")
def messy_csv(s, d):
    """S-15: comments, indented ones too, and blank lines in a CSV file."""
    path = scratch(s)
    rows = table(s, d, "nation").select(F.concat_ws(",", "n_nationkey", "n_name").alias("value"), F.col("n_nationkey").alias("k"))
    head = s.createDataFrame([("# a note", -3), ("n_nationkey,n_name", -2), ("   # indented", -1), ("", 100)], "value string, k int")
    head.unionByName(rows).coalesce(1).sortWithinPartitions("k").select("value").write.text(path)
    return R.messy_csv(s, path)


@query("task_manifest", "SELECT id AS task_id, type, md5(prompt) AS prompt, 1.0::DOUBLE AS weight FROM tasks")
def task_manifest(s, d):
    """S-19, K-11: task lines; an absent weight is 1."""
    path = scratch(s)
    K.write_jsonl(table(s, d, "tasks").select(F.col("id").alias("task_id"), "type", "prompt"), path)
    return R.task_manifest(s, path).withColumn("prompt", F.md5("prompt"))


@query("key_values", "SELECT 'N' || n_nationkey AS key, n_name AS value FROM nation")
def key_values(s, d):
    """S-20: KEY=VALUE lines; the last assignment wins."""
    rows = table(s, d, "nation").select(F.concat(F.lit("# "), "n_name", F.lit("\nN"), F.col("n_nationkey").cast("string"), F.lit("=old\n\n N"), F.col("n_nationkey").cast("string"), F.lit(" = "), "n_name").alias("text"))
    return R.key_values(rows, "text")


@query("parsed_input", "SELECT o_orderkey, record_no FROM (SELECT o_orderkey, unnest(CASE WHEN o_orderstatus = 'P' THEN [0] ELSE [0, 1] END) AS record_no FROM orders)")
def parsed_input(s, d):
    """S-6: whole texts that are an object, a JSON list or lines."""
    one = F.concat(F.lit('{"k":'), F.col("o_orderkey").cast("string"), F.lit("}"))
    text = F.when(F.col("o_orderstatus") == "P", one).when(F.col("o_orderstatus") == "F", F.concat(F.lit("["), one, F.lit(","), one, F.lit("]"))).otherwise(F.concat(one, F.lit("\n\n"), one))
    parsed = R.parse_input(table(s, d, "orders").select("o_orderkey", text.alias("text")), "text")
    return parsed.where(F.get_json_object("record", "$.k") == F.col("o_orderkey").cast("string")).select("o_orderkey", "record_no")


@query("extracted_sessions", "SELECT sample_id, len(messages)::BIGINT AS n FROM sft_dataset WHERE messages IS NOT NULL")
def extracted_sessions(s, d):
    """S-7: the four shapes of a record give their messages."""
    m = F.to_json("messages")
    rows = _sft(s, d).where("messages is not null").select("sample_id", m.alias("m"), F.col("task_type").alias("t"), F.size("messages").alias("size"))
    first = F.concat(F.lit('{"request":{"messages":'), "m", F.lit('},"response":{}}'))
    shaped = rows.select("sample_id", F.when(F.col("t").isNull(), F.concat(F.lit('{"messages":'), "m", F.lit("}"))).when(F.length("t") > 6, first).otherwise(F.col("m")).alias("r"))
    return shaped.select("sample_id", F.json_array_length(R.extract_session(F.col("r"))).cast("bigint").alias("n"))


@query("upserted_orders", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders UNION ALL SELECT -n_nationkey - 1, 1 FROM nation")
def upserted_orders(s, d):
    """K-5: changed rows replace, new ones are added."""
    orders = table(s, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    changed = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0)).unionByName(table(s, d, "nation").select((-F.col("n_nationkey") - 1).cast("bigint").alias("o_orderkey"), F.lit(1.0).alias("o_totalprice"), F.lit("N").alias("o_orderstatus")))
    return K.upsert(orders, changed, "o_orderkey").select("o_orderkey", "o_totalprice")


@query("distilled_references", "SELECT id AS task_id, md5(prompt || '|' || coalesce(reference, '')) AS digest FROM tasks WHERE type = 'knowledge'")
def distilled_references(s, d):
    """K-8: failed knowledge tasks as conversations of their references."""
    failed = table(s, d, "tasks").select(F.col("id").alias("task_id"), "type", F.lit(False).alias("passed"), F.array(F.struct("prompt", "reference")).alias("turns"))
    return K.distilled(failed).select("task_id", F.md5(F.concat(F.col("messages")[0]["content"], F.lit("|"), F.coalesce(F.col("messages")[1]["content"], F.lit("")))).alias("digest"))


@query("export_summary", f"{_CALLS}, g AS (SELECT session_id, sum(prompt + completion + reasoning) AS t, arg_min(model, record_id) AS model FROM u WHERE session_id IS NOT NULL GROUP BY 1) SELECT count(*) AS n, sum(t)::BIGINT AS tokens, list_sort(list(DISTINCT model)) AS models FROM g")
def export_summary(s, d):
    """K-10, A-15: what an export holds before it is filtered."""
    sums = U.calls(table(s, d, "proxy_records")).where("session_id is not null").groupBy(F.col("session_id").alias("id")).agg(F.sum("prompt").alias("tokens_input"), F.sum("completion").alias("tokens_output"), F.sum("reasoning").alias("tokens_reasoning"), F.min_by("model", "record_id").alias("model"))
    return K.export(sums, None)[1]


@query("priced_calls", f"{_CALLS} SELECT record_id, round(cost, 8) AS cost FROM u WHERE cost > 0")
def priced_calls(s, d):
    """F-30: calls that cost something."""
    return U.priced(U.calls(table(s, d, "proxy_records"))).select("record_id", F.round("cost", 8).alias("cost"))


@query("source_labels", "SELECT CASE WHEN lower(upstream) = 'openrouter' THEN 'frontier' WHEN replay IS NOT NULL THEN 'replay' ELSE 'opencode' END AS label, count(*) AS n FROM proxy_records GROUP BY 1")
def source_labels(s, d):
    """P-11."""
    return table(s, d, "proxy_records").groupBy(U.source_label(F.col("upstream"), F.col("replay")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


_ARGS = "flatten(list_transform(messages, lambda m: coalesce(m.tool_calls, [])))"
_KEYS = ", ".join(f"json_extract_string(a, '$.{k}')" for k in ("description", "filePath", "file_path", "path", "command", "cmd", "query", "pattern", "url", "prompt", "content", "todos", "questions"))


@query("argument_summaries", f"""SELECT sample_id, pos, md5(CASE WHEN json_valid(a) THEN coalesce({_KEYS}, a) ELSE a END) AS digest FROM (SELECT sample_id, unnest({_ARGS})."function".arguments AS a, generate_subscripts({_ARGS}, 1) - 1 AS pos FROM sft_dataset)""")
def argument_summaries(s, d):
    """P-9: the first usual key of each call's arguments."""
    calls = F.flatten(F.transform("messages", lambda m: F.coalesce(m["tool_calls"], F.array().cast(MESSAGE["tool_calls"].dataType))))
    return _sft(s, d).select("sample_id", F.posexplode(calls).alias("pos", "c")).select("sample_id", F.col("pos").cast("bigint").alias("pos"), F.md5(X.summarise_args(F.col("c.function.arguments"))).alias("digest"))


def _database(s: SparkSession, d: str) -> str:
    """The sessions as an agent's database; rows stream through the driver, which writes the one file."""
    folder = Path(scratch(s).removeprefix("file:"))
    folder.mkdir(parents=True, exist_ok=True)
    path = str(folder / f"{uuid.uuid4().hex}.db")
    with sqlite3.connect(path) as db:
        for name, columns in sessiondb.TABLES.items():
            db.execute(f"CREATE TABLE {name} ({columns.replace('string', 'TEXT').replace('bigint', 'INTEGER').replace('double', 'REAL')})")
        for r in _sft(s, d).select("sample_id", "model", F.transform(F.coalesce("messages", F.array().cast(T.ArrayType(MESSAGE))), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("m")).toLocalIterator(prefetchPartitions=True):
            sid = f"s{r.sample_id}"
            db.execute("INSERT INTO session (id, title, model, time_updated) VALUES (?, ?, ?, ?)", (sid, f"session {r.sample_id}", r.model, r.sample_id))
            for k, m in enumerate(r.m):
                tool = m.role == "tool"
                if not tool:
                    db.execute("INSERT INTO message VALUES (?, ?, ?, ?)", (f"{sid}-{k}", sid, k, json.dumps({"role": m.role})))
                part = {"type": "tool", "state": {"output": m.content}} if tool else {"type": "text", "text": m.content}
                db.execute("INSERT INTO part VALUES (?, ?, ?, ?, ?)", (f"{sid}-{k}p", f"{sid}-{k}", sid, k, json.dumps(part)))
    return path


def _db_table(s: SparkSession, path: str, name: str) -> DataFrame:
    sessiondb.register(s)
    return s.read.format("sessiondb").option("path", path).option("table", name).load()


@query("db_sessions", "SELECT 's' || sample_id AS id, model FROM sft_dataset WHERE model IS NOT NULL")
def db_sessions(s, d):
    """S-8: the session table of the database, the filter pushed into it."""
    return _db_table(s, _database(s, d), "session").where("model is not null").select("id", "model")


_DEAD = " OR ".join(f"contains(lower(m.content), '{p}')" for p in ("command not found", "no such file or directory", "traceback (most recent", "is not recognized as", "permission denied", "fatal:", "syntaxerror"))


@query("db_session_page", f"""SELECT 's' || sample_id AS id, len(list_filter(messages, lambda m: m.role = 'assistant'))::BIGINT AS steps, len(list_filter(messages, lambda m: m.role = 'tool'))::BIGINT AS tool_calls, len(list_filter(messages, lambda m: m.role = 'tool' AND coalesce({_DEAD}, false)))::BIGINT AS dead_ends
FROM (SELECT sample_id, coalesce(messages, []) AS messages FROM sft_dataset) ORDER BY sample_id DESC LIMIT 500""")
def db_session_page(s, d):
    """O-1, J-6: the page of sessions updated last, with their counts (500 is the page's size)."""
    path = _database(s, d)
    page = U.session_page(_db_table(s, path, "session"), limit=500)
    return U.with_child_counts(page, _db_table(s, path, "message"), _db_table(s, path, "part")).select("id", "steps", "tool_calls", "dead_ends")


@query("db_nested_export", "SELECT 's' || sample_id AS id, len(list_filter(coalesce(messages, []), lambda m: m.role <> 'tool'))::BIGINT AS n_messages, array_to_string(list_transform(list_filter(coalesce(messages, []), lambda m: m.role <> 'tool'), lambda m: m.role), ',') AS roles FROM sft_dataset")
def db_nested_export(s, d):
    """J-5, P-6: sessions with their ordered messages and parts; every message has its one part."""
    path = _database(s, d)
    nested = U.nest_export(_db_table(s, path, "session").select("id"), _db_table(s, path, "message"), _db_table(s, path, "part"))
    whole = F.forall("messages", lambda m: F.size(m["parts"]) == 1)
    return nested.where(whole).select("id", F.size("messages").cast("bigint").alias("n_messages"), F.array_join(F.transform("messages", lambda m: F.get_json_object(m["info"], "$.role")), ",").alias("roles"))
