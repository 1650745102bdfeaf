"""Queries on reports and on the remaining lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.functions import text as X
from tracewright.operators import messages as M
from tracewright.operators import quality as Q
from tracewright.operators import reports as R
from tracewright.operators import usage as U
from tracewright.plans.contract import query
from tracewright.plans.sessions import _COMPACT
from tracewright.session import table
from tracewright.sources.readers import harness_profile


@query("audit_summary", "WITH n AS (SELECT event_type AS category, count(*) AS n FROM events WHERE value BETWEEN 0 AND 10000 GROUP BY 1) SELECT (SELECT sum(n) FROM n)::BIGINT AS count, (SELECT category FROM n ORDER BY n DESC, category LIMIT 1) AS top_category, (SELECT round_even(avg(value), 1) FROM events WHERE value BETWEEN 0 AND 10000) AS mean_latency")
def audit_summary(s, d):
    e = table(s, d, "events").where("value between 0 and 10000").select(F.col("event_id").alias("id"), F.col("event_type").alias("category"), F.col("value").alias("latency_ms"))
    return R.audit_summary(e)


@query("valid_events", """SELECT event_type, count(*) FILTER (value BETWEEN 0 AND 10000) AS valid, count(*) AS total FROM events GROUP BY 1""")
def valid_events(s, d):
    e = table(s, d, "events").select("event_type", F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("category"), F.col("value").alias("latency_ms"))).alias("j"))
    return e.groupBy("event_type").agg(F.count_if(R.valid_event(F.col("j"))).alias("valid"), F.count(F.lit(1)).alias("total"))


@query("yield_report", """WITH r AS (SELECT CASE WHEN coalesce(len(messages), 0) < 3 OR len(messages) > 60 THEN 'length' WHEN coalesce(messages[1].role <> 'system', true) THEN 'opening' END AS st FROM synthetic_conversations) SELECT coalesce(st, 'kept') AS stage, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM r), 2) AS percent FROM r GROUP BY 1""")
def yield_report(s, d):
    reason = Q.trajectory_reason(F.col("messages"))
    stage = F.when(reason == "length", "length").when(reason == "first not system", "opening")
    return R.yield_report(table(s, d, "synthetic_conversations").select(stage.alias("failed_stage")))


@query("dashboard_counts", "WITH p AS (SELECT unnest(problem_pack.problems) AS p FROM fullbench_latest) SELECT count(*) AS total, count(p.passed) AS captured, count(*) FILTER (p.passed) AS passed FROM p")
def dashboard_counts(s, d):
    return R.dashboard_counts(table(s, d, "fullbench_latest").select(F.explode("problem_pack.problems").alias("p")).select("p.passed"))


@query("session_meta", "SELECT sample_id, coalesce(len(messages), 0)::BIGINT AS n_messages, CASE WHEN t = '' THEN '(untitled)' WHEN length(t) > 64 THEN t[1:63] || '…' ELSE t END AS title FROM (SELECT sample_id, messages, trim(regexp_replace(coalesce(trim(list_filter(messages, lambda m: m.role = 'user')[1].content, ' '), ''), '\\s+', ' ', 'g'), ' ') AS t FROM sft_dataset)")
def session_meta(s, d):
    return R.session_meta(table(s, d, "sft_dataset"), "sample_id").select("sample_id", F.col("n_messages").cast("bigint").alias("n_messages"), "title")


@query("word_counts", "SELECT id, len(list_filter(string_split(trim(regexp_replace(lower(prompt), '\\s+', ' ', 'g')), ' '), lambda w: w <> ''))::BIGINT AS n_words FROM tasks")
def word_counts(s, d):
    return R.SERVICES.call("word_count", table(s, d, "tasks").select("id", F.col("prompt").alias("text"))).select("id", F.col("n_words").cast("bigint").alias("n_words"))


@query("latest_per_project", "SELECT project_id, arg_max(session_id, (ingested_at, session_id)) AS session_id FROM proxy_records WHERE project_id IS NOT NULL GROUP BY 1")
def latest_per_project(s, d):
    r = table(s, d, "proxy_records").where("project_id is not null").select(F.col("project_id").alias("directory"), F.col("session_id").alias("id"), F.col("ingested_at").alias("time_updated"))
    return U.latest_session(r).select(F.col("directory").alias("project_id"), F.col("id").alias("session_id"))


def _orders_as_sessions(s, d):
    o = table(s, d, "orders")
    none = F.lit(None).cast("bigint")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"), F.lit(None).cast("string").alias("parent_id"), F.col("o_orderstatus").alias("directory"), F.lit("m").alias("model"), F.col("o_totalprice").alias("cost"), F.col("o_custkey").alias("tokens_input"), none.alias("tokens_output"), none.alias("tokens_reasoning"), F.col("o_orderkey").alias("tokens_cache_read"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("time_created"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("time_updated"))


@query("session_page", "SELECT o_orderkey AS id, o_totalprice AS cost FROM orders WHERE contains(lower(o_orderpriority), 'urgent') ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 50")
def session_page(s, d):
    return U.session_page(_orders_as_sessions(s, d), search=" URGENT ", sort="cost", limit=25, offset=50).select("id", "cost")


@query("harness_prompts", """WITH p AS (SELECT record_id, list_filter(request.messages, lambda m: lower(trim(m.role)) = 'system')[1].content AS t FROM proxy_records), r AS (SELECT *, CASE WHEN contains(lower(t), 'title') THEN 'title' WHEN contains(lower(t), 'compact') OR contains(lower(t), 'summar') THEN 'compaction' WHEN contains(lower(t), 'explore') THEN 'explore' WHEN contains(lower(t), 'plan') THEN 'plan' ELSE 'build' END AS role FROM p WHERE t IS NOT NULL) SELECT role, md5(arg_max(t, (length(t), -record_id))) AS digest, count(*) AS n FROM r GROUP BY 1""")
def harness_prompts(s, d):
    return harness_profile(table(s, d, "proxy_records"))[0].select("role", F.md5("prompt").alias("digest"), "n")


@query("prompt_roles", """WITH p AS (SELECT lower(coalesce(list_filter(messages, lambda m: m.role = 'system')[1].content, '')) AS l FROM sft_dataset) SELECT CASE WHEN contains(l, 'title') THEN 'title' WHEN contains(l, 'compact') OR contains(l, 'summar') THEN 'compaction' WHEN contains(l, 'explore') THEN 'explore' WHEN contains(l, 'plan') THEN 'plan' ELSE 'build' END AS role, count(*) AS n FROM p GROUP BY 1""")
def prompt_roles(s, d):
    return table(s, d, "sft_dataset").groupBy(X.prompt_role(M.nth_text(F.col("messages"), "system", 1)).alias("role")).agg(F.count(F.lit(1)).alias("n"))


@query("working_folders", "SELECT folder, count(*) AS n FROM (SELECT nullif(regexp_extract(list_filter(messages, lambda m: m.role = 'system')[1].content, '(?i)(?:working directory|workspace|checkout):\\s*(\\S+)', 1), '') AS folder FROM sft_dataset) GROUP BY 1")
def working_folders(s, d):
    return table(s, d, "sft_dataset").select(M.chat_settings(F.col("messages")).alias("c")).groupBy(F.col("c.working_dir").alias("folder")).agg(F.count(F.lit(1)).alias("n"))


@query("templated_prompts", """WITH p AS (SELECT list_filter(messages, lambda m: m.role = 'system')[1].content AS t FROM sft_dataset) SELECT md5(regexp_replace(regexp_replace(regexp_replace(t, '\\d{4}-\\d{2}-\\d{2}', '<date>', 'g'), '(?:/[\\w.-]+){2,}', '<path>', 'g'), '\\b\\d+\\b', '<n>', 'g')) AS template, count(*) AS n FROM p GROUP BY 1""")
def templated_prompts(s, d):
    return table(s, d, "sft_dataset").groupBy(F.md5(X.templatise(M.nth_text(F.col("messages"), "system", 1))).alias("template")).agg(F.count(F.lit(1)).alias("n"))


@query("used_tool_names", """WITH x AS (SELECT sample_id, list_transform(json_extract(tools, '$[*].name'), lambda v: v->>'$') AS names, list_transform(flatten(list_transform(messages, lambda m: coalesce(m.tool_calls, []))), lambda c: c."function".name) AS used FROM sft_dataset WHERE tools IS NOT NULL AND messages IS NOT NULL),
y AS (SELECT sample_id, names, list_intersect(names, used) AS hit FROM x) SELECT sample_id, coalesce(array_to_string(list_sort(CASE WHEN len(hit) > 0 THEN hit ELSE names END), ','), '') AS names FROM y""")
def used_tool_names(s, d):
    t = table(s, d, "sft_dataset").where("tools is not null and messages is not null")
    return t.select("sample_id", F.array_join(F.array_sort(M.used_tools(F.col("tools"), F.col("messages"))), ",").alias("names"))


@query("approx_token_sizes", f"SELECT sample_id, ({_COMPACT}) // 4 AS n FROM sft_dataset")
def approx_token_sizes(s, d):
    return table(s, d, "sft_dataset").select("sample_id", Q.approx_tokens(F.col("messages")).alias("n"))


@query("model_labels", "SELECT regexp_replace(regexp_replace(model, '^openrouter/', ''), '^local/', '') AS model, count(*) AS n FROM sft_dataset GROUP BY 1")
def model_labels(s, d):
    return table(s, d, "sft_dataset").groupBy(X.normalise_model(F.col("model")).alias("model")).agg(F.count(F.lit(1)).alias("n"))
