"""Queries on the call log: usage, cost, time."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.functions import text as X
from tracewright.operators import usage as U
from tracewright.plans.contract import query
from tracewright.session import table

_AT = """CASE WHEN regexp_matches(trim(timestamp), '^\\d{13}$') THEN epoch_us(make_timestamp(trim(timestamp)::BIGINT * 1000)) WHEN regexp_matches(trim(timestamp), '^\\d{8}[^0-9]?\\d{6}([^0-9]|$)')
THEN epoch_us(try_strptime(regexp_replace(regexp_extract(trim(timestamp), '^\\d{8}[^0-9]?\\d{6}'), '[^0-9]', '', 'g'), '%Y%m%d%H%M%S')) WHEN regexp_matches(trim(timestamp), '^\\d{4}-\\d\\d') THEN epoch_us(try_cast(trim(timestamp) AS TIMESTAMPTZ)) END"""
_CALLS = f"""WITH once AS (SELECT *, {_AT} AS us, request IS NOT NULL AS asks, response IS NOT NULL AS replies FROM proxy_records QUALIFY record_id IS NULL OR row_number() OVER (PARTITION BY record_id ORDER BY ingested_at DESC) = 1),
seen AS (SELECT *, us IS NOT NULL AND session_id IS NOT NULL AS placed FROM once),
prev AS (SELECT *, coalesce(lag(placed AND asks AND NOT replies) OVER w, false) AS after_ask, lag(record_id) OVER w AS ask_id,
last_value(CASE WHEN placed AND asks THEN nullif(request.model, '') END IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY us NULLS FIRST, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS asked_model FROM seen WINDOW w AS (PARTITION BY session_id ORDER BY us NULLS FIRST, record_id)),
side AS (SELECT *, CASE WHEN placed AND NOT asks AND after_ask THEN ask_id ELSE record_id END AS call, coalesce(nullif(request.model, ''), CASE WHEN placed AND NOT asks THEN asked_model END, 'unknown') AS of_model, response.usage AS v FROM prev),
u AS (SELECT call AS record_id, arg_min(session_id, NOT asks) AS session_id, arg_min(project_id, NOT asks) AS project_id, arg_min(of_model, NOT asks) AS model, coalesce(arg_min(nullif(upstream, ''), NOT asks), 'local') AS upstream, make_timestamp(min(us)) AS ts, max(response.finish_reason) AS finish,
sum(coalesce(v.prompt_tokens, v.input_tokens, 0)) AS prompt, sum(coalesce(v.completion_tokens, v.output_tokens, 0)) AS completion, sum(coalesce(v.total_tokens, coalesce(v.prompt_tokens, v.input_tokens, 0) + coalesce(v.completion_tokens, v.output_tokens, 0))) AS total,
sum(coalesce(v.prompt_tokens_details.cached_tokens, 0)) AS cached, sum(coalesce(v.completion_tokens_details.reasoning_tokens, 0)) AS reasoning, sum(coalesce(v.cost, 0)) AS cost, bool_or(v IS NOT NULL) AS has_usage FROM side GROUP BY call)"""
_SUMS = "count(*) AS calls, sum(prompt)::BIGINT AS prompt, sum(completion)::BIGINT AS completion, sum(total)::BIGINT AS total, sum(cached)::BIGINT AS cached, sum(reasoning)::BIGINT AS reasoning, round(sum(cost), 6) AS cost"
_RATE = "round(sum(cached) / nullif(sum(prompt), 0), 6) AS cache_rate"


def _calls(s, d):
    return U.calls(table(s, d, "proxy_records"))


@query("usage_totals", f"{_CALLS} SELECT {_SUMS}, count(*) FILTER (has_usage) AS with_usage, {_RATE} FROM u")
def usage_totals(s, d):
    return U.rollup(_calls(s, d))


@query("usage_by_model", f"{_CALLS} SELECT model, {_SUMS}, count(*) FILTER (has_usage) AS with_usage, {_RATE} FROM u GROUP BY model")
def usage_by_model(s, d):
    return U.rollup(_calls(s, d), "model")


@query("usage_by_model_upstream", f"{_CALLS} SELECT model, upstream, {_SUMS}, count(*) FILTER (has_usage) AS with_usage, {_RATE} FROM u GROUP BY model, upstream")
def usage_by_model_upstream(s, d):
    return U.rollup(_calls(s, d), "model", "upstream")


@query("usage_rollup", f"{_CALLS} SELECT CASE WHEN grouping(model) = 1 THEN 'all' ELSE model END AS model, CASE WHEN grouping(upstream) = 1 THEN 'all' ELSE upstream END AS upstream, {_SUMS}, {_RATE} FROM u GROUP BY GROUPING SETS ((), (model), (upstream))")
def usage_rollup(s, d):
    return U.totals_and_breakdown(_calls(s, d), "model", "upstream")


@query("usage_by_project", f"{_CALLS} SELECT project_id, {_SUMS}, count(*) FILTER (has_usage) AS with_usage, {_RATE} FROM u GROUP BY project_id")
def usage_by_project(s, d):
    return U.rollup(_calls(s, d), "project_id")


@query("finish_reasons", f"{_CALLS} SELECT coalesce(finish, 'none') AS finish, count(*) AS n FROM u GROUP BY 1")
def finish_reasons(s, d):
    return _calls(s, d).groupBy(F.coalesce("finish", F.lit("none")).alias("finish")).agg(F.count(F.lit(1)).alias("n"))


@query("daily_events", "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1")
def daily_events(s, d):
    return table(s, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value"))


@query("daily_usage", f"{_CALLS} SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS calls, sum(total)::BIGINT AS total, round(sum(cost), 6) AS cost, epoch_us(min(ts)) AS first_us FROM u WHERE ts IS NOT NULL GROUP BY 1")
def daily_usage(s, d):
    return U.daily(_calls(s, d)).select("day", "calls", "total", "cost", F.unix_micros("first_ts").alias("first_us"))


@query(
    "timeline_48",
    """WITH b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events), p AS (SELECT least(47, floor((epoch_us(ts) - lo) / (hi - lo) * 48))::INT AS bin, epoch_us(ts) AS t, value FROM events, b),
    g AS (SELECT bin, count(*) AS calls, round(sum(value), 6) AS value, min(t) AS t0 FROM p GROUP BY 1) SELECT r.range::INT AS bin, coalesce(calls, 0) AS calls, coalesce(value, 0) AS value, t0 FROM range(48) r LEFT JOIN g ON g.bin = r.range""",
)
def timeline_48(s, d):
    return U.timeline(table(s, d, "events"), "ts", {"value": "value"})


_TOP = "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 12"


@query("top_12", _TOP)
def top_12(s, d):
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(12)


@query("top_calls_by_cost", f"{_CALLS} SELECT record_id, round(cost, 8) AS cost FROM u ORDER BY u.cost DESC NULLS LAST, record_id LIMIT 12")
def top_calls_by_cost(s, d):
    return U.top_by(_calls(s, d).select("record_id", "cost"), "cost", "record_id").select("record_id", F.round("cost", 8).alias("cost"))


@query(
    "session_rollup",
    f"""{_CALLS}, m AS (SELECT session_id, model, count(*) AS n, min(coalesce(epoch_us(ts), -1)) AS t, min(record_id) AS id FROM u GROUP BY 1, 2), b AS (SELECT session_id, model, count(*) OVER (PARTITION BY session_id) AS model_count FROM m QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY n DESC, t, id) = 1)
    SELECT u.session_id, {_SUMS}, {_RATE}, any_value(b.model_count) AS model_count, any_value(b.model) AS model, epoch_us(min(ts)) AS us_min, epoch_us(max(ts)) AS us_max FROM u JOIN b USING (session_id) GROUP BY 1""",
)
def session_rollup(s, d):
    return U.session_rollup(_calls(s, d)).withColumns({"us_min": F.unix_micros("ts_min"), "us_max": F.unix_micros("ts_max")}).drop("ts_min", "ts_max")


@query(
    "gap_sessions",
    """WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) > 1800000000 THEN 1 ELSE 0 END AS gap FROM events),
    n AS (SELECT *, 1 + sum(gap) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM g) SELECT user_id, session_no::BIGINT AS session_no, count(*) AS n_events FROM n GROUP BY 1, 2""",
)
def gap_sessions(s, d):
    return U.gap_sessions(table(s, d, "events"), "user_id", "ts", "event_id").groupBy("user_id", "session_no").agg(F.count(F.lit(1)).alias("n_events"))


@query("dominant_event_type", "WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, event_type, n FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1")
def dominant_event_type(s, d):
    c = table(s, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("user_id").agg(F.min_by(F.struct("event_type", "n"), F.struct(-F.col("n"), F.col("event_type"))).alias("b")).select("user_id", "b.event_type", "b.n")


@query("json_props_group", "SELECT event_type, sum(json_extract_string(props, '$.k')::BIGINT)::BIGINT AS k, count(*) AS n FROM events GROUP BY 1")
def json_props_group(s, d):
    return table(s, d, "events").groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").try_cast("bigint")).alias("k"), F.count(F.lit(1)).alias("n"))


@query("cache_rate", f"{_CALLS} SELECT upstream, {_RATE} FROM u GROUP BY upstream")
def cache_rate(s, d):
    return _calls(s, d).groupBy("upstream").agg(F.round(F.try_divide(F.sum("cached"), F.sum("prompt")), 6).alias("cache_rate"))


@query("root_rollup", "SELECT coalesce(n_regionkey, -1)::INT AS root_id, count(*) AS n_sessions, round(sum(s_acctbal), 2) AS s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1")
def root_rollup(s, d):
    rows = table(s, d, "supplier").join(F.broadcast(table(s, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # nation has a row for each country
    out = U.root_rollup(rows.select(F.col("n_regionkey").alias("parent_id"), F.col("s_suppkey").cast("int").alias("id"), "s_acctbal"), "s_acctbal")
    return out.select("root_id", "n_sessions", F.round("s_acctbal", 2).alias("s_acctbal"))


@query("attached_sessions", None)
def attached_sessions(s, d):
    req = table(s, d, "proxy_records").dropDuplicates(["record_id"]).select("record_id", X.instant(F.col("timestamp")).alias("ts"), F.col("request.messages").alias("messages"))
    return U.attach_sessions(req)


@query("project_profile", "SELECT coalesce(project_id, 'null') AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM proxy_records), 6) AS share FROM proxy_records GROUP BY 1")
def project_profile(s, d):
    return U.value_profile(table(s, d, "proxy_records").select(F.coalesce("project_id", F.lit("null")).alias("project_id")), "project_id")


@query("percentile_profile", "SELECT l_returnflag, count(l_quantity) AS n, min(l_quantity) AS min, round(quantile_cont(l_quantity, 0.25), 6) AS q1, round(quantile_cont(l_quantity, 0.5), 6) AS median, round(quantile_cont(l_quantity, 0.75), 6) AS q3, round(quantile_cont(l_quantity, 0.95), 6) AS p95, max(l_quantity) AS max, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1")
def percentile_profile(s, d):
    return U.number_profile(table(s, d, "lineitem"), "l_quantity", "l_returnflag")


@query("histogram", "SELECT greatest(0, least(19, floor((o_totalprice - 0.0) / 500000 * 20)))::INT AS bin, count(*) AS n FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1")
def histogram(s, d):
    return U.histogram(table(s, d, "orders"), "o_totalprice", 0.0, 500000.0, 20)


@query("session_tool_rollup", None)
def session_tool_rollup(s, d):
    return U.tool_rollup(table(s, d, "sft_dataset"), "sample_id")


@query("average_call_figures", f"{_CALLS} SELECT model, floor(sum(total) / count(*) + 0.5)::BIGINT AS tokens_per_call, round(sum(cost) / count(*), 8) AS cost_per_call, count(DISTINCT session_id) AS n_sessions FROM u GROUP BY 1")
def average_call_figures(s, d):
    return U.average_figures(_calls(s, d), "model")


@query("max_message_request", "SELECT session_id, max(len(request.messages))::BIGINT AS n FROM proxy_records WHERE request.messages IS NOT NULL GROUP BY 1")
def max_message_request(s, d):
    return table(s, d, "proxy_records").where("request.messages is not null").groupBy("session_id").agg(F.max(F.size("request.messages")).cast("bigint").alias("n"))


@query("conversation_rows", "SELECT m.role AS role, count(*) AS n FROM (SELECT unnest(request.messages) AS m FROM proxy_records) GROUP BY 1")
def conversation_rows(s, d):
    return table(s, d, "proxy_records").select(F.explode("request.messages").alias("m")).groupBy(F.col("m.role").alias("role")).agg(F.count(F.lit(1)).alias("n"))
