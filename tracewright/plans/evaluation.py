"""Queries on evaluation results and tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.functions import text as X
from tracewright.operators import evals as E
from tracewright.operators import tasks as K
from tracewright.plans.contract import query
from tracewright.session import table

_PROBLEMS = "WITH p AS (SELECT run_id, model, created, unnest(problem_pack.problems) AS p FROM fullbench_latest), r AS (SELECT run_id, model, created, p.id AS id, p.kind AS kind, p.difficulty AS difficulty, p.passed AS passed, p.tokens AS tokens, p.steps AS steps, p.tool_calls AS tool_calls, p.tool_errors AS tool_errors, p.seconds AS seconds, p.stderr AS stderr FROM p)"


def _problems(s, d):
    return table(s, d, "fullbench_latest").select("run_id", "model", "created", F.explode("problem_pack.problems").alias("p")).select("run_id", "model", "created", "p.*")


_EVAL = "total, passed, gradable, errors, pass_rate, avg_score"
_ROWS = _PROBLEMS + ", e AS (SELECT model, kind, 'code' AS type, passed, CASE WHEN tokens > 0 THEN steps * 1.0 / tokens END AS score, CASE WHEN passed THEN '' ELSE stderr END AS error FROM r)"
_AGG = "count(*) AS total, count(*) FILTER (passed) AS passed, count(*) AS gradable, count(*) FILTER (coalesce(error, '') <> '') AS errors, round(avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END), 6) AS pass_rate, round(avg(score), 6) AS avg_score"


def _eval_rows(s, d):
    return _problems(s, d).select("model", "kind", F.lit("code").alias("type"), "passed", F.when(F.col("tokens") > 0, F.col("steps") / F.col("tokens")).alias("score"), F.when(F.col("passed"), "").otherwise(F.col("stderr")).alias("error"), F.lit(True).alias("gradable"))


@query("eval_by_run", _ROWS + f" SELECT model, {_AGG} FROM e GROUP BY 1")
def eval_by_run(s, d):
    return E.aggregate(_eval_rows(s, d), "model")


@query("eval_by_run_type", _ROWS + f" SELECT model, kind, {_AGG} FROM e GROUP BY 1, 2")
def eval_by_run_type(s, d):
    return E.aggregate(_eval_rows(s, d), "model", "kind")


_CELLS = _PROBLEMS + ", c AS (SELECT model, id, arg_max(coalesce(passed, false), (created, run_id)) AS passed FROM r GROUP BY 1, 2)"


def _cells(s, d):
    rows = _problems(s, d).withColumn("score", F.col("seconds")).withColumn("ord", F.struct("created", "run_id"))
    return E.cells(rows, "model", "id", "ord")


@query("eval_flips", _CELLS + """, a AS (SELECT id, passed AS base_passed FROM c WHERE model = 'heron-large'), b AS (SELECT id, passed AS cand_passed FROM c WHERE model = 'tern-code-30b')
SELECT coalesce(a.id, b.id) AS id, base_passed, cand_passed, CASE WHEN base_passed IS NULL OR cand_passed IS NULL THEN 'only_one' WHEN cand_passed AND NOT base_passed THEN 'gain' WHEN NOT cand_passed AND base_passed THEN 'regression' ELSE 'tie' END AS outcome FROM a FULL JOIN b ON a.id = b.id""")
def eval_flips(s, d):
    c = _cells(s, d)
    return E.flips(c.where("model = 'heron-large'"), c.where("model = 'tern-code-30b'"), "id")


@query("find_flips", _CELLS + " SELECT w.id, w.model AS passed_run, l.model AS failed_run FROM c w JOIN c l USING (id) WHERE w.passed AND NOT l.passed")
def find_flips(s, d):
    return E.find_flips(_cells(s, d), "model", "id")


@query(
    "pack_summary",
    _PROBLEMS + """ SELECT model, count(*) FILTER (passed) AS passed, count(*) AS total, round(count(*) FILTER (passed) / count(*), 6) AS rate, round_even(avg(nullif(tokens, 0)), 0) AS mean_tokens, round_even(avg(nullif(steps, 0)), 1) AS mean_steps, sum(nullif(tokens, 0))::BIGINT AS total_tokens,
    round_even(sum(nullif(tokens, 0)) / nullif(count(*) FILTER (passed), 0), 0) AS tokens_per_solve, round_even(sum(tool_errors) / nullif(sum(nullif(tool_calls, 0)), 0), 4) AS tool_error_rate FROM r GROUP BY 1""",
)
def pack_summary(s, d):
    return E.pack_summary(_problems(s, d), "model")


@query("pack_breakdown", _PROBLEMS + " SELECT CASE WHEN grouping(difficulty) = 1 THEN 'all' ELSE difficulty END AS difficulty, CASE WHEN grouping(kind) = 1 THEN 'all' ELSE kind END AS kind, count(*) FILTER (passed) AS passed, count(*) AS total FROM r GROUP BY GROUPING SETS ((difficulty), (kind), ())")
def pack_breakdown(s, d):
    return E.pack_breakdown(_problems(s, d))


@query("skip_aware_rates", _PROBLEMS + " SELECT difficulty, count(*) AS total, count(*) FILTER (st = 'skip') AS skipped, round(coalesce(avg(CASE WHEN st <> 'skip' THEN greatest(0.0, least(1.0, coalesce(sc, 0.0))) END), 0.0), 6) AS mean_score FROM (SELECT difficulty, CASE WHEN steps IS NULL THEN 'skip' ELSE 'ok' END AS st, seconds / 500 AS sc FROM r) GROUP BY 1")
def skip_aware_rates(s, d):
    rows = _problems(s, d).select("difficulty", F.when(F.col("steps").isNull(), "skip").otherwise("ok").alias("status"), (F.col("seconds") / 500).alias("score"))
    return E.skip_aware(rows, "difficulty")


@query("weighted_suite_score", "SELECT l_returnflag, count(*) AS recorded, round(coalesce(sum(l_discount * 10 * l_tax) FILTER (l_tax > 0) / nullif(sum(l_tax) FILTER (l_tax > 0), 0), 0), 6) AS weighted_score FROM lineitem GROUP BY 1")
def weighted_suite_score(s, d):
    return E.weighted_score(table(s, d, "lineitem").withColumn("score", F.col("l_discount") * 10), "score", "l_tax", "l_returnflag")


@query("merge_latest", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def merge_latest(s, d):
    return E.merge_latest(table(s, d, "orders"), "o_custkey", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query("regression_gate", _PROBLEMS + """, g AS (SELECT kind, avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END) FILTER (model LIKE '%heron%') AS was, count(*) FILTER (model LIKE '%heron%') AS n, avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END) FILTER (model LIKE '%tern%') AS rate FROM r GROUP BY 1)
SELECT kind, round(rate, 6) AS rate, round(was, 6) AS baseline FROM g WHERE n > 0 AND rate < was""")
def regression_gate(s, d):
    by = lambda part: _problems(s, d).where(F.col("model").contains(part)).groupBy("kind").agg(F.avg(F.coalesce("passed", F.lit(False)).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n"))
    return E.regressions(by("tern"), by("heron"), "kind", "rate", "n").select("kind", F.round("rate", 6).alias("rate"), F.round("baseline", 6).alias("baseline"))


@query("stderr_verdicts", _PROBLEMS + """ SELECT run_id, id, CASE WHEN regexp_matches(stderr, 'exit_code=\\d+') THEN regexp_extract(stderr, 'exit_code=(\\d+)', 1) = '0' WHEN regexp_matches(stderr, '(?m)^FAILED\\s') THEN false
WHEN regexp_matches(stderr, '\\d+ failed') THEN regexp_extract(stderr, '(\\d+) failed', 1)::BIGINT = 0 WHEN regexp_matches(stderr, '\\d+ passed') THEN true ELSE false END AS ok FROM r WHERE stderr IS NOT NULL""")
def stderr_verdicts(s, d):
    return _problems(s, d).where("stderr is not null").select("run_id", "id", E.passed_by_text(F.col("stderr")).alias("ok"))


_LINES = _PROBLEMS + """, l AS (SELECT run_id::VARCHAR || '/' || id AS key, unnest(ls) AS raw, generate_subscripts(ls, 1) AS k FROM (SELECT run_id, id, regexp_split_to_array(stderr, '\\r?\\n') AS ls FROM r WHERE stderr IS NOT NULL)),
f AS (SELECT key, k, CASE WHEN regexp_matches(trim(raw), '^FAILED\\s+\\S+::(\\w+)\\s+-\\s+(.+)$') THEN regexp_extract(trim(raw), '^FAILED\\s+\\S+::(\\w+)\\s+-\\s+(.+)$', 2) WHEN regexp_matches(trim(raw), '^E\\s+AssertionError:\\s+(.+)$') THEN regexp_extract(trim(raw), '^E\\s+AssertionError:\\s+(.+)$', 1) END AS m FROM l),
c AS (SELECT key, k, CASE WHEN length(x) > 180 THEN x[1:177] || '...' ELSE x END AS message FROM (SELECT key, k, regexp_replace(trim(m), '^AssertionError: ', '') AS x FROM f WHERE m IS NOT NULL)),
u AS (SELECT key, message, min(k) AS k FROM c GROUP BY 1, 2)"""


@query("failure_messages", _LINES + " SELECT key, row_number() OVER (PARTITION BY key ORDER BY k) AS n, message FROM u")
def failure_messages(s, d):
    rows = _problems(s, d).where("stderr is not null").select(F.concat_ws("/", F.col("run_id").cast("string"), "id").alias("key"), "stderr")
    return E.failures(rows, "key", "stderr").select("key", F.col("n").cast("bigint").alias("n"), "message")


@query("verification_summaries", _LINES + """, o AS (SELECT run_id::VARCHAR || '/' || id AS key, passed, CASE WHEN contains(stderr, 'ModuleNotFoundError') THEN 'An import or module path error blocked the test suite from running.' WHEN contains(stderr, 'SyntaxError') THEN 'A syntax error prevented tests from executing.'
WHEN contains(stderr, 'collecting ... ERROR') OR contains(lower(stderr), 'errors during collection') THEN 'Pytest failed while collecting tests.' ELSE 'Verification failed; inspect pytest output for details.' END AS said FROM r WHERE stderr IS NOT NULL), q AS (SELECT key, row_number() OVER (PARTITION BY key ORDER BY k) AS n, message FROM u), g AS (SELECT key, count(*)::INT AS c, arg_min(message, n) AS first FROM q GROUP BY 1)
SELECT key, passed, CASE WHEN passed THEN 0 ELSE coalesce(c, 0) END::INT AS failure_count, CASE WHEN passed THEN NULL WHEN c = 1 THEN first WHEN c > 1 THEN first || ' (+' || (c - 1) || CASE WHEN c > 2 THEN ' more failing checks)' ELSE ' more failing check)' END ELSE said END AS headline FROM o LEFT JOIN g USING (key)""")
def verification_summaries(s, d):
    rows = _problems(s, d).where("stderr is not null").select(F.concat_ws("/", F.col("run_id").cast("string"), "id").alias("key"), "stderr", "passed")
    return E.summarise_verification(rows, "key", "stderr")


@query("status_rates", _PROBLEMS + ", t AS (SELECT kind, CASE WHEN steps IS NULL THEN 'skip' WHEN passed THEN 'pass' ELSE 'fail' END AS st FROM r) SELECT kind, count(*) FILTER (st = 'pass') AS n_pass, count(*) FILTER (st = 'fail') AS n_fail, count(*) FILTER (st = 'error') AS n_error, count(*) FILTER (st = 'skip') AS n_skip, count(*) AS total, round(count(*) FILTER (st = 'pass') / nullif(count(*) FILTER (st <> 'skip'), 0), 6) AS rate FROM t GROUP BY 1")
def status_rates(s, d):
    rows = _problems(s, d).select("kind", F.when(F.col("steps").isNull(), "skip").when(F.col("passed"), "pass").otherwise("fail").alias("status"))
    return E.status_rates(rows, "kind")


@query("knowledge_scores", None)
def knowledge_scores(s, d):
    t = table(s, d, "tasks").where("type = 'knowledge' and reference is not null")
    return t.select("id", F.size(X.entities(F.col("reference"))).alias("n_entities"), F.round(E.grade_knowledge(F.col("reference"), F.col("prompt")), 6).alias("score"))


@query("file_overlap", "SELECT a.id, CASE WHEN len(coalesce(a.changed_files, [])) = 0 THEN 0.0 ELSE round(len(list_intersect(a.changed_files, e.expected)) / greatest(len(list_distinct(e.expected)), 1), 6) END AS score FROM tasks a JOIN (SELECT repo, list_distinct(flatten(list(changed_files))) AS expected FROM tasks WHERE changed_files IS NOT NULL GROUP BY 1) e USING (repo)")
def file_overlap(s, d):
    t = table(s, d, "tasks")
    e = t.where("changed_files is not null").groupBy("repo").agg(F.array_distinct(F.flatten(F.collect_list("changed_files"))).alias("expected"))
    return t.join(e, "repo").select("id", F.round(E.grade_code(F.col("changed_files"), F.col("expected")), 6).alias("score"))


@query("replay_scores", "SELECT replay.type AS type, count(*) AS n, count(*) FILTER (coalesce(replay.score >= CASE WHEN replay.type = 'code' THEN 0.5 ELSE 0.3 END, false)) AS passes FROM (SELECT DISTINCT record_id, replay FROM proxy_records WHERE replay IS NOT NULL) GROUP BY 1")
def replay_scores(s, d):
    r = table(s, d, "proxy_records").where("replay is not null").select("record_id", "replay").distinct()
    return r.groupBy(F.col("replay.type").alias("type")).agg(F.count(F.lit(1)).alias("n"), F.count_if(E.passes(F.col("replay.type"), F.col("replay.score"))).alias("passes"))


@query("per_group_cap", "SELECT id, repo FROM tasks QUALIFY row_number() OVER (PARTITION BY repo ORDER BY id) <= 2")
def per_group_cap(s, d):
    return K.per_group_cap(table(s, d, "tasks"), "repo", ["id"], 2).select("id", "repo")


@query("round_robin_pick", """WITH h AS (SELECT id, repo, substr(sha256('0:' || id), 1, 16) AS h, substr(sha256('0:' || repo), 1, 16) AS g FROM tasks), n AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY h, id) AS n FROM h) SELECT id, repo FROM (SELECT * FROM n ORDER BY n, g, h LIMIT 50)""")
def round_robin_pick(s, d):
    return K.round_robin(table(s, d, "tasks").select("id", "repo"), "id", "repo", 50)


@query("asof_last_signup", """WITH s AS (SELECT user_id, ts AS sts, event_id AS sid FROM events WHERE event_type = 'signup') SELECT e.event_id, arg_max(s.sid, (s.sts, s.sid)) AS signup_id FROM events e LEFT JOIN s ON s.user_id = e.user_id AND s.sts <= e.ts GROUP BY 1""")
def asof_last_signup(s, d):
    e = table(s, d, "events")
    signups = e.where("event_type = 'signup'").select("user_id", F.col("ts").alias("sts"), F.col("event_id").alias("signup_id"), F.col("event_id").alias("tie"))
    return K.asof_join(e.select("user_id", "ts", "event_id"), signups, "user_id", "ts", "sts", "signup_id", "tie", bucket=30 * 86_400_000_000).select("event_id", "signup_id")


@query("interval_join_counts", """WITH s AS (SELECT user_id, event_id AS span_id, epoch_us(ts) // 1000000 AS a, epoch_us(ts) // 1000000 + 3600 AS b FROM events WHERE event_type = 'signup'), p AS (SELECT user_id, event_id, epoch_us(ts) // 1000000 AS t FROM events) SELECT span_id, count(*) AS n FROM p JOIN s USING (user_id) WHERE t BETWEEN a AND b GROUP BY 1""")
def interval_join_counts(s, d):
    e = table(s, d, "events").withColumn("t", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000))
    spans = e.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("span_id"), F.col("t").alias("a"), (F.col("t") + 3600).alias("b"))
    return K.interval_join(e.select("user_id", "event_id", "t"), spans, "t", "a", "b", "user_id", 3600).groupBy("span_id").agg(F.count(F.lit(1)).alias("n"))


@query("resume_anti", "SELECT id FROM tasks WHERE id NOT IN (SELECT replay.task_id FROM proxy_records WHERE replay.task_id IS NOT NULL)")
def resume_anti(s, d):
    done = table(s, d, "proxy_records").where("replay.task_id is not null").select(F.col("replay.task_id").alias("id"))
    return K.outstanding(table(s, d, "tasks"), done, "id").select("id")


@query("tasks_by_repo", "SELECT repo, type, count(*) AS n FROM tasks GROUP BY 1, 2")
def tasks_by_repo(s, d):
    return table(s, d, "tasks").groupBy("repo", "type").agg(F.count(F.lit(1)).alias("n"))


@query("first_per_prompt", "SELECT id FROM tasks QUALIFY row_number() OVER (PARTITION BY trim(prompt) ORDER BY id) = 1")
def first_per_prompt(s, d):
    return K.first_per_text(table(s, d, "tasks"), "prompt", "id").select("id")


@query("longest_prompts", "SELECT id, length(prompt)::BIGINT AS n FROM tasks ORDER BY n DESC, id LIMIT 10")
def longest_prompts(s, d):
    return K.longest(table(s, d, "tasks"), F.length("prompt"), "id", 10).select("id", F.length("prompt").cast("bigint").alias("n"))


@query("chat_dates", "SELECT id, epoch_us(try_strptime(replace(replace(replace(regexp_extract(chat_date, '^(\\d{8}[-_ T]?\\d{6})', 1), '-', ''), '_', ''), ' ', ''), '%Y%m%d%H%M%S')) AS at FROM tasks WHERE regexp_matches(chat_date, '^\\d{8}[-_ T]?\\d{6}')")
def chat_dates(s, d):
    t = table(s, d, "tasks").where(F.col("chat_date").rlike(r"^\d{8}[-_ T]?\d{6}"))
    return t.select("id", F.unix_micros(X.compact_stamp(F.col("chat_date"))).alias("at"))


@query("question_turns", None)
def question_turns(s, d):
    from tracewright.operators import messages as M

    return K.cut_at_mutation(M.turn_pairs(table(s, d, "sft_dataset"), "sample_id"), "sample_id").select("sample_id", "turn_no")
