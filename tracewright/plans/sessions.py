"""Queries on sessions: messages, turns, traces and quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.functions import text as X
from tracewright.operators import messages as M
from tracewright.operators import quality as Q
from tracewright.operators import trace as T
from tracewright.plans.contract import query
from tracewright.session import table

_CALLS = "flatten(list_transform(messages, lambda m: coalesce(m.tool_calls, [])))"
_NAMES = f"list_transform({_CALLS}, lambda c: c.\"function\".name)"
_FIRST = "list_filter(messages, lambda m: m.role = 'user')[1].content"
_SQUEEZE = "trim(regexp_replace(lower({0}), '\\s+', ' ', 'g'))"


def _sft(s, d):
    return table(s, d, "sft_dataset")


@query("session_key", "SELECT sample_id, sha256(coalesce(list_filter(messages, lambda m: m.role = 'system')[1].content, '') || chr(0) || coalesce(" + _FIRST + ", '')) AS session_key FROM sft_dataset")
def session_key(s, d):
    m = F.col("messages")
    return _sft(s, d).select("sample_id", X.prefix_key(M.nth_text(m, "system", 1), M.nth_text(m, "user", 1)).alias("session_key"))


@query("first_user_turn", f"SELECT sample_id, trim({_FIRST}, ' ') AS first_user FROM sft_dataset")
def first_user_turn(s, d):
    return _sft(s, d).select("sample_id", M.first_user(F.col("messages")).alias("first_user"))


@query("last_user_turn", "SELECT sample_id, list_filter(messages, lambda m: m.role = 'user')[-1].content AS last_user FROM sft_dataset")
def last_user_turn(s, d):
    return _sft(s, d).select("sample_id", M.last_user(F.col("messages")).alias("last_user"))


@query("role_counts", "SELECT m.role AS role, count(*) AS n_messages, count(DISTINCT sample_id) AS n_sessions FROM (SELECT sample_id, unnest(messages) AS m FROM sft_dataset) GROUP BY 1")
def role_counts(s, d):
    return M.exploded(_sft(s, d), "sample_id").groupBy("role").agg(F.count(F.lit(1)).alias("n_messages"), F.count_distinct("sample_id").alias("n_sessions"))


_TURNS = """WITH x AS (SELECT sample_id, unnest(messages) AS m, generate_subscripts(messages, 1) AS pos FROM sft_dataset),
    t AS (SELECT sample_id, pos, m.role AS role, m.content AS content, sum(CASE WHEN m.role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY sample_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS turn_no FROM x),
    p AS (SELECT sample_id, turn_no::BIGINT AS turn_no, arg_max(content, pos) FILTER (role = 'user' AND content IS NOT NULL) AS prompt, arg_max(trim(content, ' '), pos) FILTER (role = 'assistant' AND trim(content, ' ') <> '') AS answer
    FROM t WHERE turn_no > 0 GROUP BY 1, 2 HAVING answer IS NOT NULL)"""


@query("turn_pairs", _TURNS + " SELECT * FROM p")
def turn_pairs(s, d):
    return M.turn_pairs(_sft(s, d), "sample_id")


@query(
    "conversation_profile",
    f"""SELECT sample_id, coalesce(len(messages), 0)::BIGINT AS n_messages, len(list_filter(messages, lambda m: m.role = 'assistant'))::BIGINT AS n_steps, len({_CALLS})::BIGINT AS n_calls,
    len(list_distinct({_NAMES}))::BIGINT AS n_tools, length({_FIRST})::BIGINT AS first_user_chars FROM sft_dataset WHERE messages IS NOT NULL""",
)
def conversation_profile(s, d):
    p = M.profile(_sft(s, d).where("messages is not null"), "sample_id")
    return p.select("sample_id", *[F.col(c).cast("bigint").alias(c) for c in ("n_messages", "n_steps", "n_calls", "n_tools", "first_user_chars")])


@query("render_transcript", "SELECT sample_id, md5(array_to_string(list_transform(messages, lambda m: '### ' || upper(m.role) || chr(10) || coalesce(m.content, '')), chr(10) || chr(10))) AS digest FROM sft_dataset WHERE messages IS NOT NULL")
def render_transcript(s, d):
    return _sft(s, d).where("messages is not null").select("sample_id", F.md5(M.render(F.col("messages"))).alias("digest"))


@query("dedup_signature", f"SELECT sample_id, lower(coalesce({_FIRST}, '') || ' || ' || coalesce(array_to_string({_NAMES}, '>'), '')) AS signature FROM sft_dataset WHERE messages IS NOT NULL")
def dedup_signature(s, d):
    return _sft(s, d).where("messages is not null").select("sample_id", M.dedup_signature(F.col("messages")).alias("signature"))


@query(
    "record_text_size",
    """SELECT sample_id, md5(array_to_string(list_concat(flatten(list_transform(messages, lambda m: list_concat([coalesce(m.content, '')], CASE WHEN coalesce(m.reasoning_content, '') <> '' THEN [m.reasoning_content] ELSE [] END,
    flatten(list_transform(coalesce(m.tool_calls, []), lambda c: [coalesce(c."function".name, ''), coalesce(c."function".arguments, '')]))))), CASE WHEN coalesce(tools, '') <> '' THEN [tools] ELSE [] END), chr(10))) AS digest FROM sft_dataset WHERE messages IS NOT NULL""",
)
def record_text_size(s, d):
    return _sft(s, d).where("messages is not null").select("sample_id", F.md5(M.record_text(F.col("messages"), F.col("tools"))).alias("digest"))


@query("tool_name_counts", f"SELECT name, count(*) AS calls FROM (SELECT unnest({_NAMES}) AS name FROM sft_dataset) GROUP BY 1")
def tool_name_counts(s, d):
    return _sft(s, d).select(F.explode(M.call_names(F.col("messages"))).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("calls"))


@query("correction_flags", "SELECT sample_id, coalesce(regexp_matches(list_filter(messages, lambda m: m.role = 'user')[-1].content, '(?i)(^|[^\\p{L}\\p{N}_])(that''?s (wrong|not right|incorrect)|doesn''?t work|not what i|wtf|you broke|still (wrong|broken|failing))($|[^\\p{L}\\p{N}_])'), false) AS corrected FROM sft_dataset")
def correction_flags(s, d):
    return _sft(s, d).select("sample_id", Q.ends_in_correction(F.col("messages")).alias("corrected"))


@query(
    "malformed_arguments",
    f"""SELECT DISTINCT sample_id FROM (SELECT sample_id, unnest({_CALLS}) AS c FROM sft_dataset) WHERE c."function".arguments IS NULL OR trim(c."function".arguments) = '' OR NOT json_valid(c."function".arguments)""",
)
def malformed_arguments(s, d):
    return Q.malformed_keys(_sft(s, d), "sample_id")


_ISLANDS = f"""WITH c AS (SELECT sample_id, pos, c."function".name AS name, c."function".arguments AS arguments FROM (SELECT sample_id, unnest({_CALLS}) AS c, generate_subscripts({_CALLS}, 1) AS pos FROM sft_dataset)),
f AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR name IS DISTINCT FROM lag(name) OVER w OR arguments IS DISTINCT FROM lag(arguments) OVER w THEN 1 ELSE 0 END AS fresh FROM c WINDOW w AS (PARTITION BY sample_id ORDER BY pos)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY sample_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS island FROM f), i AS (SELECT sample_id, island, name, count(*) AS length FROM g GROUP BY 1, 2, 3)"""


# Characters of the messages as compact JSON without nulls: each field with its name, quotes, colon and comma.
_QUOTED = "length(to_json({0}))"
_COMPACT_CALL = "(2 + coalesce({q_id} + 6, 0) + coalesce({q_type} + 8, 0) + coalesce(12 + coalesce({q_name} + 8, 0) + coalesce({q_args} + 13, 0), 0))".format(q_id=_QUOTED.format("c.id"), q_type=_QUOTED.format('c."type"'), q_name=_QUOTED.format('c."function".name'), q_args=_QUOTED.format('c."function".arguments'))
_COMPACT_MESSAGE = "(1 + coalesce({q[0]} + 8, 0) + coalesce({q[1]} + 11, 0) + coalesce({q[2]} + 21, 0) + coalesce({q[3]} + 16, 0) + coalesce({q[4]} + 8, 0) + coalesce(15 + list_sum(list_transform(m.tool_calls, lambda c: " + _COMPACT_CALL + " + 1)), CASE WHEN m.tool_calls IS NULL THEN 0 ELSE 16 END))"
_COMPACT = "coalesce(list_sum(list_transform(messages, lambda m: " + _COMPACT_MESSAGE.format(q=[_QUOTED.format(f"m.{f}") for f in ("role", "content", "reasoning_content", "tool_call_id", "name")]) + " + 1)) + 1, 2)"


def _call_rows(s, d):
    return _sft(s, d).select("sample_id", F.posexplode(M.calls(F.col("messages"))).alias("pos", "c")).select("sample_id", "pos", F.col("c.function.name").alias("name"), F.col("c.function.arguments").alias("arguments"))


@query("tool_loop_islands", _ISLANDS + " SELECT sample_id, island::BIGINT AS island, name, length FROM i")
def tool_loop_islands(s, d):
    return Q.loop_islands(_call_rows(s, d), "sample_id", ["pos"], ["name", "arguments"]).select("sample_id", "island", "name", "length")


@query("tool_loop_counts", _ISLANDS + " SELECT sample_id, count(*) FILTER (length >= 3 AND name IS NOT NULL) AS loops FROM i GROUP BY 1")
def tool_loop_counts(s, d):
    return Q.loop_counts(_call_rows(s, d), "sample_id", ["pos"], "name", ["name", "arguments"])


@query(
    "drop_reason_cascade",
    _ISLANDS + f""", loops AS (SELECT DISTINCT sample_id FROM i WHERE length >= 3), bad AS (SELECT DISTINCT sample_id FROM c WHERE arguments IS NULL OR trim(arguments) = '' OR NOT json_valid(arguments)),
    r AS (SELECT s.sample_id, CASE WHEN regexp_matches(list_filter(messages, lambda m: m.role = 'user')[-1].content, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(that''?s (wrong|not right|incorrect)|doesn''?t work|not what i|wtf|you broke|still (wrong|broken|failing))($|[^\\p{{L}}\\p{{N}}_])') THEN 'correction'
    WHEN bad.sample_id IS NOT NULL THEN 'malformed' WHEN loops.sample_id IS NOT NULL THEN 'loop' WHEN {_COMPACT} // 4 > 64000 THEN 'long' END AS drop_reason FROM sft_dataset s LEFT JOIN bad USING (sample_id) LEFT JOIN loops USING (sample_id))
    SELECT coalesce(drop_reason, 'kept') AS drop_reason, count(*) AS n FROM r GROUP BY 1""",
)
def drop_reason_cascade(s, d):
    r = Q.drop_reasons(_sft(s, d), "sample_id")
    return r.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count(F.lit(1)).alias("n"))


@query("min_answer_filter", _TURNS + " SELECT sample_id, turn_no FROM p WHERE length(answer) >= 200")
def min_answer_filter(s, d):
    return M.turn_pairs(_sft(s, d), "sample_id", 200).select("sample_id", "turn_no")


@query("model_allow_list", "SELECT sample_id, model FROM sft_dataset WHERE contains(lower(coalesce(trim(model), '')), 'heron') OR contains(lower(coalesce(trim(model), '')), 'plover')")
def model_allow_list(s, d):
    return _sft(s, d).where(Q.model_allowed(F.col("model"), F.col("source"), ["heron", "plover"])).select("sample_id", "model")


@query(
    "judge_keep",
    """SELECT conv_id, coalesce(least(judge_scores.coherence, judge_scores.tool_use, judge_scores.faithfulness) >= 2 AND judge_scores.coherence IS NOT NULL AND judge_scores.tool_use IS NOT NULL AND judge_scores.faithfulness IS NOT NULL
    AND (judge_scores.recovery IS NULL OR judge_scores.recovery > 2) AND (judge_scores.coherence + judge_scores.tool_use + judge_scores.faithfulness) / 3 >= 3.5, false) AS keep FROM synthetic_conversations""",
)
def judge_keep(s, d):
    return table(s, d, "synthetic_conversations").select("conv_id", Q.judge_keep(F.col("judge_scores")).alias("keep"))


@query(
    "trajectory_shape",
    """SELECT conv_id, CASE WHEN coalesce(len(messages), 0) < 3 OR len(messages) > 60 THEN 'length' WHEN coalesce(messages[1].role <> 'system', true) THEN 'first not system' WHEN coalesce(messages[2].role <> 'user', true) THEN 'second not user'
    WHEN coalesce(messages[-1].role <> 'assistant' OR len(messages[-1].tool_calls) > 0, true) THEN 'last not a plain answer' ELSE 'rest' END AS reason FROM synthetic_conversations""",
)
def trajectory_shape(s, d):
    r = Q.trajectory_reason(F.col("messages"))
    early = ["length", "first not system", "second not user", "last not a plain answer"]
    return table(s, d, "synthetic_conversations").select("conv_id", F.when(r.isin(early), r).otherwise("rest").alias("reason"))


@query("call_integrity", None)
def call_integrity(s, d):
    return table(s, d, "synthetic_conversations").where("messages is not null").select("conv_id", Q.integrity_reason(F.col("messages")).alias("reason"))


@query(
    "call_results",
    """WITH x AS (SELECT sample_id, unnest(messages) AS m, generate_subscripts(messages, 1) AS pos FROM sft_dataset),
    r AS (SELECT sample_id, m.tool_call_id AS call_id, arg_max(coalesce(m.content, ''), pos) AS result FROM x WHERE m.role = 'tool' AND coalesce(m.tool_call_id, '') <> '' GROUP BY 1, 2),
    c AS (SELECT sample_id, pos - 1 AS pos, unnest(m.tool_calls) AS c FROM x WHERE m.role = 'assistant')
    SELECT c.sample_id, pos, c.c.id AS call_id, c.c."function".name AS name, md5(result) AS result_digest FROM c LEFT JOIN r ON c.sample_id = r.sample_id AND c.c.id = r.call_id WHERE c.c.id IS NOT NULL""",
)
def call_results(s, d):
    joined = T.call_results(M.events(_sft(s, d), "sample_id"), "sample_id").where("call_id is not null")
    return joined.select("sample_id", F.col("pos").cast("bigint").alias("pos"), "call_id", "name", F.md5("result").alias("result_digest"))


# The shell patterns once more, for the other engine: word borders are spelt out where a word may begin after '-' or '.'.
_SHELL_EDITS = "(^|[^a-z0-9_])(mkdir|rmdir|rm\\s|mv\\s|cp\\s|touch\\s|tee\\s|chmod|chown|ln\\s|git\\s+(commit|push|add|checkout|reset|merge|rebase)|pip3?\\s+install|npm\\s+(install|i)([^a-z0-9_]|$)|yarn\\s+add|apt(-get)?\\s+install|json\\.dump)|[A-Za-z0-9_](>{1,2}\\s*[^&|]|\\.write\\(|open\\([^)]*[''\"]w)"


@query(
    "tool_classes",
    f"""WITH c AS (SELECT c."function".name AS name, c."function".arguments AS a FROM (SELECT unnest({_CALLS}) AS c FROM sft_dataset)),
    x AS (SELECT name, lower(coalesce(name, '')) AS n, CASE WHEN json_valid(a) THEN coalesce(nullif(json_extract_string(a, '$.command'), ''), nullif(json_extract_string(a, '$.cmd'), ''), nullif(json_extract_string(a, '$.script'), ''), '') ELSE '' END AS command FROM c)
    SELECT name, CASE WHEN n IN ('task', 'agent', 'dispatch_agent', 'subagent', 'spawn', 'delegate') OR regexp_matches(n, '(^|_)agent($|_)') THEN 'subagent' WHEN regexp_matches(n, '^(todo|update_plan|plan)') THEN 'planning'
    WHEN regexp_matches(n, '^(write|edit|str_replace|create_file|createfile|multiedit|apply_patch|patch|delete|remove|mkdir|move|rename)') THEN 'mutating'
    WHEN n IN ('bash', 'shell', 'terminal', 'exec', 'run', 'cmd') THEN CASE WHEN regexp_matches(command, '{_SHELL_EDITS}') THEN 'mutating' ELSE 'readonly' END
    WHEN regexp_matches(n, '^(read|view|cat|glob|grep|ls|list|search|codebase_search|web_search|websearch|webfetch|web_fetch|fetch|conversation_search|recent_chats|get|find)') THEN 'readonly' ELSE 'other' END AS cat, count(*) AS calls FROM x GROUP BY 1, 2""",
)
def tool_classes(s, d):
    return _call_rows(s, d).groupBy("name", T.tool_class(F.col("name"), F.col("arguments")).alias("cat")).agg(F.count(F.lit(1)).alias("calls"))


@query(
    "dead_end_results",
    """SELECT sample_id, count(*) AS dead FROM (SELECT sample_id, unnest(messages) AS m FROM sft_dataset) WHERE m.role = 'tool' AND (contains(lower(m.content), 'command not found') OR contains(lower(m.content), 'no such file or directory')
    OR contains(lower(m.content), 'traceback (most recent') OR contains(lower(m.content), 'is not recognized as') OR contains(lower(m.content), 'permission denied') OR contains(lower(m.content), 'fatal:') OR contains(lower(m.content), 'syntaxerror')) GROUP BY 1""",
)
def dead_end_results(s, d):
    tools = M.exploded(_sft(s, d), "sample_id").where("role = 'tool'").where(X.dead_end_sql(F.col("content")))
    return tools.groupBy("sample_id").agg(F.count(F.lit(1)).alias("dead"))


@query("trace_metrics", None)
def trace_metrics(s, d):
    return T.metrics(_sft(s, d), "sample_id")


@query(
    "intent_flags",
    """WITH p AS (SELECT id, ltrim(prompt) AS p FROM tasks) SELECT id, regexp_matches(p, '(?i)^(please |could you |can you )?(make|create|add|implement|refactor|write|build|remove|delete|rename|migrate|run|fix|update|convert|replace)\\b') AS plain_mutation FROM p""",
)
def intent_flags(s, d):
    plain = F.ltrim("prompt").rlike(r"(?i)^(please |could you |can you )?(make|create|add|implement|refactor|write|build|remove|delete|rename|migrate|run|fix|update|convert|replace)\b")
    return table(s, d, "tasks").select("id", plain.alias("plain_mutation"))


_LEAD, _MUTATE, _QUESTION = (p.replace("'", "''") for p in (X.LEAD, X.MUTATE, X.QUESTION))


@query(
    "task_intents",
    f"""SELECT id, regexp_matches(ltrim(prompt), '(?i)^{_LEAD}{_MUTATE}') AS mutation, regexp_matches(ltrim(prompt), '(?i)^{_LEAD}{_QUESTION}') AND NOT regexp_matches(ltrim(prompt), '(?i)^{_LEAD}{_MUTATE}') AS question,
    len(list_filter(regexp_split_to_array(prompt, '[.!?\\n]+'), lambda x: regexp_matches(ltrim(x), '(?i)^{_LEAD}{_MUTATE}'))) > 0 AS mutation_inside FROM tasks""",
)
def task_intents(s, d):
    return table(s, d, "tasks").select("id", X.is_mutation(F.col("prompt")).alias("mutation"), X.is_question(F.col("prompt")).alias("question"), X.has_mutation_sentence(F.col("prompt")).alias("mutation_inside"))
