"""DuckDB SQL of the queries whose definitions SQL can state on whole tables."""

_TEXT = "array_to_string(list_transform(list_filter(messages, lambda m: m.role IN ('user', 'assistant') AND coalesce(m.content, '') <> ''), lambda m: m.content), ' ')"

P3_FOUND = f"""WITH r AS (SELECT sample_id AS id, {_TEXT} AS t FROM sft_dataset UNION ALL SELECT conv_id, {_TEXT} FROM synthetic_conversations),
w AS (SELECT id, list_filter(regexp_split_to_array(lower(t), '\\s+'), lambda x: x <> '') AS w FROM r WHERE t IS NOT NULL),
g AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 1), lambda k: hash(w[k], w[k + 1], w[k + 2]))) AS g FROM w WHERE len(w) >= 3),
n AS (SELECT id, count(*) AS n FROM g GROUP BY 1), b AS (SELECT x.id AS a, y.id AS b, count(*) AS m FROM g x JOIN g y ON x.g = y.g AND x.id < y.id GROUP BY 1, 2)
SELECT a AS rec_a, b AS rec_b FROM b JOIN n p ON p.id = a JOIN n q ON q.id = b WHERE m >= 0.7 * (p.n + q.n - m)"""

_VISIBLE = "coalesce(length(regexp_replace(content, '[\\s\\pZ\\pC\\x{2800}\\x{3164}\\x{115F}\\x{1160}\\x{FFA0}\\x{034F}]', '', 'g')) > 0, false)"
_ROLE = "CASE WHEN lower(trim({0})) IN ('user', 'human', 'customer') THEN 'user' WHEN lower(trim({0})) IN ('assistant', 'model', 'ai', 'bot') THEN 'assistant' WHEN lower(trim({0})) IN ('system', 'developer') THEN 'system' WHEN lower(trim({0})) IN ('tool', 'function', 'tool_result') THEN 'tool' ELSE lower(trim({0})) END"
_AT = """CASE WHEN regexp_matches(trim(timestamp), '^\\d{13}$') THEN trim(timestamp)::BIGINT * 1000 WHEN regexp_matches(trim(timestamp), '^\\d{8}[^0-9]?\\d{6}Z?$') THEN epoch_us(try_strptime(regexp_replace(trim(timestamp), '[^0-9]', '', 'g'), '%Y%m%d%H%M%S'))
WHEN regexp_matches(trim(timestamp), '^\\d{4}-\\d\\d-\\d\\d[Tt ]') THEN epoch_us(try_cast(trim(timestamp) AS TIMESTAMPTZ)) END"""

P5_FOUND = f"""WITH o AS (SELECT *, {_AT} AS moment FROM proxy_records WHERE session_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY ingested_at DESC) = 1),
m AS (SELECT session_id, moment, record_id, pos, {_ROLE.format('m.role')} AS role, m.content AS content, m.tool_calls AS calls, m.tool_call_id AS answers FROM (SELECT session_id, moment, record_id, unnest(ms) AS m, generate_subscripts(ms, 1) AS pos FROM
 (SELECT session_id, moment, record_id, list_concat(coalesce(request.messages, []), CASE WHEN response.message.role IS NOT NULL THEN [response.message] ELSE [] END) AS ms FROM o))),
v AS (SELECT *, {_VISIBLE} AS visible, coalesce(len(calls), 0) > 0 AS calling, (coalesce(moment, -1), record_id, pos) AS place FROM m),
s AS (SELECT session_id, bool_or(moment IS NULL) AS unstamped FROM o GROUP BY 1), e AS (SELECT session_id, bool_or(role = 'user' AND visible) AS asked FROM v GROUP BY 1),
q AS (SELECT session_id, role, lag(role) OVER w AS before, row_number() OVER w AS k FROM v WHERE role <> 'system' WINDOW w AS (PARTITION BY session_id ORDER BY place)),
f AS (SELECT session_id, bool_or((k = 1 AND role <> 'user') OR coalesce(role = 'assistant' AND before = 'assistant', false)) AS bad FROM q GROUP BY 1),
c AS (SELECT session_id, c.id AS id, place FROM (SELECT session_id, place, unnest(calls) AS c FROM v)), fc AS (SELECT session_id, id, min(place) AS first FROM c WHERE id IS NOT NULL GROUP BY 1, 2),
t AS (SELECT session_id, answers AS id, min(place) AS first FROM v WHERE role = 'tool' GROUP BY 1, 2),
l AS (SELECT session_id FROM t LEFT JOIN fc USING (session_id, id) WHERE fc.first IS NULL OR t.first < fc.first UNION SELECT session_id FROM fc LEFT JOIN t USING (session_id, id) WHERE t.first IS NULL UNION SELECT session_id FROM c WHERE id IS NULL),
g AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS turn FROM v),
p AS (SELECT DISTINCT session_id FROM (SELECT session_id, turn, bool_or(role = 'user' AND visible) AS asked, bool_or(role = 'assistant' AND visible AND NOT calling) AS told FROM g WHERE turn > 0 GROUP BY 1, 2) WHERE asked AND NOT told),
r AS (SELECT s.session_id, CASE WHEN NOT coalesce(asked, false) THEN 'empty' WHEN unstamped OR coalesce(bad, true) OR l.session_id IS NOT NULL THEN 'broken' WHEN p.session_id IS NOT NULL THEN 'missing_reply' END AS reason FROM s LEFT JOIN e USING (session_id) LEFT JOIN f USING (session_id) LEFT JOIN l ON l.session_id = s.session_id LEFT JOIN p ON p.session_id = s.session_id)
SELECT DISTINCT session_id, reason FROM r WHERE reason IS NOT NULL"""

_SQUEEZE = "regexp_replace(lower({0}), '[\\s\\pZ\\p{{Cf}}]+', '', 'g')"
P6_FOUND = f"""WITH k AS (SELECT id, regexp_replace(lower(id), '[^\\pL\\pN]+', '', 'g') AS key, {_SQUEEZE.format('prompt')} AS p FROM tasks),
n AS (SELECT sample_id, regexp_extract(lower(_group), '(?:^|[^0-9a-z])([a-z]{{2}})[^0-9a-z]*([0-9a-f]{{12}})(?:[^0-9a-z]|$)', 1) || regexp_extract(lower(_group), '(?:^|[^0-9a-z])([a-z]{{2}})[^0-9a-z]*([0-9a-f]{{12}})(?:[^0-9a-z]|$)', 2) AS key FROM sft_dataset WHERE _group IS NOT NULL),
u AS (SELECT sample_id, {_SQUEEZE.format("list_filter(messages, lambda m: m.role = 'user')[1].content")} AS q FROM sft_dataset WHERE _group IS NULL)
SELECT sample_id, id AS task_id FROM n JOIN k USING (key) UNION SELECT sample_id, id FROM u JOIN k ON contains(q, p) WHERE p <> ''"""

ORACLES = {"p3_found": P3_FOUND, "p5_found": P5_FOUND, "p6_found": P6_FOUND}
