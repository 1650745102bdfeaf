"""Messages, turns and events of sessions (P-1, P-2, P-5, P-7, P-8, P-16..18, P-20, P-21, W-4, W-12, W-18, W-19).

A session is a row with ``messages`` (array of role, content, reasoning_content, tool_calls,
tool_call_id, name).  Per-session work uses array functions; only exploded forms are shuffled, and only
when a caller groups them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions import text as X

PART = "array<struct<type:string,text:string,thinking:string,content:string>>"


def role(m: Column) -> Column:
    return F.lower(F.trim(m["role"]))


def content_text(content: Column, mode: str = "sft") -> Column:
    """Text of a content that is plain text or a JSON list of parts.

    sft: text parts and strings, joined by line ends; trace: thinking, objects' texts and, failing
    those, the part's JSON too; harvest: like sft but joined without anything.  Null gives ''."""
    is_list = F.coalesce(F.ltrim(content).startswith("[") & (F.json_array_length(content) >= 0), F.lit(False))
    raw = F.from_json(F.when(is_list, content), "array<string>")

    def part(p: Column) -> Column:
        kind = F.get_json_object(p, "$.type")
        said = F.get_json_object(p, "$.text")
        plain = F.when(~p.startswith("{"), p)
        if mode == "trace":
            return F.coalesce(plain, said, F.get_json_object(p, "$.thinking"), p)
        return F.coalesce(plain, F.when(kind == "text", F.coalesce(said, F.lit(""))))

    parts = F.filter(F.transform(raw, part), lambda t: t.isNotNull())
    return F.when(is_list, F.array_join(parts, "" if mode == "harvest" else "\n")).otherwise(F.coalesce(content, F.lit("")))


def normalised(messages: Column) -> Column:
    """Messages with plain roles and blank optional fields as null (P-1)."""
    blank = lambda c: F.nullif(c, F.lit(""))
    return F.transform(
        messages,
        lambda m: F.struct(
            role(m).alias("role"), F.coalesce(m["content"], F.lit("")).alias("content"), blank(m["reasoning_content"]).alias("reasoning_content"),
            F.when(F.size(m["tool_calls"]) > 0, m["tool_calls"]).alias("tool_calls"), blank(m["tool_call_id"]).alias("tool_call_id"), blank(m["name"]).alias("name"),
        ),
    )


def of_role(messages: Column, *roles: str) -> Column:
    return F.filter(messages, lambda m: role(m).isin(*roles))


def nth_text(messages: Column, which: str, at: int) -> Column:
    """Content of the first (1) or last (-1) message of a role; null if there is none (W-18)."""
    return F.try_element_at(of_role(messages, which), F.lit(at))["content"]


def first_user(messages: Column) -> Column:
    return F.trim(nth_text(messages, "user", 1))


def last_user(messages: Column) -> Column:
    return nth_text(messages, "user", -1)


def calls(messages: Column) -> Column:
    """The tool calls of a session in order."""
    return F.flatten(F.transform(messages, lambda m: F.coalesce(m["tool_calls"], F.array().cast("array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>"))))


def call_names(messages: Column) -> Column:
    return F.transform(calls(messages), lambda c: c["function"]["name"])


def record_text(messages: Column, tools: Column | None = None) -> Column:
    """Contents, reasoning, call names and arguments, then the tools, one on a line (P-2)."""
    none = F.lit(None).cast("string")
    parts = F.flatten(
        F.transform(
            F.coalesce(messages, F.array().cast("array<struct<role:string,content:string,reasoning_content:string,tool_calls:array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>,tool_call_id:string,name:string>>")),
            lambda m: F.concat(
                F.array(F.coalesce(m["content"], F.lit("")), F.nullif(m["reasoning_content"], F.lit(""))),
                F.flatten(F.transform(F.coalesce(m["tool_calls"], F.array().cast("array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>")), lambda c: F.array(F.coalesce(c["function"]["name"], F.lit("")), F.coalesce(c["function"]["arguments"], F.lit(""))))),
            ),
        )
    )
    return F.array_join(F.concat(parts, F.array(F.nullif(tools, F.lit("")) if tools is not None else none)), "\n")


def render(messages: Column) -> Column:
    """A readable transcript: a banner and the text of each message, blank lines between (P-16)."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit("### "), F.upper(role(m)), F.lit("\n"), F.coalesce(m["content"], F.lit("")))), "\n\n")


def dedup_signature(messages: Column) -> Column:
    """Lower-cased first user text and call names (P-17)."""
    return F.lower(F.concat(F.coalesce(nth_text(messages, "user", 1), F.lit("")), F.lit(" || "), F.array_join(call_names(messages), ">")))


def profile(sessions: DataFrame, key: str) -> DataFrame:
    """Message, step and tool figures of each session (P-18)."""
    m = F.col("messages")
    return sessions.select(
        key,
        F.coalesce(F.size(m), F.lit(0)).alias("n_messages"),
        F.size(of_role(m, "assistant")).alias("n_steps"),
        F.size(calls(m)).alias("n_calls"),
        F.size(F.array_distinct(call_names(m))).alias("n_tools"),
        F.exists(m, lambda x: F.length(x["reasoning_content"]) > 0).alias("has_reasoning"),
        F.length(nth_text(m, "user", 1)).alias("first_user_chars"),
    )


def exploded(sessions: DataFrame, key: str) -> DataFrame:
    """One row for each message: key, pos (from 0) and its fields."""
    return sessions.select(key, F.posexplode("messages").alias("pos", "m")).select(key, "pos", role(F.col("m")).alias("role"), "m.content", "m.reasoning_content", "m.tool_calls", "m.tool_call_id", "m.name")


def turn_pairs(sessions: DataFrame, key: str, least: int = 0) -> DataFrame:
    """key, turn_no (from 1), prompt, answer: each user message with the last assistant text before the next.

    Turns without an answer, or with one shorter than ``least`` characters, are left out (W-4, F-7)."""
    rows = exploded(sessions, key).select(key, "pos", "role", "content")
    order = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    turned = rows.withColumn("turn_no", F.sum(F.when(F.col("role") == "user", 1).otherwise(0)).over(order)).where("turn_no > 0")
    text = F.nullif(F.trim("content"), F.lit(""))
    paired = turned.groupBy(key, "turn_no").agg(
        F.max_by(F.when(F.col("role") == "user", F.col("content")), F.when(F.col("role") == "user", F.col("pos"))).alias("prompt"),
        F.max_by(text, F.when((F.col("role") == "assistant") & text.isNotNull(), F.col("pos"))).alias("answer"),
    )
    return paired.where(F.col("answer").isNotNull() & (F.length("answer") >= least))


def tagged_turns(lines: DataFrame) -> DataFrame:
    """(path, turn_no, prompt, answer) of transcript lines (path, line_no, role, text) (S-4, W-4).

    A user line opens a turn if it carries a user_query tag, or is the transcript's first; other user
    lines are ignored.  Blank texts are skipped, turns without an answer left out."""
    lines = lines.where(F.trim("text") != "")
    seen = Window.partitionBy("path").orderBy("line_no")
    first = F.row_number().over(Window.partitionBy("path", "role").orderBy("line_no")) == 1
    tag = X.user_query(F.col("text"))
    opens = (F.col("role") == "user") & (tag.isNotNull() | first)
    marked = lines.withColumn("tag", tag).withColumn("opens", opens)
    turned = marked.withColumn("turn_no", F.sum(F.col("opens").cast("int")).over(seen.rowsBetween(Window.unboundedPreceding, 0))).where("turn_no > 0")
    paired = turned.groupBy("path", "turn_no").agg(
        F.max(F.when(F.col("opens"), F.trim(F.coalesce("tag", "text")))).alias("prompt"),
        F.max_by("text", F.when(F.col("role") == "assistant", F.col("line_no"))).alias("answer"),
    )
    return paired.where("answer is not null")


def events(sessions: DataFrame, key: str) -> DataFrame:
    """key, pos, ev, kind, call_id, name, text, batch: the ordered events of each message (P-8).

    system, user, thinking, text, one tool event for each call of a batch, and toolresult; the thinking
    of an assistant message comes before its text, its calls after."""
    empty = "array<struct<kind:string,call_id:string,name:string,text:string,batch:int>>"
    ev = lambda kind, call=None, name=None, text=None, batch=None: F.struct(F.lit(kind).alias("kind"), (call if call is not None else F.lit(None).cast("string")).alias("call_id"), (name if name is not None else F.lit(None).cast("string")).alias("name"), (text if text is not None else F.lit(None).cast("string")).alias("text"), (batch if batch is not None else F.lit(0)).alias("batch"))
    rows = exploded(sessions, key)
    some = lambda c: F.length(F.trim(c)) > 0
    assistant = F.concat(
        F.when(some(F.col("reasoning_content")), F.array(ev("thinking", text=F.col("reasoning_content")))).otherwise(F.array().cast(empty)),
        F.when(some(F.col("content")), F.array(ev("text", text=F.col("content")))).otherwise(F.array().cast(empty)),
        F.transform(F.coalesce("tool_calls", F.array().cast("array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>")), lambda c: ev("tool", call=c["id"], name=c["function"]["name"], text=c["function"]["arguments"], batch=F.size("tool_calls"))),
    )
    made = (
        F.when(F.col("role").isin("system", "developer"), F.array(ev("system", text=F.coalesce("content", F.lit("")))))
        .when(F.col("role") == "user", F.array(ev("user", text=F.coalesce("content", F.lit("")))))
        .when(F.col("role") == "tool", F.array(ev("toolresult", call=F.nullif("tool_call_id", F.lit("")), text=F.coalesce("content", F.lit("")))))
        .when(F.col("role") == "assistant", assistant)
    )
    return rows.select(key, "pos", F.posexplode(made).alias("ev", "e")).select(key, "pos", "ev", "e.*")


def export_messages(rows: DataFrame, key: str) -> DataFrame:
    """Session exports as training messages (P-5, P-7): rows (key, ord, role, text, reasoning, parts) with
    parts an array of (call_id, tool, input, output, status); each tool part gives a tool message after
    its assistant message, a null output an empty one; empty user texts and empty turns are dropped."""
    message = "struct<role:string,content:string,reasoning_content:string,tool_calls:array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>,tool_call_id:string>"
    own = F.struct(
        F.col("role"), F.coalesce("text", F.lit("")).alias("content"), F.nullif("reasoning", F.lit("")).alias("reasoning_content"),
        F.when(F.size("parts") > 0, F.transform("parts", lambda p: F.struct(p["call_id"].alias("id"), F.lit("function").alias("type"), F.struct(p["tool"].alias("name"), p["input"].alias("arguments")).alias("function")))).alias("tool_calls"),
        F.lit(None).cast("string").alias("tool_call_id"),
    ).cast(message)
    answers = F.transform(F.coalesce("parts", F.array().cast("array<struct<call_id:string,tool:string,input:string,output:string,status:string>>")), lambda p: F.struct(F.lit("tool").alias("role"), F.coalesce(p["output"], F.lit("")).alias("content"), F.lit(None).cast("string").alias("reasoning_content"), F.lit(None).cast("array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>").alias("tool_calls"), p["call_id"].alias("tool_call_id")).cast(message))
    kept = rows.where((F.col("role") != "user") | (F.length(F.trim(F.coalesce("text", F.lit("")))) > 0))
    kept = kept.where((F.col("role") != "assistant") | (F.length(F.coalesce("text", F.lit(""))) > 0) | (F.coalesce(F.size("parts"), F.lit(0)) > 0) | (F.length(F.coalesce("reasoning", F.lit(""))) > 0))
    return kept.groupBy(key).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.concat(F.array(own), answers).alias("ms")))), lambda x: x["ms"])).alias("messages"))


RAW_CALL = r"(?s)<tool_call>\s*(.*?)\s*</tool_call>"
#: Markers that never belong to the text shown.
RAW_MARKERS = ["<assistant>", "</assistant>", "<think>", "</think>", "<|im_start|>", "<|im_end|>", "〈|EOS|〉"]


def parse_generation(text: Column, dialect: str = "keyed") -> Column:
    """Struct (content, reasoning_content, tool_calls(id, name, arguments map)) of a raw generation (P-15).

    keyed: the call's first line is its name, arg_key and arg_value tags follow; functional: function=
    and parameter= tags, blocks without a function are skipped and ids keep the block's number.  Of
    repeated keys the last wins."""
    at = F.instr(text, "</think>")
    reasoning = F.when(at > 0, F.nullif(F.trim(F.replace(F.substring(text, F.lit(1), at - 1), F.lit("<think>"), F.lit(""))), F.lit("")))
    rest = F.when(at > 0, F.substring(text, at + 8, F.length(text))).otherwise(text)
    key, value = (r"(?s)<arg_key>\s*(.*?)\s*</arg_key>\s*<arg_value>\s*(.*?)\s*</arg_value>",) * 2 if dialect == "keyed" else (r"(?s)<parameter=([^>\n]+)>\s*(.*?)\s*</parameter>",) * 2

    def call(body: Column, k: Column) -> Column:
        name = F.trim(F.substring_index(body, "\n", 1)) if dialect == "keyed" else F.trim(F.regexp_extract(body, r"<function=([^>\n]+)>", 1))
        names = F.transform(F.regexp_extract_all(body, F.lit(key), 1), F.trim)
        values = F.transform(F.regexp_extract_all(body, F.lit(value), 2), F.trim)
        last = F.filter(F.sequence(F.lit(1), F.size(names)), lambda i: F.array_position(F.slice(names, i + 1, F.size(names)), F.element_at(names, i)) == 0)
        pairs = F.when(F.size(names) > 0, F.map_from_arrays(F.transform(last, lambda i: F.element_at(names, i)), F.transform(last, lambda i: F.element_at(values, i)))).otherwise(F.create_map().cast("map<string,string>"))
        return F.struct(F.concat(F.lit("call_"), k.cast("string")).alias("id"), name.alias("name"), pairs.alias("arguments"))

    made = F.transform(F.regexp_extract_all(rest, F.lit(RAW_CALL), 1), call)
    if dialect != "keyed":
        made = F.filter(made, lambda c: c["name"] != "")
    content = F.regexp_replace(rest, RAW_CALL, "")
    for marker in RAW_MARKERS:
        content = F.replace(content, F.lit(marker), F.lit(""))
    return F.struct(F.trim(content).alias("content"), reasoning.alias("reasoning_content"), made.alias("tool_calls"))


def chat_settings(messages: Column) -> Column:
    """Struct (working_dir, chat_date) that the first system message states; null where it does not (P-21)."""
    system = nth_text(messages, "system", 1)
    return F.struct(
        F.nullif(F.regexp_extract(system, r"(?i)(?:working directory|workspace|checkout):\s*(\S+)", 1), F.lit("")).alias("working_dir"),
        X.compact_stamp(F.nullif(F.regexp_extract(system, r"(?i)date:\s*([0-9TZ:+_-]+)", 1), F.lit(""))).alias("chat_date"),
    )


def used_tools(tools: Column, messages: Column) -> Column:
    """Names of a tools list (JSON) that the session calls; all of them if it calls none (P-13)."""
    names = F.transform(F.from_json(tools, "array<struct<name:string>>"), lambda t: t["name"])
    used = F.array_intersect(names, call_names(messages))
    return F.when(F.size(used) > 0, used).otherwise(names)


def cache_marks(messages: Column) -> Column:
    """Messages with a flag on the first system and the last message (P-34)."""
    n = F.size(messages)
    systems = F.array_position(F.transform(messages, lambda m: role(m) == "system"), F.lit(True))
    return F.transform(messages, lambda m, i: F.struct(m.alias("message"), ((i == n - 1) | ((systems > 0) & (i == systems - 1))).alias("cache")))
