"""Traces: turns, steps, calls with results, tool classes, metrics (J-4, F-26, F-27, P-9, W-12, A-9, W-16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions import text as X
from tracewright.operators import messages as M

# Tool names by class and the shell commands that change files.
READONLY = ["read", "readfile", "read_file", "view", "cat", "glob", "grep", "ls", "list", "search", "codebase_search", "web_search", "websearch", "webfetch", "web_fetch", "fetch", "conversation_search", "recent_chats", "get", "find"]
MUTATING = ["write", "writefile", "write_file", "edit", "str_replace", "create_file", "createfile", "multiedit", "apply_patch", "patch", "delete", "remove", "mkdir", "move", "rename"]
PLANNING = ["todowrite", "todoread", "todo", "update_plan", "plan", "planmode"]
SUBAGENT = ["task", "agent", "dispatch_agent", "subagent", "spawn", "delegate"]
SHELLS = ["bash", "shell", "terminal", "exec", "run", "cmd"]
MUTATING_SHELL = r"\b(mkdir|rmdir|rm\s|mv\s|cp\s|touch\s|tee\s|chmod|chown|ln\s|git\s+(commit|push|add|checkout|reset|merge|rebase)|pip3?\s+install|npm\s+(install|i)\b|yarn\s+add|apt(-get)?\s+install|>{1,2}\s*[^&|]|json\.dump|\.write\(|open\([^)]*['\"]w)"


def _prefixed(name: Column, prefixes: list[str]) -> Column:
    return name.rlike("^(" + "|".join(prefixes) + ")")


def tool_class(name: Column, arguments: Column) -> Column:
    """subagent, planning, mutating, readonly or other; of shells the command decides (F-27)."""
    n = F.lower(F.coalesce(name, F.lit("")))
    command = F.coalesce(*[F.nullif(F.get_json_object(arguments, f"$.{k}"), F.lit("")) for k in ("command", "cmd", "script")], F.lit(""))
    return (
        F.when(n.isin(SUBAGENT) | n.rlike(r"(^|_)agent($|_)"), "subagent")
        .when(_prefixed(n, PLANNING), "planning")
        .when(_prefixed(n, MUTATING), "mutating")
        .when(n.isin(SHELLS), F.when(command.rlike(MUTATING_SHELL), "mutating").otherwise("readonly"))
        .when(_prefixed(n, READONLY), "readonly")
        .otherwise("other")
    )


def call_results(events: DataFrame, key: str) -> DataFrame:
    """Tool events with their result (J-4): by id the last result of the session, id-less calls in order
    with id-less results; a call without one keeps a null result."""
    calls = events.where("kind = 'tool'")
    results = events.where("kind = 'toolresult'")
    place = F.struct("pos", "ev")
    by_id = results.where("call_id is not null").groupBy(key, "call_id").agg(F.max_by("text", place).alias("id_result"))
    nth = F.row_number().over(Window.partitionBy(key).orderBy("pos", "ev"))
    loose = results.where("call_id is null").select(key, nth.alias("__nth"), F.col("text").alias("nth_result"))
    named = calls.where("call_id is not null").join(by_id, [key, "call_id"], "left").withColumn("result", F.col("id_result")).drop("id_result")
    unnamed = calls.where("call_id is null").withColumn("__nth", nth).join(loose, [key, "__nth"], "left").withColumn("result", F.col("nth_result")).drop("nth_result", "__nth")
    return named.unionByName(unnamed)


def steps(sessions: DataFrame, key: str) -> DataFrame:
    """key, turn_no (0 before the first user message), step_no, type, name, cat, dead, parallel, summary, text, result (W-12)."""
    ev = M.events(sessions, key)
    order = Window.partitionBy(key).orderBy("pos", "ev")
    turned = ev.withColumn("turn_no", F.sum(F.when(F.col("kind") == "user", 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    tools = call_results(turned, key)
    tools = turned.where("kind in ('thinking', 'text')").withColumn("result", F.lit(None).cast("string")).unionByName(tools)
    numbered = tools.withColumn("step_no", F.row_number().over(Window.partitionBy(key, "turn_no").orderBy("pos", "ev")) - 1)
    tool = F.col("kind") == "tool"
    return numbered.select(
        key, "turn_no", "step_no", F.col("kind").alias("type"), F.when(tool, F.coalesce("name", F.lit("(unnamed tool)"))).alias("name"),
        F.when(tool, tool_class(F.col("name"), F.col("text"))).alias("cat"), (tool & X.dead_end_trace(F.col("result"))).alias("dead"), (tool & (F.col("batch") > 1)).alias("parallel"),
        F.when(tool, X.summarise_args(F.col("text"))).alias("summary"), "text", "result",
    )


def metrics(sessions: DataFrame, key: str) -> DataFrame:
    """Turns (implicit ones only if there is no other), calls, dead ends, writes, subagents, thinking (A-9)."""
    s = steps(sessions, key)
    cat = lambda c: F.count_if(F.col("cat") == c)
    counted = s.groupBy(key).agg(
        F.count_if(F.col("type") == "tool").alias("tool_calls"), F.count_if("dead").alias("dead_ends"), cat("mutating").alias("writes"),
        cat("subagent").alias("subagents"), F.count_if(F.col("type") == "thinking").alias("thinking"), F.max((F.col("turn_no") == 0).cast("int")).alias("implicit"),
    )
    users = sessions.select(key, F.coalesce(F.size(M.of_role(F.col("messages"), "user")), F.lit(0)).alias("users"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return users.join(counted, key, "left").select(key, F.when(F.col("users") > 0, F.col("users")).otherwise(F.coalesce("implicit", F.lit(0))).cast("bigint").alias("turns"), *[zero(c) for c in ("tool_calls", "dead_ends", "writes", "subagents", "thinking")])


def abort_after_streak(rows: DataFrame, key: str, order: list[str], bad: Column, streak: int = 3) -> DataFrame:
    """Rows up to the one that completes ``streak`` bad ones in a row; the rest of its key is cut off (W-16)."""
    w = Window.partitionBy(key).orderBy(*order)
    runs = rows.withColumn("__bad", F.coalesce(bad, F.lit(False))).withColumn("__good", F.sum((~F.col("__bad")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    n = runs.withColumn("__n", F.when(F.col("__bad"), F.row_number().over(Window.partitionBy(key, "__good", "__bad").orderBy(*order))))
    n = n.withColumn("__row", F.row_number().over(w))
    return n.withColumn("__cut", F.min(F.when(F.col("__n") == streak, F.col("__row"))).over(Window.partitionBy(key))).where("__cut is null or __row <= __cut").drop("__bad", "__good", "__n", "__row", "__cut")
