"""Quality gates (F-1..F-5, F-7, F-10, F-21..F-23, F-30, F-32, W-1, W-2, W-15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions import text as X
from tracewright.functions.jsonx import strict_json
from tracewright.operators import messages as M

MAX_TOKENS = 64_000
#: Template tokens that must not leak into contents.
TEMPLATE_TOKENS = ["<|im_start|>", "<|im_end|>", "<assistant>", "</assistant>", "<tool_call>", "</tool_call>"]


def ends_in_correction(messages: Column) -> Column:
    """The last user message corrects the assistant, whatever follows it (F-1)."""
    return X.is_correction(M.last_user(messages))


def has_loop(messages: Column, threshold: int = 3) -> Column:
    """``threshold`` or more equal calls (name and arguments) in a row across the session (F-3)."""
    name = F.transform(M.calls(messages), lambda c: F.struct(F.coalesce(c["function"]["name"], F.lit("")).alias("n"), F.coalesce(c["function"]["arguments"], F.lit("")).alias("a")))
    start = F.struct(F.lit(None).cast("struct<n:string,a:string>").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(s, c):
        run = F.when(s["last"].eqNullSafe(c), s["run"] + 1).otherwise(1)
        return F.struct(c.alias("last"), run.alias("run"), F.greatest(s["most"], run).alias("most"))

    return F.coalesce(F.aggregate(name, start, step, lambda s: s["most"] >= threshold), F.lit(False))


def malformed_keys(sessions: DataFrame, key: str) -> DataFrame:
    """Keys of sessions with a call whose arguments are null or no JSON text ('' fails) (F-2).

    Only distinct argument texts go to the exact Python test, in Arrow batches."""
    args = sessions.select(key, F.explode(M.calls(F.col("messages"))).alias("c")).select(key, F.col("c.function.arguments").alias("arguments"))
    return args.where(~strict_json(F.col("arguments"))).select(key).distinct()


def approx_tokens(messages: Column) -> Column:
    """Characters of the messages' JSON, a fourth of them (F-4); compact JSON without nulls."""
    return F.floor(F.length(F.coalesce(F.to_json(messages), F.lit("[]"))) / 4).cast("bigint")


def drop_reasons(sessions: DataFrame, key: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """The sessions with ``drop_reason``: correction, malformed, loop, long or null, the first that holds (F-5).

    Null messages have no reason.  Cheap tests come first; the malformed keys join back by key."""
    bad = malformed_keys(sessions, key).withColumn("__bad", F.lit(True))
    m = F.col("messages")
    reason = F.when(ends_in_correction(m), "correction").when(F.col("__bad"), "malformed").when(has_loop(m), "loop").when(approx_tokens(m) > max_tokens, "long")
    return sessions.join(bad, key, "left").withColumn("drop_reason", reason).drop("__bad")


def extra_reasons(messages: Column) -> Column:
    """Opt-in gates: incomplete (the last message is not the assistant's), vacuous (it says less than 20
    characters), no_tools; null if none holds."""
    last = F.try_element_at(messages, F.lit(-1))
    return F.when(F.coalesce(M.role(last) != "assistant", F.lit(True)), "incomplete").when(F.coalesce(F.length(F.trim(last["content"])), F.lit(0)) < 20, "vacuous").when(F.size(M.calls(messages)) == 0, "no_tools")


def loop_islands(calls: DataFrame, key: str, order: list[str], same: list[str]) -> DataFrame:
    """Runs of equal neighbours in each key: key, island, length, and the equal columns (W-1, W-2)."""
    w = Window.partitionBy(key).orderBy(*order)
    changed = F.lit(False)
    for c in same:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    begun = calls.withColumn("__new", F.when(F.row_number().over(w) == 1, 1).otherwise(changed.cast("int")))
    island = begun.withColumn("island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(key, "island", *same).agg(F.count(F.lit(1)).alias("length"))


def loop_counts(calls: DataFrame, key: str, order: list[str], tool: str, same: list[str], threshold: int = 3) -> DataFrame:
    """Loops of each key: islands that reach the threshold; null tools never make one (W-2)."""
    return loop_islands(calls, key, order, same).groupBy(key).agg(F.count_if((F.col("length") >= threshold) & F.col(tool).isNotNull()).alias("loops"))


def model_allowed(model: Column, source: Column, wanted: list[str], by_source: dict[str, str] | None = None) -> Column:
    """Any wanted name is part of the model, or of what its source stands for when it is empty (F-10); 'all' or none allows all."""
    wanted = [w.strip().lower() for w in wanted if w.strip()]
    if not wanted or "all" in wanted:
        return F.lit(True)
    name = F.lower(F.nullif(F.trim(model), F.lit("")))
    stands = F.lit(None).cast("string")
    for s, m in (by_source or {}).items():
        stands = F.when(F.lower(F.trim(source)) == s, F.lit(m)).otherwise(stands)
    name = F.coalesce(name, stands, F.lit(""))
    out = F.lit(False)
    for w in wanted:
        out = out | name.contains(w)
    return out


def judge_keep(scores: Column, threshold: float = 3.5) -> Column:
    """Keeps sessions by their judge scores (F-21): no core score below 2 or missing, a recovery above 2
    where there is one, and a core mean of the threshold or more."""
    core = [scores[c].cast("double") for c in ("coherence", "tool_use", "faithfulness")]
    present = core[0].isNotNull() & core[1].isNotNull() & core[2].isNotNull()
    keep = present & (F.least(*core) >= 2) & (scores["recovery"].isNull() | (scores["recovery"] > 2)) & ((core[0] + core[1] + core[2]) / 3 >= threshold)
    return F.coalesce(keep, F.lit(False))


def trajectory_reason(messages: Column, max_length: int = 60, least: dict[str, int] | None = None) -> Column:
    """First structural fault of a trajectory, null if none (F-22): length, opening, ending, role, content."""
    least = least or {"system": 1, "user": 1}
    n = F.coalesce(F.size(messages), F.lit(0))
    at = lambda k: F.try_element_at(messages, F.lit(k))
    last = at(-1)
    known = F.forall(messages, lambda m: M.role(m).isin("system", "user", "assistant", "tool"))
    short = F.lit(False)
    for r, k in least.items():
        short = short | F.exists(messages, lambda m: (M.role(m) == r) & (F.coalesce(F.length(F.trim(m["content"])), F.lit(0)) < k))
    silent = F.exists(messages, lambda m: (M.role(m) == "assistant") & (F.coalesce(F.length(F.trim(m["content"])), F.lit(0)) == 0) & (F.coalesce(F.size(m["tool_calls"]), F.lit(0)) == 0))
    nameless = F.exists(messages, lambda m: (M.role(m) == "tool") & m["tool_call_id"].isNull())
    return (
        F.when((n < 3) | (n > max_length), "length")
        .when(F.coalesce(M.role(at(1)) != "system", F.lit(True)), "first not system")
        .when(F.coalesce(M.role(at(2)) != "user", F.lit(True)), "second not user")
        .when(F.coalesce((M.role(last) != "assistant") | (F.size(last["tool_calls"]) > 0), F.lit(True)), "last not a plain answer")
        .when(~F.coalesce(known, F.lit(False)), "unknown role")
        .when(short, "short content")
        .when(silent, "silent assistant")
        .when(nameless, "tool result without id")
    )


def integrity_reason(messages: Column) -> Column:
    """First fault of calls and results, null if none (F-23, W-15): an id used twice, calls that the next
    messages do not answer as exactly their set, a result that no open call expects.

    A fold over the messages keeps the ids still open and those ever used."""
    ids = lambda m: F.transform(F.coalesce(m["tool_calls"], F.array().cast("array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>")), lambda c: F.coalesce(c["id"], F.lit("")))
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("open"), none.alias("used"), F.lit(None).cast("string").alias("fault"))

    def step(s, m):
        mine = ids(m)
        tool = M.role(m) == "tool"
        answer = F.coalesce(m["tool_call_id"], F.lit(""))
        fault = (
            F.when(s["fault"].isNotNull(), s["fault"])
            .when(tool & ~F.array_contains(s["open"], answer), "orphan result")
            .when(~tool & (F.size(s["open"]) > 0), "unanswered call")
            .when((F.size(F.array_distinct(mine)) < F.size(mine)) | F.arrays_overlap(mine, s["used"]), "id used twice")
        )
        left = F.when(tool, F.array_remove(s["open"], answer)).otherwise(mine)
        return F.struct(left.alias("open"), F.concat(s["used"], mine).alias("used"), fault.alias("fault"))

    return F.aggregate(messages, start, step, lambda s: F.coalesce(s["fault"], F.when(F.size(s["open"]) > 0, "unanswered call")))


def clean_generation(content: Column) -> Column:
    """The text is not blank and holds no template token (F-32)."""
    ok = F.length(F.trim(content)) > 0
    for t in TEMPLATE_TOKENS:
        ok = ok & ~content.contains(t)
    return F.coalesce(ok, F.lit(False))
