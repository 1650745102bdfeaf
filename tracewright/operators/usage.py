"""Usage analytics (P-10, P-11, A-1..A-8, A-14, A-15, A-21, A-22, A-25, A-27, A-35, J-5..J-7, J-17, J-19, J-22, O-1, O-2, W-7)."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions import text as X
from tracewright.operators import messages as M
from tracewright.operators.trace import steps
from tracewright.session import with_previous, with_rank, with_running_sum

FIGURES = ("prompt", "completion", "total", "cached", "reasoning")
GAP_MINUTES = 30


def usage(response: Column) -> Column:
    """Struct of the usage figures with their other names and fallbacks (P-10)."""
    u = response["usage"]
    zero = lambda *c: F.coalesce(*c, F.lit(0))
    prompt, completion = zero(u["prompt_tokens"], u["input_tokens"]), zero(u["completion_tokens"], u["output_tokens"])
    return F.struct(
        prompt.alias("prompt"), completion.alias("completion"), F.coalesce(u["total_tokens"], prompt + completion).alias("total"),
        zero(u["prompt_tokens_details"]["cached_tokens"]).alias("cached"), zero(u["completion_tokens_details"]["reasoning_tokens"]).alias("reasoning"),
        F.coalesce(u["cost"], F.lit(0.0)).alias("cost"), u.isNotNull().alias("has_usage"),
    )


def source_label(upstream: Column, replay: Column) -> Column:
    """frontier, replay or opencode (P-11)."""
    return F.when(F.lower(upstream) == "openrouter", "frontier").when(replay.isNotNull(), "replay").otherwise("opencode")


def calls(records: DataFrame) -> DataFrame:
    """One row for each call: record_id (the request's, or the reply's if its request is lost), ids, model,
    upstream, ts, usage figures, finish reason.

    A record is one side of a call, or both.  A reply belongs to the request right before it in its session,
    by instant; its model is that of the session's last request, 'unknown' if there is none.  Sides without a
    session or a readable instant pair with nothing; deliveries of one record_id count once, those of none
    each for themselves."""
    u = usage(F.col("response"))
    sides = records.select(
        "record_id", "session_id", "project_id", "ingested_at", X.instant(F.col("timestamp")).alias("ts"), F.col("request").isNotNull().alias("asks"), F.nullif("request.model", F.lit("")).alias("model"),
        F.nullif("upstream", F.lit("")).alias("upstream"), F.col("response.finish_reason").alias("finish"), u.alias("u"), F.col("response").isNotNull().alias("replies"),
    )
    packed = F.struct(*[F.col(c) for c in sides.columns if c != "ingested_at"])
    once = sides.where("record_id is not null").groupBy("record_id").agg(F.max_by(packed, F.coalesce("ingested_at", F.to_timestamp(F.lit("1970-01-01")))).alias("s")).select("s.*").unionByName(sides.where("record_id is null").drop("ingested_at"))
    placed = F.col("ts").isNotNull() & F.col("session_id").isNotNull()
    before = {"last_side": F.when(placed, F.struct("asks", "replies", "record_id")), "last_model": F.when(placed & F.col("asks"), F.col("model"))}
    paired = with_previous(once, "session_id", ["ts", "record_id"], before)
    own = F.col("asks") | ~placed | ~F.coalesce(F.col("last_side.asks") & ~F.col("last_side.replies"), F.lit(False))
    call = F.coalesce(F.when(own, F.col("record_id")).otherwise(F.col("last_side.record_id")), F.expr("-1 - monotonically_increasing_id()"))
    named = paired.select("*", call.alias("call"), F.coalesce("model", F.when(~F.col("asks") & placed, F.col("last_model")), F.lit("unknown")).alias("of_model"))
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), ~F.col("asks"))).alias(c)  # noqa: E731  the request's, else the reply's
    figures = [F.sum(F.col(f"u.{c}")).alias(c) for c in (*FIGURES, "cost")]
    made = named.groupBy("call").agg(F.min("record_id").alias("any_id"), first("session_id"), first("project_id"), first("of_model"), first("upstream"), F.min("ts").alias("ts"), F.max("finish").alias("finish"), *figures, F.bool_or("u.has_usage").alias("has_usage"))
    return made.select(F.when(F.col("call") >= 0, F.col("call")).alias("record_id"), "session_id", "project_id", F.col("of_model").alias("model"), F.coalesce("upstream", F.lit("local")).alias("upstream"), "ts", "finish", *FIGURES, "cost", "has_usage")


def rollup(calls: DataFrame, *by: str) -> DataFrame:
    """Calls and sums by the columns; cache_rate is null without prompt tokens (A-1, A-2, A-5)."""
    sums = [F.sum(c).alias(c) for c in FIGURES]
    out = calls.groupBy(*by).agg(F.count(F.lit(1)).alias("calls"), *sums, F.round(F.sum("cost"), 6).alias("cost"), F.count_if("has_usage").alias("with_usage"))
    return out.withColumn("cache_rate", F.round(F.try_divide("cached", "prompt"), 6))


def totals_and_breakdown(calls: DataFrame, *by: str) -> DataFrame:
    """All totals and each single breakdown in one grouping-sets pass (A-5, A-7); 'all' marks columns not grouped by."""
    sets = [[], *[[F.col(c)] for c in by]]
    out = calls.groupingSets(sets, *[F.col(c) for c in by]).agg(F.count(F.lit(1)).alias("calls"), *[F.sum(c).alias(c) for c in FIGURES], F.round(F.sum("cost"), 6).alias("cost"), *[F.grouping(c).alias(f"__{c}") for c in by])
    return out.select(*[F.when(F.col(f"__{c}") == 1, "all").otherwise(F.col(c)).alias(c) for c in by], "calls", *FIGURES, "cost", F.round(F.try_divide("cached", "prompt"), 6).alias("cache_rate"))


def average_figures(calls: DataFrame, *by: str) -> DataFrame:
    """Tokens and cost a call and the sessions met (A-35); tokens to the nearest whole."""
    n = F.count(F.lit(1))
    return calls.groupBy(*by).agg(F.floor(F.sum("total") / n + 0.5).alias("tokens_per_call"), F.round(F.sum("cost") / n, 8).alias("cost_per_call"), F.count_distinct("session_id").alias("n_sessions"))


def priced(calls: DataFrame) -> DataFrame:
    """Calls that cost something (F-30); an unknown cost is none."""
    return calls.where(F.coalesce("cost", F.lit(0.0)) > 0)


def daily(calls: DataFrame) -> DataFrame:
    """Calls, tokens and cost by UTC day; calls without a readable stamp are left out (A-4)."""
    return calls.where("ts is not null").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("calls"), F.sum("total").alias("total"), F.round(F.sum("cost"), 6).alias("cost"), F.min("ts").alias("first_ts"))


def timeline(events: DataFrame, ts: str, sums: dict[str, str], bins: int = 48, order: str | None = None) -> DataFrame:
    """Equal time bins from the first to the last stamp (A-6): bin, calls, sums, t0; empty bins too.

    Rows without a stamp (or all, without any span) go by their place in ``order``, in percentile bins."""
    t = F.unix_micros(F.col(ts)) if dict(events.dtypes)[ts] == "timestamp" else F.unix_micros(F.col(ts).cast("timestamp"))
    rows = events.withColumn("__t", t)
    rows = rows.withColumn("__lo", rows.agg(F.min("__t")).scalar()).withColumn("__hi", rows.agg(F.max("__t")).scalar()).withColumn("__all", rows.agg(F.count(F.lit(1))).scalar())
    by_time = F.least(F.lit(bins - 1), F.floor((F.col("__t") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins))
    timed = (F.col("__hi") > F.col("__lo")) & F.col("__t").isNotNull()
    if order:
        rows = with_rank(rows, [order], "__rank")
    rank = F.col("__rank") if order else F.lit(0)
    by_place = F.least(F.lit(bins - 1), F.floor(rank / F.greatest(F.col("__all"), F.lit(1)) * bins))
    placed = rows.withColumn("bin", F.when(timed, by_time).otherwise(by_place).cast("int"))
    made = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("calls"), *[F.round(F.sum(c), 6).alias(n) for n, c in sums.items()], F.min("__t").alias("t0"))
    every = events.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(made, "bin", "left").select("bin", F.coalesce("calls", F.lit(0)).alias("calls"), *[F.coalesce(n, F.lit(0)).alias(n) for n in sums], "t0")


def tool_rollup(sessions: DataFrame, key: str) -> DataFrame:
    """name, cat (of the first call), calls, dead (A-3, A-5)."""
    s = steps(sessions, key).where("type = 'tool'")
    return s.groupBy("name").agg(F.min_by("cat", F.struct(key, "turn_no", "step_no")).alias("cat"), F.count(F.lit(1)).alias("calls"), F.count_if("dead").alias("dead"))


def session_rollup(calls: DataFrame, key: str = "session_id") -> DataFrame:
    """Sums, time span, dominant model (ties: the earlier) and number of models of each session (A-8)."""
    per_model = calls.groupBy(key, "model").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ts", "record_id")).alias("first"))
    best = per_model.groupBy(key).agg(F.min_by("model", F.struct(-F.col("n"), F.col("first"))).alias("model"), F.count(F.lit(1)).alias("model_count"))
    sums = calls.groupBy(key).agg(F.count(F.lit(1)).alias("calls"), *[F.sum(c).alias(c) for c in FIGURES], F.round(F.sum("cost"), 6).alias("cost"), F.min("ts").alias("ts_min"), F.max("ts").alias("ts_max"))
    return sums.join(best, key).withColumn("cache_rate", F.round(F.try_divide("cached", "prompt"), 6))


def top_by(df: DataFrame, measure: str, tie: str, n: int = 12) -> DataFrame:
    """The n rows of the largest measure, ties by ``tie``; nulls last (O-2)."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(tie)).limit(n)


def session_page(sessions: DataFrame, search: str = "", sort: str = "time_updated", descending: bool = True, limit: int = 15, offset: int = 0, subagents: bool = False) -> DataFrame:
    """One page of sessions (O-1, F-13, F-14): search over title, directory and model; limit 1 to 500."""
    columns = {"time_updated", "time_created", "title", "cost", "tokens_total", "cache_rate"}
    rows = sessions if subagents else sessions.where("parent_id is null")
    q = (search or "").strip().lower()
    if q:
        rows = rows.where(F.lower("title").contains(q) | F.lower("directory").contains(q) | F.lower("model").contains(q))
    tokens = F.coalesce("tokens_input", F.lit(0)) + F.coalesce("tokens_output", F.lit(0)) + F.coalesce("tokens_reasoning", F.lit(0))
    rows = rows.withColumn("tokens_total", tokens).withColumn("cache_rate", F.coalesce(F.try_divide("tokens_cache_read", "tokens_input"), F.lit(0.0)))
    by = F.col(sort if sort in columns else "time_updated")
    return rows.orderBy(by.desc_nulls_last() if descending else by.asc_nulls_last(), F.col("id")).offset(max(0, offset)).limit(max(1, min(500, limit)))


def with_child_counts(page: DataFrame, message: DataFrame, part: DataFrame) -> DataFrame:
    """A page of sessions with assistant messages, tool calls and dead ends (J-6); zero where there are none."""
    ids = page.select(F.col("id").alias("session_id"))  # at most 500 rows
    mine = lambda df: df.join(F.broadcast(ids), "session_id", "left_semi")
    steps_ = mine(message).where(F.get_json_object("data", "$.role") == "assistant").groupBy("session_id").agg(F.count(F.lit(1)).alias("steps"))
    tools = mine(part).where(F.get_json_object("data", "$.type") == "tool").groupBy("session_id").agg(F.count(F.lit(1)).alias("tool_calls"), F.count_if(X.dead_end_sql(F.get_json_object("data", "$.state.output"))).alias("dead_ends"))
    out = page.join(steps_.withColumnRenamed("session_id", "id"), "id", "left").join(tools.withColumnRenamed("session_id", "id"), "id", "left")
    return out.fillna(0, ["steps", "tool_calls", "dead_ends"])


def root_rollup(sessions: DataFrame, *sums: str) -> DataFrame:
    """Sums of each root session and its subagents (A-25, J-7); one level of children."""
    return sessions.groupBy(F.coalesce("parent_id", "id").alias("root_id")).agg(F.count(F.lit(1)).alias("n_sessions"), *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in sums])


def nest_export(session: DataFrame, message: DataFrame, part: DataFrame) -> DataFrame:
    """Sessions with ordered messages, these with ordered parts (J-5, P-6); rows of unreadable data are left out."""
    ok = lambda df: df.where(F.try_parse_json("data").isNotNull())
    parts = ok(part).groupBy("message_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("time_created", "id", "data"))), lambda p: p["data"]).alias("parts"))
    msgs = ok(message).join(parts, F.col("id") == F.col("message_id"), "left").drop("message_id")
    nested = msgs.groupBy("session_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("time_created", "id", F.col("data").alias("info"), F.coalesce("parts", F.array().cast("array<string>")).alias("parts")))), lambda m: F.struct(m["info"].alias("info"), m["parts"].alias("parts"))).alias("messages"))
    empty = F.array().cast("array<struct<info:string,parts:array<string>>>")
    return session.join(nested, F.col("id") == F.col("session_id"), "left").drop("session_id").withColumn("messages", F.coalesce("messages", empty))


def latest_session(sessions: DataFrame) -> DataFrame:
    """The session updated last of each directory (J-22)."""
    return sessions.groupBy("directory").agg(F.max_by("id", F.struct("time_updated", "id")).alias("id"))


def gap_sessions(events: DataFrame, user: str, ts: str, tie: str, minutes: int = GAP_MINUTES) -> DataFrame:
    """Events with session_no (from 1): a new one after more than ``minutes`` without an event (T-6)."""
    seen = with_previous(events, user, [ts, tie], {"__before": F.col(ts)})
    gap = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("__before").cast("timestamp")) > minutes * 60_000_000
    numbered = with_running_sum(seen, user, [ts, tie], F.coalesce(gap, F.lit(False)).cast("int"), "session_no")
    return numbered.withColumn("session_no", F.col("session_no") + 1).drop("__before")


def message_signatures(messages: Column) -> Column:
    """A hash for each message: role and normalised text."""
    return F.transform(messages, lambda m: F.xxhash64(M.role(m), F.substring(X.normalise(F.coalesce(m["content"], F.lit(""))), 1, 2000)))


class Attacher:
    """Sequential session attachment; each request costs about its own length, however many sessions there are.

    ``extends`` names for every known prefix the session heard of last, ``whole`` for every complete list
    the sessions that consist of just that list; sessions only grow, so neither needs a search."""

    MASK = (1 << 64) - 1

    def __init__(self, gap_ms: int):
        self.gap, self.n = gap_ms, 0
        self.extends: dict[int, int] = {}
        self.whole: dict[int, list[tuple[int, int]]] = {}
        self.keys: list[list[int]] = []
        self.last: list[int | None] = []

    def prefixes(self, sig: list[int]) -> list[int]:
        out, h = [], 14695981039346656037
        for x in sig:
            h = ((h ^ (x & self.MASK)) * 1099511628211 + 0x9E3779B97F4A7C15) & self.MASK
            out.append(h)
        return out

    def _best_whole(self, key: int) -> int | None:
        heap = self.whole.get(key)
        while heap:
            ts, no = heap[0]
            if self.keys[no][-1] == key and -ts == (self.last[no] if self.last[no] is not None else -1):
                return no
            heapq.heappop(heap)
        return None

    def _note(self, no: int) -> None:
        at = self.last[no]
        for p in self.keys[no]:
            other = self.extends.get(p)
            if other is None or (at is not None and (self.last[other] is None or at > self.last[other] or (at == self.last[other] and no < other))):
                self.extends[p] = no
        heapq.heappush(self.whole.setdefault(self.keys[no][-1], []), (-(at if at is not None else -1), no))

    def add(self, sig: list[int], ts: int | None) -> int:
        """The number of the session that the request (a non-empty list of signatures) belongs to."""
        keys = self.prefixes(sig)
        best = self.extends.get(keys[-1])
        if best is None:
            best = next((no for k in reversed(keys[:-1]) if (no := self._best_whole(k)) is not None), None)
        if best is not None and len(keys) <= len(self.keys[best]) and ts is not None and self.last[best] is not None and abs(ts - self.last[best]) > self.gap:
            best = None
        if best is None:
            best, self.n = self.n, self.n + 1
            self.keys.append(keys)
            self.last.append(ts)
        else:
            if len(keys) > len(self.keys[best]):
                self.keys[best] = keys
            if ts is not None:
                self.last[best] = ts
        self._note(best)
        return best


def attach_sessions(requests: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """(record_id, session_key) for requests (record_id, ts, messages) (W-7, J-17, A-24).

    In the order of ts (nulls last) a request joins the session that shares the longest message prefix,
    one list being a prefix of the other, of equal ones the one heard of last; a request no longer than its
    session starts a new one after the gap.  The fold is sequential by nature; it runs apart for each
    opening (all messages up to the first user's), so a system prompt that all sessions share makes no hot
    group, and streams through sorted Arrow batches, so a hot opening is never gathered.  A request without
    a user message only meets its like.  Empty requests get no session."""
    opening = F.greatest(F.array_position(F.transform("messages", lambda m: M.role(m)), F.lit("user")), F.lit(0))
    rows = requests.select("record_id", F.unix_millis("ts").alias("ts"), message_signatures(F.col("messages")).alias("sig"), opening.alias("opening")).where("size(sig) > 0")
    rows = rows.select(F.xxhash64(F.when(F.col("opening") > 0, F.slice("sig", F.lit(1), F.col("opening").cast("int"))).otherwise(F.col("sig"))).alias("first"), "record_id", "ts", "sig")
    ordered = rows.repartition("first").sortWithinPartitions("first", F.col("ts").asc_nulls_last(), "record_id")
    gap = gap_minutes * 60_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, attacher = None, None
        for batch in batches:
            out = []
            for first, ts, sig in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if attacher is None or first != now:
                    now, attacher = first, Attacher(gap)
                out.append(f"{first & 0xFFFFFFFFFFFFFFFF:016x}-{attacher.add(sig, ts)}")
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(out, pa.string())], names=["record_id", "session_key"])

    return ordered.mapInArrow(run, "record_id bigint, session_key string")


def harvested_titles(records: DataFrame) -> DataFrame:
    """(first_user_key, title) from calls that ask for a title; the last title wins (J-19)."""
    first = M.first_user(F.col("request.messages"))
    asks = F.coalesce(first.rlike(r"(?i)generate a (?:short )?title"), F.lit(False))
    users = F.transform(M.of_role(F.col("request.messages"), "user"), lambda m: m["content"])
    convo = F.trim(F.array_join(F.slice(users, 2, 1_000_000), "\n"))
    convo = F.when(convo != "", convo).otherwise(F.trim(F.regexp_replace(F.regexp_replace(first, r"(?i)generate a (?:short )?title", ""), r"^[^:]*:\s*", "")))
    rows = records.where(asks).select(X.session_key(convo).alias("first_user_key"), F.trim("response.message.content").alias("title"), "record_id").where("title <> ''")
    return rows.groupBy("first_user_key").agg(F.max_by("title", "record_id").alias("title"))


def value_profile(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each value, null included (A-21)."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col(column).cast("string").alias("value"), "n", F.round(F.col("n") / counted.agg(F.sum("n")).scalar(), 6).alias("share"))


def number_profile(df: DataFrame, column: str, *by: str) -> DataFrame:
    """n, min, quartiles, p95 (linear interpolation), max, mean (A-21, A-22)."""
    c = F.col(column).cast("double")
    quantile = lambda q, n: F.round(F.percentile(c, F.lit(q)), 6).alias(n)
    return df.groupBy(*by).agg(F.count(c).alias("n"), F.min(c).alias("min"), quantile(0.25, "q1"), quantile(0.5, "median"), quantile(0.75, "q3"), quantile(0.95, "p95"), F.max(c).alias("max"), F.round(F.avg(c), 6).alias("mean"))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows by equal bins of [low, high]; values outside go to the nearest bin, nulls nowhere."""
    c = F.col(column).cast("double")
    place = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((c - low) / (high - low) * bins))).cast("int")
    return df.where(c.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
