"""Reports and small registries (A-18, A-27, A-33, A-34, F-11, F-24, J-23, O-7, O-9, O-10, P-32, X-2, X-4, X-5, X-7).

Not built, being no data operators or business rules: T-8 (a cache), X-6 (runs code), F-34 (file janitor),
A-19 and F-25 (which orders count).  J-20 is ``curate.greedy_near_dedupe``."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions import text as X
from tracewright.operators import messages as M
from tracewright.session import bounded_collect

MAX_TOKEN_IDS = 1_000_000
LATENCY_LIMIT = 10_000


def default_usage() -> Column:
    """The usage record with nothing known (P-32)."""
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("double")
    return F.struct(zero.alias("prompt"), zero.alias("completion"), zero.alias("total"), zero.alias("cached"), zero.alias("reasoning"), none.alias("cost"), F.lit(False).alias("has_usage"))


def trainable(df: DataFrame, ids: str, mask: str, max_length: int) -> DataFrame:
    """Token rows shorter than the limit with something to learn from (F-11)."""
    return df.where((F.size(ids) < max_length) & F.exists(mask, lambda m: m == 1))


def valid_event(event: Column) -> Column:
    """A JSON event with a non-empty string id, a string category and a number (no boolean) from 0 to
    10000 as latency (F-24)."""
    v = F.try_parse_json(event)
    kind = lambda k: F.coalesce(F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant")), F.lit("VOID"))
    number = kind("latency_ms").rlike(r"^(BIGINT|DOUBLE|DECIMAL.*)$")
    latency = F.try_variant_get(v, "$.latency_ms", "double")
    return F.coalesce((kind("id") == "STRING") & (F.try_variant_get(v, "$.id", "string") != "") & (kind("category") == "STRING") & number & latency.between(0, LATENCY_LIMIT), F.lit(False))


def audit_summary(events: DataFrame) -> DataFrame:
    """Count, the most frequent category (ties: the first by name) and the mean latency, half-even to one
    place, of events (id, category, latency_ms); the first row of an id counts (A-18)."""
    n = events.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("latency_ms").alias("s"))
    return n.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.min_by("category", F.struct(-F.col("n"), F.col("category"))).alias("top_category"), F.bround(F.try_divide(F.sum("s"), F.sum("n")), 1).alias("mean_latency"))


def ids_token(events: DataFrame, mode: str, key: str = "id") -> str:
    """First twelve digits of sha-256 over the mode and all sorted ids (A-18); a bounded report, more ids are an error."""
    ids = sorted(r[0] for r in bounded_collect(events.select(F.col(key).cast("string")), MAX_TOKEN_IDS, "report ids"))
    return hashlib.sha256(f"{mode}:{','.join(ids)}".encode()).hexdigest()[:12]


def yield_report(attempts: DataFrame) -> DataFrame:
    """Attempts by the stage at which they failed ('kept' if at none) and their share in percent (A-33)."""
    n = attempts.groupBy(F.coalesce("failed_stage", F.lit("kept")).alias("stage")).agg(F.count(F.lit(1)).alias("n"))
    return n.select("stage", "n", F.round(100 * F.col("n") / n.agg(F.sum("n")).scalar(), 2).alias("percent"))


def dashboard_counts(rows: DataFrame) -> DataFrame:
    """Total, captured (a verdict is there) and passed (A-27)."""
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count("passed").alias("captured"), F.count_if("passed").alias("passed"))


def dashboard_order(df: DataFrame, column: str, tie: str, descending: bool = True) -> DataFrame:
    """Rows by a column, strings in any case, null numbers as 0 (O-7)."""
    c = F.lower(F.coalesce(column, F.lit(""))) if dict(df.dtypes)[column] == "string" else F.coalesce(column, F.lit(0))
    return df.orderBy(c.desc() if descending else c.asc(), tie)


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in an order; 0 gives all (O-9, O-10)."""
    ordered = df.orderBy(*order) if order else df
    return ordered.limit(n) if n > 0 else ordered


def session_meta(sessions: DataFrame, key: str) -> DataFrame:
    """key, title, first_user_key and message counts of a session (J-23)."""
    first = M.first_user(F.col("messages"))
    return sessions.select(key, X.short_title(first).alias("title"), F.when(F.coalesce(first, F.lit("")) != "", X.session_key(first)).alias("first_user_key"), F.coalesce(F.size("messages"), F.lit(0)).alias("n_messages"), F.size(M.calls(F.col("messages"))).alias("n_calls"))


def word_count(text: Column) -> Column:
    """Words between white space; none in an empty or null text (A-34)."""
    return F.coalesce(F.size(X.words(text)), F.lit(0))


#: Parsers of raw generations by chat format (X-5).
GENERATION_PARSERS: dict[str, Callable[[Column], Column]] = {"keyed": M.parse_generation, "functional": lambda c: M.parse_generation(c, "functional")}


class Sections:
    """Report sections in order, each a function of a DataFrame to (label, value) rows (X-4)."""

    def __init__(self):
        self.parts: list[tuple[str, Callable[[DataFrame], DataFrame]]] = []

    def add(self, name: str):
        def put(fn):
            if any(n == name for n, _ in self.parts):
                raise ValueError(f"section {name} exists")
            self.parts.append((name, fn))
            return fn

        return put

    def render(self, df: DataFrame) -> DataFrame:
        """section_no, section, label, value of all sections."""
        out = None
        for k, (name, fn) in enumerate(self.parts):
            part = fn(df).select(F.lit(k).alias("section_no"), F.lit(name).alias("section"), F.col("label").cast("string").alias("label"), F.col("value").cast("string").alias("value"))
            out = part if out is None else out.unionByName(part)
        if out is None:
            raise ValueError("no section")
        return out


class Services:
    """Named DataFrame functions with the columns and types they need (X-2)."""

    def __init__(self):
        self.known: dict[str, tuple[dict[str, str], Callable[..., DataFrame]]] = {}

    def register(self, name: str, needs: dict[str, str]):
        def put(fn):
            if name in self.known:
                raise ValueError(f"service {name} exists")
            self.known[name] = (needs, fn)
            return fn

        return put

    def call(self, name: str, df: DataFrame, **options) -> DataFrame:
        if name not in self.known:
            raise KeyError(f"unknown service {name}")
        needs, fn = self.known[name]
        have = dict(df.dtypes)
        wrong = [f"{c}: {t}" for c, t in needs.items() if have.get(c) != t]
        if wrong:
            raise TypeError(f"service {name} needs {', '.join(wrong)}")
        return fn(df, **options)


SERVICES = Services()


@SERVICES.register("word_count", {"text": "string"})
def _word_counts(df: DataFrame) -> DataFrame:
    return df.withColumn("n_words", word_count(F.col("text")))


@SERVICES.register("line_stats", {"text": "string"})
def _line_stats(df: DataFrame) -> DataFrame:
    lines = F.split("text", r"\n")
    return df.withColumn("n_lines", F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(F.size(lines))).withColumn("longest_line", F.coalesce(F.array_max(F.transform(lines, F.length)), F.lit(0)))


@SERVICES.register("dedupe", {"text": "string"})
def _dedupe(df: DataFrame) -> DataFrame:
    return df.dropDuplicates(["text"])


def roster(df: DataFrame) -> DataFrame:
    """An agent table (label, command, model) whose labels are unique; a repeated label is an error (X-7)."""
    rows = bounded_collect(df.groupBy("label").agg(F.count(F.lit(1)).alias("n")), 10_000, "agents")
    again = sorted(str(r.label) for r in rows if r.n > 1)
    if again:
        raise ValueError(f"labels are not unique: {', '.join(again)}")
    return df
