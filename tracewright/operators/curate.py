"""Corpus curation (P-3, W-3, J-1..J-3, J-18, F-6, F-8, F-9, F-19, F-20, A-14, A-32, O-3..O-5, O-12, U-1..U-7, M-1).

The three recipes run the same stages in the three orders that exist: sanitising before the prefix
dedupe changes session keys, so the order is part of the result.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions import text as X
from tracewright.functions.runs import WordHasher, rolling
from tracewright.operators import messages as M
from tracewright.operators.quality import drop_reasons
from tracewright.session import bounded_collect, durable, ensure_small

MAX_MARKERS = 10_000
#: Runs of the benchmark that one pass over the documents takes; twice the hash's size must fit a broadcast.
RUNS_PER_BLOCK = 4_000_000
HASH_BINS = 65_536


# --- sanitising -----------------------------------------------------------------------------------

def teacher_ids(sessions: DataFrame) -> Column:
    """Model ids and names that string contents state, longest first (of equal length by name)."""
    all_texts = F.array_join(F.transform("messages", lambda m: F.coalesce(m["content"], F.lit(""))), "\n")
    found = F.concat(F.regexp_extract_all(all_texts, F.lit(X.POWERED_BY), 1), F.regexp_extract_all(all_texts, F.lit(X.POWERED_BY), 2))
    return F.transform(F.array_sort(F.transform(F.array_distinct(F.filter(found, lambda s: s != "")), lambda s: F.struct((-F.length(s)).alias("n"), s.alias("s")))), lambda x: x["s"])


def sanitise(sessions: DataFrame, model: str, workspace: str) -> DataFrame:
    """Teacher identities and temporary worktrees rewritten in every string of messages and tools (P-3).

    Worktree paths become the workspace, bare worktree names its base name, the identity line names
    ``model``, then each stated id becomes ``model``, the longest first.  Strings are rewritten leaf by
    leaf; null stays null."""
    base = workspace.rstrip("/").rsplit("/", 1)[-1]
    quote = lambda s: s.replace("\\", "\\\\").replace("$", "\\$")

    def clean(text: Column) -> Column:
        t = F.regexp_replace(text, X.WORKTREE, quote(workspace))
        t = F.regexp_replace(t, X.WORKTREE_NAME, quote(base))
        t = F.regexp_replace(t, X.POWERED_BY, quote(f"You are powered by the model named {model}. The exact model ID is {model}"))
        return F.aggregate(F.col("__ids"), t, lambda acc, i: F.replace(acc, i, F.lit(model)))

    def leafwise(m: Column) -> Column:
        call = lambda c: F.struct(c["id"].alias("id"), c["type"].alias("type"), F.struct(c["function"]["name"].alias("name"), clean(c["function"]["arguments"]).alias("arguments")).alias("function"))
        return F.struct(m["role"].alias("role"), clean(m["content"]).alias("content"), clean(m["reasoning_content"]).alias("reasoning_content"), F.transform(m["tool_calls"], call).alias("tool_calls"), m["tool_call_id"].alias("tool_call_id"), m["name"].alias("name"))

    out = sessions.withColumn("__ids", teacher_ids(sessions)).withColumn("messages", F.transform("messages", leafwise))
    if "tools" in sessions.columns:
        out = out.withColumn("tools", clean(F.col("tools")))
    return out.drop("__ids")


# --- dedupe ---------------------------------------------------------------------------------------

def prefix_dedupe(sessions: DataFrame, order: str, split: str = "_split") -> DataFrame:
    """One session for each system prompt and first user text (W-3).

    The longest message list wins.  Of equally long ones an eval row wins over others, and of eval rows
    the last, of others the first; if any row of the key was eval the survivor is eval.  max_by over one
    aggregation keeps a row a key: a hot key is combined map-side and never gathered."""
    m = F.col("messages")
    key = X.prefix_key(M.nth_text(m, "system", 1), M.nth_text(m, "user", 1))
    is_eval = F.coalesce(F.col(split) == "eval", F.lit(False))
    rank = F.struct(F.coalesce(F.size(m), F.lit(0)).alias("n"), is_eval.cast("int").alias("e"), F.when(is_eval, F.col(order)).otherwise(-F.col(order)).alias("o"))
    packed = F.struct(*[F.col(c) for c in sessions.columns])
    best = sessions.groupBy(key.alias("session_key")).agg(F.max_by(packed, rank).alias("r"), F.bool_or(is_eval).alias("any_eval"))
    cols = [F.when(F.col("any_eval"), F.lit("eval")).otherwise(F.col(f"r.{c}")).alias(c) if c == split else F.col(f"r.{c}").alias(c) for c in sessions.columns]
    return best.select("session_key", *cols)


def greedy_near_dedupe(docs: DataFrame, key: str, text: str, threshold: float = 0.8, k: int = 3) -> DataFrame:
    """Keys that a greedy pass in key order keeps (M-1): one is dropped if an earlier *kept* one is alike.

    Two sets of Jaccard t share one of the first floor((1-t)*n)+1 shingles in rarest-first order (prefix
    filter, exact), so only these are joined; pairs are verified on whole sets.  The kept set is then found
    by rounds: keep what has no earlier undecided or kept neighbour, drop the neighbours of the kept.
    Empty texts have no shingle and are alike to each other (similarity 1): the first is kept."""
    sets = durable(docs.select(F.col(key).alias("id"), X.shingles(F.lower(F.coalesce(text, F.lit("")))).alias("s") if k == 3 else X.shingles(F.lower(F.coalesce(text, F.lit(""))), k).alias("s")))
    hashed = sets.select("id", F.transform("s", lambda x: F.xxhash64(x)).alias("s")).where("size(s) > 0")
    # equal sets collapse to the first key before any pair is made
    named = hashed.withColumn("name", F.sha2(F.concat_ws(",", F.transform(F.array_sort("s"), lambda x: x.cast("string"))), 256))
    first = named.groupBy("name").agg(F.min("id").alias("id"))
    reps = durable(named.join(first, ["name", "id"], "left_semi").select("id", "s"))
    tokens = reps.select("id", F.size("s").alias("n"), F.explode("s").alias("t"))
    df_of = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    ordered = tokens.join(df_of, "t").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("o"))
    prefix = ordered.select("id", "n", F.explode(F.transform(F.slice("o", F.lit(1), (F.floor((1 - threshold) * F.col("n") + 1e-9) + 1).cast("int")), lambda x: x["t"])).alias("t"))
    a, b = prefix.select(F.col("id").alias("a"), F.col("n").alias("na"), "t"), prefix.select(F.col("id").alias("b"), F.col("n").alias("nb"), "t")
    pairs = a.join(b, "t").where((F.col("a") < F.col("b")) & (F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-9)).select("a", "b").distinct()
    sa, sb = reps.select(F.col("id").alias("a"), F.col("s").alias("sa")), reps.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    edges = durable(pairs.join(sa, "a").join(sb, "b").where(X.jaccard(F.col("sa"), F.col("sb")) >= threshold).select("a", "b"))
    state = durable(reps.select("id"))
    dropped = edges.select(F.col("b").alias("id")).limit(0)
    open_edges = edges
    while not open_edges.isEmpty():
        waiting = open_edges.select(F.col("b").alias("id")).distinct()
        kept = open_edges.select(F.col("a").alias("id")).distinct().join(waiting, "id", "left_anti")  # no earlier open neighbour
        gone = durable(open_edges.join(kept.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).distinct())
        dropped = durable(dropped.unionByName(gone).distinct())
        open_edges = open_edges.join(gone.withColumnRenamed("id", "a"), "a", "left_anti").join(gone.withColumnRenamed("id", "b"), "b", "left_anti")
        open_edges = durable(open_edges.join(kept.withColumnRenamed("id", "a"), "a", "left_anti"))
    blank = sets.where("size(s) = 0").agg(F.min("id").alias("id")).where("id is not null")
    return state.join(dropped, "id", "left_anti").unionByName(blank).withColumnRenamed("id", key)


# --- decontamination ------------------------------------------------------------------------------

def _hit_runs(df: DataFrame, key: str, text: str, n: int, wanted=None) -> DataFrame:
    """(key, h, gram): runs of n words of the lower-cased text, of ``wanted`` hashes (a broadcast sorted
    array) only if given; one row for each run of a text."""
    schema = df.select(key).schema.add("h", "long").add("gram", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        some = None if wanted is None else wanted.value
        for batch in batches:
            row, hashes, grams = [], [], []
            for k, t in enumerate(batch.column(1).to_pylist()):
                w = t.lower().split() if t else ()
                h = rolling(hasher(w), n) if len(w) >= n else ()
                if not len(h):
                    continue
                if some is None:
                    at = range(len(h))
                else:
                    place = np.searchsorted(some, h)
                    place[place == len(some)] = 0
                    at = np.flatnonzero(some[place] == h) if len(some) else ()
                for j in at:
                    row.append(k)
                    hashes.append(int(h[j].view(np.int64)))
                    grams.append(" ".join(w[j : j + n]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(hashes, pa.int64()), pa.array(grams, pa.string())], names=schema.names)

    return df.select(key, text).mapInArrow(run, schema)


def contaminated(docs: DataFrame, key: str, text: str, benchmark: DataFrame, bench_text: str, n: int = 13) -> DataFrame:
    """Keys of documents that share a run of n words with the benchmark (J-1); null texts share none.

    The benchmark's distinct runs, as hashes, are the query side: they run in blocks of ``RUNS_PER_BLOCK``
    (one for any usual benchmark), each held sorted on every executor, against all documents in a narrow
    pass that gives out only hits.  Hits are then checked on the words themselves."""
    spark = docs.sparkSession
    bench = durable(_hit_runs(benchmark.select(F.lit(0).alias("__k"), F.col(bench_text).alias("__b")), "__k", "__b", n).select("h", "gram").distinct())
    blocks = max(1, -(-bench.count() // RUNS_PER_BLOCK))
    out: DataFrame | None = None
    for block in range(blocks):
        mine = bench.where(F.pmod("h", F.lit(blocks)) == block)
        hashes = np.sort(mine.select("h").distinct().toArrow().column(0).to_numpy().view(np.uint64))
        ensure_small(hashes.nbytes, "benchmark runs")
        hits = _hit_runs(docs, key, text, n, spark.sparkContext.broadcast(hashes))
        found = hits.join(mine, ["h", "gram"]).select(key)
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def decontaminate(docs: DataFrame, key: str, text: str, benchmark: DataFrame, bench_text: str, n: int = 13) -> DataFrame:
    """The documents without a run in the benchmark; an empty benchmark drops nothing."""
    return docs.join(contaminated(docs, key, text, benchmark, bench_text, n), key, "left_anti")


def marker_hits(rows: DataFrame, key: str, text: str, markers: DataFrame) -> DataFrame:
    """key, problem, marker: for each problem the first of its markers that stands in the text, in any case (F-19, J-18).

    The marker table (problem, pos, marker) is configuration of checked size and becomes an expression, so
    there is no product of rows and markers."""
    table = bounded_collect(markers.orderBy("problem", "pos"), MAX_MARKERS, "markers")
    ensure_small(sum(len(r.marker) for r in table), "markers")
    by: dict[str, list[str]] = {}
    for r in table:
        by.setdefault(r.problem, []).append(r.marker)
    low = F.lower(F.coalesce(text, F.lit("")))
    found = [F.struct(F.lit(p).alias("problem"), F.coalesce(*[F.when(low.contains(m.lower()), F.lit(m)) for m in ms], F.lit(None).cast("string")).alias("marker")) for p, ms in by.items()]
    empty = F.array().cast("array<struct<problem:string,marker:string>>")
    hit = F.filter(F.array(*found), lambda x: x["marker"].isNotNull()) if found else empty
    return rows.select(key, F.explode(hit).alias("h")).select(key, "h.problem", "h.marker")


def drop_marked(rows: DataFrame, key: str, text: str, markers: DataFrame) -> DataFrame:
    """Rows without any marker (F-20)."""
    return rows.join(marker_hits(rows, key, text, markers).select(key).distinct(), key, "left_anti")


def contamination_counts(rows: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """total, contaminated (A-32)."""
    hit = hits.select(key).distinct().withColumn("hit", F.lit(1))
    return rows.join(hit, key, "left").agg(F.count(F.lit(1)).alias("total"), F.count("hit").alias("contaminated"))


# --- balance and splits ---------------------------------------------------------------------------

def _first_by_hash(rows: DataFrame, group: list[str], key: str, cap, seed: str) -> DataFrame:
    """Exactly ``cap`` rows of each group, those of the lowest hashes; ``cap`` turns the table of bins into
    one with a column cap.

    A histogram over hash bins tells how many rows each bin gives.  Bins given whole need no order; only
    the rows of the bin in which the cap falls are ranked, so no window ever holds a whole group."""
    h = rows.withColumn("__h", X.hash16(F.lit(seed), F.col(key).cast("string"))).withColumn("__bin", F.conv(F.substring("__h", 1, 4), 16, 10).cast("int"))
    counts = h.groupBy(*group, "__bin").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*group).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each bin
    given = cap(counts.withColumn("__before", before)).select(*group, "__bin", "__n", F.greatest(F.lit(0), F.least("__n", F.col("cap") - F.col("__before"))).alias("__take")).where("__take > 0")
    marked = h.join(given, [*group, "__bin"])
    whole = marked.where("__take = __n")
    last = marked.where("__take < __n").withColumn("__r", F.row_number().over(Window.partitionBy(*group, "__bin").orderBy("__h", key))).where("__r <= __take").drop("__r")
    return whole.unionByName(last).drop("__h", "__bin", "__n", "__take")


def balance(rows: DataFrame, source: str, key: str, max_ratio: float, seed: str = "0") -> DataFrame:
    """Sources cut to at most ``max_ratio`` times the smallest (O-5); unchanged for a ratio of 0 or one source.

    Which rows stay goes by a seeded hash of the key instead of a sequential random generator."""
    if max_ratio <= 0:
        return rows
    sizes = rows.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    least, sources = sizes.agg(F.min("n")).scalar(), sizes.agg(F.count(F.lit(1))).scalar()
    cap = F.when(sources < 2, F.lit(1 << 62)).otherwise(F.greatest(F.lit(1), F.floor(least * max_ratio))).cast("bigint")
    caps = sizes.select(source, cap.alias("cap"))
    return _first_by_hash(rows, [source], key, lambda bins: bins.join(caps, source), seed)


def hash_group_split(rows: DataFrame, group: str, fraction: float, seed: str = "0") -> DataFrame:
    """rows with _split: whole groups in the order of their seeded hash, the first max(1, round(fraction *
    groups)) are eval (O-3, J-2)."""
    groups = rows.select(F.coalesce(F.col(group).cast("string"), F.lit("")).alias("__g")).distinct()
    cap = F.greatest(F.lit(1), F.bround(groups.agg(F.count(F.lit(1))).scalar() * fraction, 0).cast("bigint"))
    chosen = _first_by_hash(groups, [], "__g", lambda bins: bins.withColumn("cap", cap), seed).select("__g").withColumn("__eval", F.lit(True))
    return rows.withColumn("__g", F.coalesce(F.col(group).cast("string"), F.lit(""))).join(chosen, "__g", "left").withColumn("_split", F.when(F.col("__eval"), "eval").otherwise("train")).drop("__g", "__eval")


def leaked_keys(train: DataFrame, held_out: DataFrame, key: str) -> DataFrame:
    """Keys in both splits (J-3, U-4)."""
    return train.select(key).intersect(held_out.select(key))


def assert_no_leak(train: DataFrame, held_out: DataFrame, key: str) -> None:
    if not leaked_keys(train, held_out, key).isEmpty():
        raise ValueError(f"train and eval share values of {key}")


def source_totals(rows: DataFrame, source: str, tokens: str) -> DataFrame:
    """Rows and tokens by source (A-14)."""
    return rows.groupBy(source).agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(tokens, F.lit(0))).alias("tokens"))


def allowed_sources(rows: DataFrame, source: str, wanted: str) -> DataFrame:
    """Rows of the comma-listed sources (F-6); an empty list allows all."""
    names = [w.strip() for w in wanted.split(",") if w.strip()]
    return rows.where(F.col(source).isin(names)) if names else rows


def by_source_rank(rows: DataFrame, source: str, ranked: list[str], tie: str) -> DataFrame:
    """Rows in the order of a ranked source list, unlisted sources last (O-12)."""
    place = F.lit(len(ranked))
    for k, name in reversed(list(enumerate(ranked))):
        place = F.when(F.col(source) == name, k).otherwise(place)
    return rows.orderBy(place, F.col(source), F.col(tie))


def shuffled_split(rows: DataFrame, order: str, n_eval: int, seed: int = 0, most: int = 1_000_000) -> DataFrame:
    """rows with _split as a seeded Mersenne-Twister shuffle of their places gives it (O-4).

    Exact parity needs the sequential generator, so only the row count goes to the driver and at most
    ``most`` rows are taken; larger data uses hash_group_split on the key."""
    n = rows.count()
    if n > most:
        raise ValueError(f"{n} rows: use hash_group_split")
    places = list(range(n))
    random.Random(seed).shuffle(places)
    held = rows.sparkSession.createDataFrame([(p, True) for p in places[:n_eval]], "__p bigint, __e boolean")
    placed = rows.withColumn("__p", F.row_number().over(Window.orderBy(order)).cast("bigint") - 1)
    return placed.join(F.broadcast(held), "__p", "left").withColumn("_split", F.when(F.col("__e"), "eval").otherwise("train")).drop("__p", "__e")


def resplit(train: DataFrame, held_out: DataFrame) -> DataFrame:
    """Both sets as one, tagged by where they came from (U-2)."""
    return train.withColumn("_split", F.lit("train")).unionByName(held_out.withColumn("_split", F.lit("eval")), allowMissingColumns=True)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name, missing columns null (U-1, U-7)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# --- recipes --------------------------------------------------------------------------------------

class Recipe:
    """Named orders of the curation stages over sessions (key, _ord, messages, tools, source, _split, _group)."""

    def __init__(self, key: str, benchmark: DataFrame, bench_text: str, markers: DataFrame | None = None, model: str = "assistant", workspace: str = "/workspace", max_tokens: int = 64_000):
        self.key, self.benchmark, self.bench_text, self.markers = key, benchmark, bench_text, markers
        self.model, self.workspace, self.max_tokens = model, workspace, max_tokens

    def _filter(self, s: DataFrame) -> DataFrame:
        return drop_reasons(s, self.key, self.max_tokens).where("drop_reason is null").drop("drop_reason")

    def _sanitise(self, s: DataFrame) -> DataFrame:
        return sanitise(s, self.model, self.workspace)

    def _dedupe(self, s: DataFrame) -> DataFrame:
        return prefix_dedupe(s, "_ord").drop("session_key")

    def _decontaminate(self, s: DataFrame) -> DataFrame:
        with_text = s.withColumn("__text", M.record_text(F.col("messages"), F.col("tools")))
        return decontaminate(with_text, self.key, "__text", self.benchmark, self.bench_text).drop("__text")

    def _markers(self, s: DataFrame) -> DataFrame:
        if self.markers is None:
            return s
        with_text = s.withColumn("__text", F.to_json(F.struct("messages")))
        return drop_marked(with_text, self.key, "__text", self.markers).drop("__text")

    def library(self, s: DataFrame) -> DataFrame:
        """filter, sanitise, dedupe, decontaminate, markers"""
        return self._markers(self._decontaminate(self._dedupe(self._sanitise(self._filter(s)))))

    def command(self, s: DataFrame) -> DataFrame:
        """filter, dedupe, sanitise, decontaminate; no marker gate"""
        return self._decontaminate(self._sanitise(self._dedupe(self._filter(s))))

    def raw(self, s: DataFrame, ratio: float = 0.0, fraction: float = 0.1) -> DataFrame:
        """filter, balance, sanitise, decontaminate, split by group; the loader already removed duplicates"""
        kept = self._decontaminate(self._sanitise(balance(self._filter(s), "source", self.key, ratio)))
        return hash_group_split(kept.drop("_split"), "_group", fraction)
