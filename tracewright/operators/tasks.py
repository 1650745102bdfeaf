"""Task harvesting (F-15..F-18, F-29, F-33, J-10, J-11, J-16, J-21, W-5, W-6, W-19, O-8, A-29, S-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions import text as X

#: Beginnings of commit subjects that make no task.
BANNED_SUBJECTS = ["merge", "revert", "bump", "release", "wip", "chore"]


def cut_at_mutation(turns: DataFrame, key: str, least: int = 200, most_turns: int | None = None) -> DataFrame:
    """The turns before the first that asks for a change, of conversations that open with a question and
    keep an answer of ``least`` characters (F-17, W-19)."""
    t = turns if most_turns is None else turns.where(F.col("turn_no") <= most_turns)
    w = Window.partitionBy(key)
    marked = t.withColumn("__stop", F.min(F.when(X.is_mutation(F.col("prompt")), F.col("turn_no"))).over(w)).withColumn("__first", F.min("turn_no").over(w))
    marked = marked.withColumn("__asks", F.max((F.col("turn_no") == F.col("__first")) & X.is_question(F.col("prompt"))).over(w))
    kept = marked.where(F.col("__asks") & (F.col("__stop").isNull() | (F.col("turn_no") < F.col("__stop"))))
    return kept.withColumn("__long", F.max(F.length("answer")).over(w)).where(F.col("__long") >= least).drop("__stop", "__first", "__asks", "__long")


def code_commits(commits: DataFrame, numstat: DataFrame) -> DataFrame:
    """Commits fit for a task with their files (S-11, F-16): subject of 20 characters or more and none of
    the banned beginnings, 1 to 10 files, 5 to 500 added lines."""
    files = numstat.select("sha", X.rename_target(F.col("path")).alias("path"), F.col("added").try_cast("int").alias("added")).groupBy("sha").agg(F.array_sort(F.collect_set("path")).alias("changed_files"), F.coalesce(F.sum("added"), F.lit(0)).alias("insertions"))
    banned = F.lower("subject").rlike("^(" + "|".join(BANNED_SUBJECTS) + r")\b")
    return commits.where((F.length("subject") >= 20) & ~banned).join(files, "sha").where("size(changed_files) between 1 and 10 and insertions between 5 and 500")


def per_group_cap(rows: DataFrame, group: str, order: list[str], cap: int) -> DataFrame:
    """The first ``cap`` rows of each group (W-5)."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("__n") <= cap).drop("__n")


def round_robin(rows: DataFrame, key: str, group: str, n: int, seed: str = "0") -> DataFrame:
    """n rows picked in turn over the groups (W-6, O-6): rows by hash within a group, groups by the hash of
    their name, the result in the order of the rows' hashes."""
    r = rows.withColumn("__h", X.hash16(F.lit(seed), F.col(key).cast("string"))).withColumn("__g", X.hash16(F.lit(seed), F.col(group)))
    r = r.withColumn("__n", F.row_number().over(Window.partitionBy(group).orderBy("__h", key)))
    return r.orderBy("__n", "__g", "__h").limit(n).orderBy("__h").drop("__h", "__g", "__n")


def _micros(df: DataFrame, name: str) -> Column:
    """A time column as a whole number: micros of timestamps, numbers as they are."""
    kind = dict(df.dtypes)[name]
    return F.unix_micros(F.col(name).cast("timestamp")) if kind.startswith("timestamp") else F.col(name).cast("bigint")


def asof_join(left: DataFrame, right: DataFrame, by: str, left_on: str, right_on: str, value: str, tie: str, bucket: int | None = None) -> DataFrame:
    """Each left row with the value of the last right row at or before it, null if none (J-11).

    One sort of both sides together; ties on the right go to the larger ``tie``, null values are passed
    over.  With ``bucket`` (micros of timestamps, else units) a key's rows are sorted bucket by bucket, each
    its own group, and rows before the first match of their bucket take the last one of an earlier bucket;
    so a key that holds a third of all rows spreads over tasks."""
    kind_v, kind_t = dict(right.dtypes)[value], dict(right.dtypes)[tie]
    a = left.select(*[F.col(c) for c in left.columns], _micros(left, left_on).alias("__at"), F.lit(1).alias("__side"), F.lit(None).cast(kind_v).alias("__v"), F.lit(None).cast(kind_t).alias("__tie"))
    b = right.where(F.col(value).isNotNull()).select(by, _micros(right, right_on).alias("__at"), F.lit(0).alias("__side"), F.col(value).alias("__v"), F.col(tie).alias("__tie"))
    both = a.unionByName(b, allowMissingColumns=True).withColumn("__b", F.floor(F.col("__at") / bucket) if bucket else F.lit(0).cast("bigint"))
    w = Window.partitionBy(by, "__b").orderBy("__at", "__side", "__tie").rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn(value, F.last("__v", ignorenulls=True).over(w)).where("__side = 1")
    if bucket is None:
        return near.select(*left.columns, value)
    ends = b.groupBy(by, F.floor(F.col("__at") / bucket).alias("__b")).agg(F.max_by("__v", F.struct("__at", "__tie")).alias("__end"))
    wanted = near.where(F.col(value).isNull()).select(by, "__b").distinct()
    marks = wanted.join(ends, [by, "__b"], "full_outer")
    earlier = Window.partitionBy(by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # a row for each bucket
    carried = marks.withColumn("__carry", F.last("__end", ignorenulls=True).over(earlier)).select(by, "__b", "__carry")
    return near.join(carried, [by, "__b"], "left").withColumn(value, F.coalesce(value, "__carry")).select(*left.columns, value)


def interval_join(points: DataFrame, spans: DataFrame, at: str, start: str, end: str, by: str, width: int) -> DataFrame:
    """Points inside closed spans of the same ``by`` (J-10); both in whole numbers.

    Spans are laid out over buckets of ``width`` so that the join is an equi-join on (by, bucket)."""
    p = points.withColumn("__b", F.floor(F.col(at) / width))
    s = spans.where(F.col(start) <= F.col(end)).withColumn("__b", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    return p.join(s, [by, "__b"]).where(F.col(at).between(F.col(start), F.col(end))).drop("__b")


def outstanding(tasks: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Tasks not yet in the results (J-16, F-8, U-3)."""
    return tasks.join(done.select(key).distinct(), key, "left_anti")


def resolve_model(wanted: DataFrame, offered: DataFrame) -> DataFrame:
    """wanted and the offered model it means (J-21): exact, then after a slash, then as a part; of equal tiers
    the better rank, then the shorter name.  The offered list is a configuration table of checked size."""
    from tracewright.session import bounded_collect

    names = [(r["model"], r["rank"]) for r in bounded_collect(offered.select("model", "rank"), 1000, "offered models")]
    w = F.lower(F.trim("wanted"))
    options = F.array(*[F.struct(F.when(w == m.lower(), 0).when(F.lit(m.lower()).endswith(F.concat(F.lit("/"), w)), 1).when(F.lit(m.lower()).contains(w), 2).alias("tier"), F.lit(k).alias("rank"), F.lit(len(m)).alias("size"), F.lit(m).alias("model")) for m, k in names])
    return wanted.withColumn("model", F.array_min(F.filter(options, lambda o: o["tier"].isNotNull()))["model"])


def subset(problems: DataFrame, which: str) -> DataFrame:
    """all, new (number 15 and up), smoke (two easy repairs and the first comprehension), or a difficulty or kind (F-29)."""
    number = F.regexp_extract("id", r"(\d+)", 1).try_cast("int")
    p = problems.withColumn("__no", number)
    if which == "all":
        return p.drop("__no")
    if which == "new":
        return p.where("__no >= 15").drop("__no")
    if which == "smoke":
        n = F.row_number().over(Window.partitionBy("kind").orderBy("__no", "id"))
        easy = p.where("kind = 'repair' and difficulty = 'easy'").withColumn("__n", n).where("__n <= 2")
        return easy.unionByName(p.where("kind = 'comprehension'").withColumn("__n", n).where("__n = 1")).drop("__n", "__no")
    return p.where((F.col("difficulty") == which) | (F.col("kind") == which)).drop("__no")


def longest(rows: DataFrame, size: Column, tie: str, n: int) -> DataFrame:
    """The n longest rows (O-8, O-11)."""
    return rows.withColumn("__s", size).orderBy(F.col("__s").desc_nulls_last(), tie).limit(n).drop("__s")


def first_per_text(rows: DataFrame, text: str, order: str) -> DataFrame:
    """The first row of each trimmed text (F-33, W-14)."""
    packed = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(F.trim(text).alias("__t")).agg(F.min_by(packed, F.col(order)).alias("__r")).select("__r.*")
