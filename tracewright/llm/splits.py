"""Problem 6: train, validation and test splits that keep related records together.

Rows, the spellings of their groups, task prompts, group keys and tasks form a graph: a row touches its
spelling or the prompts it holds, a spelling the task (or group key) it names, a prompt its tasks.  The
components come from random-mate contraction.  A row's task is the task of its component; whole components
are placed by cumulative weight, so that each source comes as near to the wanted proportions as its
components allow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm.components import components
from tracewright.session import bounded_collect, clean_label, durable, ensure_small, table

#: A task id: two letters and twelve hexadecimal digits, with anything but letters and digits between.
TASK_ID = r"(?:^|[^0-9a-z])([a-z]{2})[^0-9a-z]*([0-9a-f]{12})(?:[^0-9a-z]|$)"
MAX_TASKS = 200_000
BINS = 4096
SPLITS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))


def squeezed(col: Column) -> Column:
    """Lower case, without white space and invisible characters."""
    return F.regexp_replace(F.lower(col), r"[\s\p{Z}\p{Cf}]+", "")


def task_key(col: Column) -> Column:
    """The task id that a group name holds, however it is written: its letters and digits; null if none."""
    low = F.lower(col)
    found = F.concat(F.regexp_extract(low, TASK_ID, 1), F.regexp_extract(low, TASK_ID, 2))
    return F.nullif(found, F.lit(""))


def plain_key(col: Column) -> Column:
    return F.nullif(F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]+", ""), F.lit(""))


def prompt_hits(asked: DataFrame, tasks: DataFrame) -> DataFrame:
    """(sample_id, prompt) where the first user text holds a task's prompt, named by its hash.

    asked: sample_id, text (squeezed).  All prompts run over a text in one pass of an automaton; their
    table is held on every executor and its size is checked.  Tasks without a prompt match nothing."""
    prompts = squeezed(F.col("prompt"))
    rows = bounded_collect(tasks.select(prompts.alias("p"), F.xxhash64(prompts).alias("h")).where("length(p) > 0").distinct(), MAX_TASKS, "task prompts")
    ids_of = {r.p: r.h for r in rows}
    ensure_small(sum(4 * len(p) for p in ids_of), "task prompts")
    shared = asked.sparkSession.sparkContext.broadcast(ids_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for p, h in shared.value.items():
            automaton.add_word(p, h)
        if shared.value:
            automaton.make_automaton()
        for batch in batches:
            sample, prompt = [], []
            if shared.value:
                for rec, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    hits = {h for _, h in automaton.iter(text)}
                    sample.extend([rec] * len(hits))
                    prompt.extend(hits)
            yield pa.RecordBatch.from_arrays([pa.array(sample, pa.int64()), pa.array(prompt, pa.int64())], names=["sample_id", "prompt"])

    return asked.where("text is not null and text <> ''").select("sample_id", "text").mapInArrow(run, "sample_id bigint, prompt bigint")


def _vertex(kind: str, col: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), col.cast("string"))


def row_edges(sessions: DataFrame, tasks: DataFrame) -> DataFrame:
    """(sample_id, v): a row's spelling of its group, or where that is null the prompts in its first user message."""
    spelt = sessions.where("_group is not null").select("sample_id", _vertex("s", F.lower("_group")).alias("v"))
    users = F.filter("messages", lambda m: F.lower(F.trim(m["role"])) == "user")
    asked = sessions.where("_group is null and messages is not null").select("sample_id", squeezed(F.try_element_at(users, F.lit(1))["content"]).alias("text"))
    return spelt.unionByName(prompt_hits(asked, tasks).select("sample_id", _vertex("p", F.col("prompt")).alias("v")))


def entity_edges(spellings: DataFrame, tasks: DataFrame) -> DataFrame:
    """(v, w): what each spelling (v) names, a task or else a group key, and the tasks of each prompt."""
    known = tasks.select(_vertex("t", F.col("id")).alias("w"), plain_key(F.col("id")).alias("key")).where("key is not null").distinct()
    raw = spellings.where("v like 's:%'").select("v", F.expr("substr(v, 3)").alias("raw"))
    named = raw.select("v", task_key(F.col("raw")).alias("key")).where("key is not null").join(known, "key").select("v", "w")
    other = raw.select("v", plain_key(F.col("raw")).alias("key")).where("key is not null").join(named.select("v").distinct(), "v", "left_anti").select("v", _vertex("g", F.col("key")).alias("w"))
    prompts = tasks.where("id is not null and prompt is not null").select(_vertex("p", F.xxhash64(squeezed(F.col("prompt")))).alias("v"), _vertex("t", F.col("id")).alias("w"))
    return named.unionByName(other).unionByName(prompts.distinct())


def related_rows(sessions: DataFrame, tasks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, entities, labels): the edges of rows (sample_id, v) and of entities (v, w), and (vertex, component).

    Vertices are 'r:' rows, 's:' spellings, 'p:' prompts, 'g:' group keys and 't:' tasks.  Rows of no
    entity are in no edge."""
    rows = durable(row_edges(sessions, tasks))
    entities = durable(entity_edges(rows.select("v").distinct(), tasks))
    return rows, entities, components(rows.select(_vertex("r", F.col("sample_id")).alias("u"), "v").unionByName(entities.select(F.col("v").alias("u"), F.col("w").alias("v"))))


def row_tasks(rows: DataFrame, entities: DataFrame, labels: DataFrame) -> DataFrame:
    """(sample_id, task_id): a row belongs to the task of its component.

    Where prompts that rows share bring several tasks into one component, the row's own spelling or
    prompt, two edges away from its tasks, tells which of them are its own; no row meets all tasks."""
    labels = durable(labels)
    tasks = labels.where("vertex like 't:%'").groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min("vertex").alias("task"))
    mine = labels.where("vertex like 'r:%'").select(F.expr("cast(substr(vertex, 3) as bigint)").alias("sample_id"), "component").join(tasks, "component")
    own = entities.where("w like 't:%'").select("v", F.col("w").alias("task"))
    several = rows.join(mine.where("n > 1").select("sample_id"), "sample_id", "left_semi").join(own, "v").select("sample_id", "task")
    return mine.where("n = 1").select("sample_id", "task").unionByName(several).select("sample_id", F.expr("substr(task, 3)").alias("task_id")).distinct()


def task_links(sessions: DataFrame, tasks: DataFrame) -> DataFrame:
    """(sample_id, task_id): the group names the task, or the group is null and the first user message holds its prompt."""
    return row_tasks(*related_rows(sessions, tasks))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of sft_dataset with the task they belong to, by the components' labels."""
    return task_links(table(spark, sf_dir, "sft_dataset"), table(spark, sf_dir, "tasks"))


def _place(parts: pd.DataFrame) -> pd.DataFrame:
    """Places components, and hash bins of small ones, by the weight each split has gathered so far.

    parts: item, source, n, a row for each source of an item.  Items go one by one, the heaviest first, to
    the split that relatively lacks most of the rows of the item's own sources; so the proportions hold
    within sources as well, as far as whole components allow."""
    share = np.array([s for _, s in SPLITS])
    sources = {s: k for k, s in enumerate(sorted(parts["source"].unique()))}
    total = np.zeros(len(sources))
    np.add.at(total, parts["source"].map(sources).to_numpy(), parts["n"].to_numpy())
    want = np.outer(share, total)
    have = np.zeros_like(want)
    items = [(-g["n"].sum(), name, g["source"].map(sources).to_numpy(), g["n"].to_numpy()) for name, g in parts.groupby("item", sort=True)]
    out = []
    for _, name, at, n in sorted(items, key=lambda x: x[:2]):
        lack = (want[:, at] - have[:, at]) / np.maximum(want[:, at], 1e-9)
        pick = int(np.argmax((lack * n).sum(axis=1)))
        have[pick, at] += n
        out.append((name, SPLITS[pick][0]))
    return pd.DataFrame(out, columns=["item", "split"])


def split_assignments(sessions: DataFrame, tasks: DataFrame, seed: int = 11) -> DataFrame:
    """sample_id, source, component, split for every row.

    Components go by the source that most of their rows name, each source placed by itself.  One of a
    thousandth or more of its source is placed alone, smaller ones by hash bins.  Of other sources that its
    components touch, those of under a thousandth of the rows count as one.  So a task places at most a
    thousand components and ``BINS`` bins, whatever the number of components and sources."""
    _, _, labels = related_rows(sessions, tasks)
    mine = labels.where("vertex like 'r:%'").select(F.expr("cast(substr(vertex, 3) as bigint)").alias("sample_id"), "component")
    rows = sessions.select("sample_id", clean_label(F.col("source")).alias("source")).join(mine, "sample_id", "left").select("sample_id", "source", F.coalesce("component", F.concat(F.lit("r:"), F.col("sample_id").cast("string"))).alias("component"))
    rows = durable(rows)
    by_source = durable(rows.groupBy("component", "source").agg(F.count(F.lit(1)).alias("n")))
    whole = by_source.groupBy("component").agg(F.sum("n").alias("weight"), F.max_by("source", F.struct("n", "source")).alias("stratum"))
    totals = whole.groupBy("stratum").agg(F.sum("weight").alias("total"))
    lot = F.pmod(F.xxhash64("component", F.lit(seed)), F.lit(BINS)).cast("string")
    alone = F.col("weight") * 1000 >= F.col("total")
    sized = durable(whole.join(totals, "stratum").select("component", "stratum", "total", F.when(alone, F.concat(F.lit("c:"), "component")).otherwise(F.concat(F.lit("b:"), lot)).alias("item")))
    parts = by_source.join(sized, "component").groupBy("stratum", "total", "item", "source").agg(F.sum("n").alias("n"))
    shares = parts.groupBy("stratum", "source").agg(F.sum("n").alias("of_source"))
    few = F.when(F.col("of_source") * 1000 >= F.col("total"), F.col("source")).otherwise("")
    bounded = parts.join(shares, ["stratum", "source"]).groupBy("stratum", "item", few.alias("source")).agg(F.sum("n").alias("n"))

    def place(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return _place(part).assign(stratum=key[0])

    placed = durable(bounded.groupBy("stratum").applyInPandas(place, "stratum string, item string, split string"))
    return rows.join(sized.join(placed, ["stratum", "item"]).select("component", "split"), "component").select("sample_id", "source", "component", "split")


def p6_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_assignments(table(spark, sf_dir, "sft_dataset"), table(spark, sf_dir, "tasks"))


def p6_split_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and share of each split within each source."""
    s = p6_splits(spark, sf_dir).groupBy("source", "split").agg(F.count(F.lit(1)).alias("n_rows"))
    total = s.groupBy("source").agg(F.sum("n_rows").alias("of"))
    return s.join(total, "source").select("source", "split", "n_rows", F.round(F.col("n_rows") / F.col("of"), 4).alias("share"))


QUERIES = {"p6_found": p6_found, "p6_splits": p6_splits, "p6_split_shares": p6_split_shares}
