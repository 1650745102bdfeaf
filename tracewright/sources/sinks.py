"""Writers (K-1..K-8, K-10, K-11): JSON lines without internal columns, splits, upserts, verbatim copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def public_columns(df: DataFrame) -> list[str]:
    """Columns whose names do not begin with an underscore."""
    return [c for c in df.columns if not c.startswith("_")]


def as_json_line(df: DataFrame) -> Column:
    return F.to_json(F.struct(*public_columns(df)), {"ignoreNullFields": "false"})


def write_jsonl(df: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON object a line, nulls kept, internal columns dropped (K-1, K-11)."""
    df.select(as_json_line(df).alias("value")).write.mode(mode).text(path)


def write_splits(df: DataFrame, path: str, split: str = "_split") -> list[str]:
    """train and, only if it has rows, eval (K-2); returns the folders written."""
    held = df.where(F.col(split) == "eval")
    write_jsonl(df.where(F.coalesce(F.col(split), F.lit("train")) != "eval"), f"{path}/train")
    if held.isEmpty():
        return [f"{path}/train"]
    write_jsonl(held, f"{path}/eval")
    return [f"{path}/train", f"{path}/eval"]


def write_traces(df: DataFrame, path: str) -> None:
    """Trace records of a (micro-)batch appended as JSON (K-3); use it in foreachBatch."""
    df.write.mode("append").json(path)


def tag_traces(traces: DataFrame, tasks: DataFrame, stamp: str, width: int = 3600) -> DataFrame:
    """Traces with the replay tag of the task whose span holds their stamp (K-4, J-10); tagged ones stay.

    tasks: task_id, start, end in the unit of the stamp.  Of several tasks the one that began last."""
    b = F.floor(F.col(stamp) / width)
    open_ = traces.where("replay is null").withColumn("__b", b)
    spans = tasks.withColumn("__b", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))))
    hit = open_.join(spans, "__b").where(F.col(stamp).between(F.col("start"), F.col("end"))).groupBy("record_id").agg(F.max_by("task_id", F.struct("start", "task_id")).alias("__task"))
    return traces.join(hit, "record_id", "left").withColumn("replay_task", F.coalesce(F.col("replay.task_id"), F.col("__task"))).drop("__task")


def upsert(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The table with changed rows replaced and new ones added (K-5)."""
    return table.join(changes.select(key), key, "left_anti").unionByName(changes, allowMissingColumns=True)


def append_results(df: DataFrame, path: str) -> None:
    """Results appended; a reader resumes by the ids already there (K-6)."""
    df.write.mode("append").json(path)


def write_clean(df: DataFrame, path: str, raw: str = "_raw") -> None:
    """The surviving lines as they were read (K-7)."""
    df.select(F.col(raw).alias("value")).write.mode("overwrite").text(path)


def distilled(failed: DataFrame) -> DataFrame:
    """Failed knowledge tasks as conversations of their references (K-8): rows (task_id, turns of prompt and reference)."""
    pair = lambda t: F.array(F.struct(F.lit("user").alias("role"), t["prompt"].alias("content")), F.struct(F.lit("assistant").alias("role"), t["reference"].alias("content")))
    return failed.where("type = 'knowledge' and not passed").select("task_id", F.flatten(F.transform("turns", pair)).alias("messages"), F.lit("distill").alias("source"))


def export(sessions: DataFrame, ids: list[str] | None, keep: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines, summary) of an export (K-10, A-15): the summary counts before ``keep`` filters."""
    chosen = sessions if ids is None else sessions.where(F.col("id").isin(ids))
    tokens = sum((F.coalesce(F.col(c), F.lit(0)) for c in ("tokens_input", "tokens_output", "tokens_reasoning")), F.lit(0))
    summary = chosen.agg(F.count(F.lit(1)).alias("n"), F.sum(tokens).alias("tokens"), F.array_sort(F.collect_set("model")).alias("models"))
    kept = chosen if keep is None else chosen.where(keep)
    return kept.select(as_json_line(kept).alias("value")), summary


def manifest(df: DataFrame) -> DataFrame:
    """Lines and bytes of what write_jsonl would write (K-9 without the upload)."""
    line = as_json_line(df)
    return df.select(F.octet_length(line).alias("b")).agg(F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum("b") + F.count(F.lit(1)), F.lit(0)).alias("bytes"))
