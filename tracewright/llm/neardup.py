"""Problem 3: near-duplicate records with small edits.

Records of equal run sets collapse to one representative first, so a group of exact copies costs one
sketch.  Representatives are banded on compressed HyperMinHash registers, candidate pairs pass a
collision-corrected Jaccard estimate (its threshold lies five standard errors below the wanted
similarity, and sets smaller than the sketch skip it), and every survivor is verified exactly on the
sets of word runs.  No bucket is capped: buckets join as rows, and adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm.hyperminhash import WordHasher, band_keys, jaccard_estimate, registers, runs
from tracewright.session import durable, table

SKETCH = 128
BAND_ROWS = 4


def session_text(messages: Column) -> Column:
    """Non-empty contents of user and assistant messages in order, joined by a blank."""
    kept = F.filter(messages, lambda m: F.lower(F.trim(m["role"])).isin("user", "assistant") & m["content"].isNotNull() & (m["content"] != ""))
    return F.array_join(F.transform(kept, lambda m: m["content"]), " ")


def both_session_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec_id and messages of sft_dataset and synthetic_conversations; their ids never overlap."""
    return (
        table(spark, sf_dir, "sft_dataset")
        .select(F.col("sample_id").alias("rec_id"), "messages")
        .unionByName(table(spark, sf_dir, "synthetic_conversations").select(F.col("conv_id").alias("rec_id"), "messages"))
    )


def _signatures(records: DataFrame, words: int, k: int) -> DataFrame:
    """rec_id, a 128-bit name of the run set, its size and registers; sets without a run are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            ids, h1, h2, size, regs = [], [], [], [], []
            for rec, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = runs(hasher(text.lower().split()), words) if text else ()
                if rec is None or not len(s):
                    continue
                ids.append(rec)
                h1.append(int(np.bitwise_xor.reduce(s).view(np.int64)))
                h2.append(int(np.add.reduce(s * np.uint64(0x9E3779B97F4A7C15) ^ (s >> np.uint64(7))).view(np.int64)))
                size.append(len(s))
                regs.append(registers(s, k).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(size, pa.int32()), pa.array(regs, pa.binary())], names=["rec_id", "h1", "h2", "n", "regs"])

    return records.select(F.col("rec_id").cast("bigint"), "text").mapInArrow(run, "rec_id bigint, h1 bigint, h2 bigint, n int, regs binary")


def _bands(reps: DataFrame, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, regs = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            if not len(ids):
                continue
            keys = [band_keys(np.frombuffer(r, dtype=np.uint16), rows) for r in regs]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, [len(x) for x in keys])), pa.array(np.concatenate(keys))], names=["rep", "band"])

    return reps.select("rep", "regs").mapInArrow(run, "rep bigint, band bigint")


def _likely(pairs: DataFrame, least: float) -> DataFrame:
    """Drops candidate pairs whose corrected estimate lies below ``least``; sets smaller than the
    sketch repeat registers, so their estimates are wide and they go on to verification unseen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a = np.stack([np.frombuffer(r, dtype=np.uint16) for r in batch.column(4).to_pylist()])
            b = np.stack([np.frombuffer(r, dtype=np.uint16) for r in batch.column(5).to_pylist()])
            n_a, n_b = batch.column(2).to_numpy().astype(float), batch.column(3).to_numpy().astype(float)
            keep = (jaccard_estimate(a, b, n_a, n_b) >= least) | (np.minimum(n_a, n_b) < a.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return pairs.mapInArrow(run, "a bigint, b bigint")


def _verify(pairs: DataFrame, words: int, threshold: float) -> DataFrame:
    """Exact Jaccard of the two texts' run sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        held: dict[str, np.ndarray] = {}

        def of(text: str) -> np.ndarray:
            if len(held) > 256:
                held.clear()
            if text not in held:
                held[text] = runs(hasher(text.lower().split()), words)
            return held[text]

        for batch in batches:
            score = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = of(x), of(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                score.append(both / (len(x) + len(y) - both))
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64())], names=["a", "b", "jaccard"])
            yield out.filter(pa.array([s >= threshold for s in score], pa.bool_()))

    return pairs.mapInArrow(run, "a bigint, b bigint, jaccard double")


def near_duplicates(records: DataFrame, words: int = 5, threshold: float = 0.8, sketch: int = SKETCH, band_rows: int = BAND_ROWS) -> tuple[DataFrame, DataFrame]:
    """(members, links) of the records (rec_id, text).

    members: rec_id, rep; records of equal run sets share the rep, the smallest id among them.
    links: a < b, jaccard; pairs of representatives of similarity ``threshold`` or more.
    Null and blank texts, and texts shorter than ``words`` words, have no run and are in neither.
    Equal rows give one member.  An empty table gives empty results.
    """
    records = records.select("rec_id", "text")
    signed = durable(_signatures(records, words, sketch))
    same = ["h1", "h2", "n"]
    reps = signed.groupBy(*same).agg(F.min("rec_id").alias("rep"), F.min_by("regs", "rec_id").alias("regs"))
    reps = durable(reps)
    members = signed.select("rec_id", *same).join(reps.select(*same, "rep"), same).select("rec_id", "rep").distinct()
    bands = _bands(reps, band_rows)
    other = bands.select(F.col("rep").alias("b"), "band")
    candidates = bands.withColumnRenamed("rep", "a").join(other, "band").where("a < b").select("a", "b").distinct()
    left = reps.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("regs").alias("regs_a"))
    right = reps.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("regs").alias("regs_b"))
    sized = candidates.join(left, "a").join(right, "b").where(F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b"))
    margin = 5 * (threshold * (1 - threshold) / sketch) ** 0.5
    likely = durable(_likely(sized.select("a", "b", "n_a", "n_b", "regs_a", "regs_b"), max(0.0, threshold - margin)))
    wanted = likely.select(F.explode(F.array("a", "b")).alias("rec_id")).distinct()
    texts = records.dropDuplicates(["rec_id"]).join(wanted, "rec_id", "left_semi")
    named = likely.join(texts.select(F.col("rec_id").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("rec_id").alias("b"), F.col("text").alias("text_b")), "b")
    links = _verify(named.select("a", "b", "text_a", "text_b"), words, threshold)
    return members, links


def expand(members: DataFrame, links: DataFrame) -> DataFrame:
    """All pairs rec_a < rec_b that the links and the classes of equal sets stand for."""
    a = members.select(F.col("rec_id").alias("x"), F.col("rep").alias("a"))
    b = members.select(F.col("rec_id").alias("y"), F.col("rep").alias("b"))
    across = links.select("a", "b").join(a, "a").join(b, "b").select("x", "y")
    within = a.join(b.withColumnRenamed("b", "a"), "a").where("x < y").select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("rec_a"), F.greatest("x", "y").alias("rec_b"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return both_session_tables(spark, sf_dir).select("rec_id", session_text(F.col("messages")).alias("text"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of sessions alike in at least 0.7 of their three-word runs."""
    members, links = near_duplicates(_records(spark, sf_dir), words=3, threshold=0.7)
    return expand(durable(members), durable(links)).distinct()


def classes(records: DataFrame, words: int, threshold: float) -> DataFrame:
    """rec_id, class_id, n_links: one row for each record with a text; classes are components of the links
    between different texts, n_links counts those of the record's own."""
    from tracewright.llm.components import components

    members, links = near_duplicates(records, words, threshold)
    links = durable(links)
    labels = components(links.select(F.col("a").cast("string").alias("u"), F.col("b").cast("string").alias("v")))
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    label = labels.select(F.col("vertex").cast("bigint").alias("rep"), F.col("component").cast("bigint").alias("class_id"))
    return members.join(label, "rep", "left").join(degree, "rep", "left").select("rec_id", F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of sessions alike in at least 0.8 of their five-word runs."""
    return classes(_records(spark, sf_dir), words=5, threshold=0.8)


def p3_found_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes at the settings of p3_found, three-word runs and 0.7; the form without all pairs of copies."""
    return classes(_records(spark, sf_dir), words=3, threshold=0.7)


QUERIES = {"p3_found": p3_found, "p3_classes": p3_classes, "p3_found_classes": p3_found_classes}
