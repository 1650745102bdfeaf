"""Problem 8: mixing sources to target weights by capped water-filling.

Sizes are tokens of a public tokenizer.  Sources are clamped at their maximum epochs, the weight they
cannot carry is redistributed over the others in proportion, until all is feasible.  A source's
repetitions have a whole part, which every record gets, and a fraction, which goes to the records of
lowest seeded hash: a histogram of the hash finds the bin in which the wanted token sum is reached, and
only that bin's records are ranked, so no task ever ranks a whole source.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.llm.tokens import VOCABULARY, with_token_counts
from tracewright.session import bounded_collect, clean_label, durable, table

BINS = 4096
MAX_SOURCES = 100_000


def water_fill(tokens: list[float], shares: list[float], caps: list[float], total: float) -> list[float]:
    """Tokens to take of each source: shares of ``total``, none above tokens * cap.

    The excess of clamped sources goes to the free ones in proportion to their shares, again until no
    source is above its cap.  If all are clamped, less than ``total`` is taken."""
    take = [0.0] * len(tokens)
    limit = [t * c for t, c in zip(tokens, caps)]
    free = [k for k in range(len(tokens)) if shares[k] > 0 and limit[k] > 0]
    left = total
    while free and left > 0:
        weight = sum(shares[k] for k in free)
        over = [k for k in free if left * shares[k] / weight >= limit[k]]
        if not over:
            for k in free:
                take[k] = left * shares[k] / weight
            break
        for k in over:
            take[k] = limit[k]
        left -= sum(limit[k] for k in over)
        free = [k for k in free if k not in set(over)]
    return take


def plan(sized: DataFrame, targets: DataFrame, total: float | None = None) -> pd.DataFrame:
    """One row a target source: tokens available, wanted share, tokens to take, repetitions.

    ``total`` defaults to the tokens that the target sources hold.  Sources that no target names are
    not drawn; a target without records takes nothing.  A null share counts as 0, a null cap as 1."""
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("available"))
    wanted = targets.select(clean_label(F.col("source")).alias("source"), F.coalesce(F.col("target_share").cast("double"), F.lit(0.0)).alias("target_share"), F.coalesce(F.col("max_repeats").cast("double"), F.lit(1.0)).alias("cap"))
    wanted = wanted.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("cap").alias("cap"))
    rows = bounded_collect(wanted.join(have, "source", "left").select("source", "target_share", "cap", F.coalesce("available", F.lit(0)).alias("available")), MAX_SOURCES, "mixture sources")
    frame = pd.DataFrame([r.asDict() for r in rows], columns=["source", "target_share", "cap", "available"]).sort_values("source", ignore_index=True)
    goal = float(frame["available"].sum()) if total is None else float(total)
    frame["take"] = water_fill(frame["available"].astype(float).tolist(), frame["target_share"].tolist(), frame["cap"].tolist(), goal)
    frame["repeats"] = [t / a if a else 0.0 for t, a in zip(frame["take"], frame["available"])]
    return frame


def sized_documents(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, source (clean), n_tokens."""
    return with_token_counts(documents.select("doc_id", clean_label(F.col("source")).alias("source"), "text"), "text", ["doc_id", "source"], vocabulary)


def draw(sized: DataFrame, mixture: pd.DataFrame, seed: int = 3) -> DataFrame:
    """doc_id, source, n_tokens, copies (1 or more) of the drawn records.

    The fraction of a source ends with the record whose tokens bring the running sum nearest below its
    goal, in the order of the seeded hash and then the id; repeated runs draw the same records."""
    spark = sized.sparkSession
    goals = spark.createDataFrame([(r.source, int(r.repeats), (r.repeats - int(r.repeats)) * r.available) for r in mixture.itertuples()], "source string, whole int, goal double")
    lot = F.xxhash64("doc_id", F.lit(seed))
    rows = sized.join(F.broadcast(goals), "source").withColumn("lot", lot).withColumn("bin", F.pmod(F.shiftright("lot", 16), F.lit(BINS)).cast("int"))
    histogram = rows.groupBy("source", "bin").agg(F.sum("n_tokens").alias("n"), F.first("goal").alias("goal"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = histogram.withColumn("before", before).where("before <= goal and before + n > goal").select("source", F.col("bin").alias("edge"), "before")
    marked = rows.join(F.broadcast(edge), "source", "left")  # a row for each source
    settled = marked.where("edge is null or bin <> edge").withColumn("extra", F.when(F.col("goal") <= 0, 0).when(F.col("edge").isNull(), 1).when(F.col("bin") < F.col("edge"), 1).otherwise(0))
    running = F.sum("n_tokens").over(Window.partitionBy("source").orderBy("lot", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    ranked = marked.where("bin = edge").withColumn("upto", running).withColumn("extra", F.when((F.col("goal") > 0) & (F.col("before") + F.col("upto") <= F.col("goal")), 1).otherwise(0)).drop("upto")
    both = settled.unionByName(ranked)
    return both.select("doc_id", "source", "n_tokens", (F.col("whole") + F.col("extra")).alias("copies")).where("copies > 0")


def p8_mixture_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each target source: tokens available and drawn, repetitions, wanted and reached share."""
    sized = durable(sized_documents(table(spark, sf_dir, "documents")))
    mixture = plan(sized, table(spark, sf_dir, "mix_targets"))
    drawn = draw(sized, mixture).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("drawn"), F.max("copies").alias("most_copies"), F.count(F.lit(1)).alias("n_records"))
    base = spark.createDataFrame(mixture, "source string, target_share double, cap double, available bigint, take double, repeats double") if len(mixture) else spark.createDataFrame([], "source string, target_share double, cap double, available bigint, take double, repeats double")
    full = base.join(drawn, "source", "left")
    full = full.withColumn("total", F.sum("drawn").over(Window.partitionBy()))  # a row for each source
    return full.select("source", "target_share", "cap", "available", F.coalesce("n_records", F.lit(0)).alias("n_records"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.round("repeats", 6).alias("repeats"), F.coalesce("drawn", F.lit(0)).alias("drawn_tokens"), F.round(F.coalesce(F.col("drawn") / F.col("total"), F.lit(0.0)), 6).alias("reached_share"))


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn records with their copies."""
    sized = durable(sized_documents(table(spark, sf_dir, "documents")))
    return draw(sized, plan(sized, table(spark, sf_dir, "mix_targets")))


QUERIES = {"p8_mixture": p8_mixture, "p8_mixture_report": p8_mixture_report}
