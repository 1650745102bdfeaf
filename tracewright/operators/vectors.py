"""Cosine similarity of embeddings (the semantic form of the near-duplicate step)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null if one is null or has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))


def cosine_to_queries(df: DataFrame, key: str, vector: str, block: str | None, every: int) -> DataFrame:
    """(a, b, cosine) with a < b of the query rows, those whose key ``every`` divides, against all rows of
    their block, or without a block against all rows.  The stated query set bounds one side."""
    rows = df.select(F.col(key).alias("k"), F.col(vector).alias("v"), (F.col(block) if block else F.lit(0)).alias("block"))
    queries = rows.where(F.col("k") % every == 0)
    q, r = queries.select(F.col("k").alias("qk"), F.col("v").alias("qv"), "block"), rows
    pairs = (q.join(r, "block") if block else q.drop("block").crossJoin(r)).where(F.col("qk") != F.col("k"))
    both = pairs.select(F.least("qk", "k").alias("a"), F.greatest("qk", "k").alias("b"), F.round(cosine(F.col("qv"), F.col("v")), 5).alias("cosine"))
    return both.dropDuplicates(["a", "b"])
