"""Array functions of the token and feature steps (P-23..25, W-17, one-hot, clip)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _starts_with(ids: Column, at: Column, marker: Column) -> Column:
    return F.slice(ids, at, F.size(marker)) == marker


def response_mask(ids: Column, response: Column, end: Column) -> Column:
    """1 for tokens of response spans: after a response marker through its end marker, or to the end.

    A fold carries whether a span is open and how many marker tokens are still to skip; empty markers
    open or close nothing."""
    n = F.size(ids)
    start = F.struct(F.array().cast("array<int>").alias("mask"), F.lit(False).alias("open"), F.lit(0).alias("skip"), F.lit(0).alias("tail"))

    def step(s, i):
        opens = ~s["open"] & (s["skip"] == 0) & (F.size(response) > 0) & _starts_with(ids, i, response)
        closes = s["open"] & (s["tail"] == 0) & (F.size(end) > 0) & _starts_with(ids, i, end)
        bit = F.when(s["open"] | (s["tail"] > 0), F.lit(1)).otherwise(F.lit(0))
        skip = F.when(opens, F.size(response) - 1).otherwise(F.greatest(s["skip"] - 1, F.lit(0)))
        tail = F.when(closes, F.size(end)).otherwise(s["tail"])
        tail_after = F.greatest(tail - 1, F.lit(0))
        is_open = F.when(closes & (tail_after == 0), False).when((tail > 0) & (tail_after == 0), False).when(opens & (F.size(response) == 1), True).when((s["skip"] == 1) & ~s["open"], True).otherwise(s["open"])
        return F.struct(F.concat(s["mask"], F.array(bit)).alias("mask"), is_open.alias("open"), skip.alias("skip"), tail_after.alias("tail"))

    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), n), start, step, lambda s: s["mask"])).otherwise(F.array().cast("array<int>"))


def labels(ids: Column, mask: Column) -> Column:
    """The id where the mask is set, else -100 (P-24)."""
    return F.zip_with(ids, mask, lambda i, m: F.when(m == 1, i).otherwise(F.lit(-100)))


def mask_spans(mask: Column) -> Column:
    """Number of runs of ones (W-17)."""
    return F.aggregate(mask, F.struct(F.lit(0).alias("n"), F.lit(0).alias("was")), lambda s, m: F.struct((s["n"] + F.when((m == 1) & (s["was"] == 0), 1).otherwise(0)).alias("n"), m.cast("int").alias("was")), lambda s: s["n"])


def pad_batches(df: DataFrame, batch: str, arrays: dict[str, int], left: bool = False) -> DataFrame:
    """Each array column padded with its own value to the widest of its batch (P-25)."""
    first = next(iter(arrays))
    wide = df.withColumn("__width", F.max(F.size(first)).over(Window.partitionBy(batch)))
    for name, pad in arrays.items():
        fill = F.array_repeat(F.lit(pad), F.col("__width") - F.size(name))
        wide = wide.withColumn(name, F.concat(fill, F.col(name)) if left else F.concat(F.col(name), fill))
    return wide.drop("__width")


def one_hot(col: Column, values: list) -> Column:
    """1 at the place of the value in ``values``, else 0; null and unknown values give zeros."""
    return F.array(*[F.coalesce(F.when(col == F.lit(v), 1), F.lit(0)) for v in values])


def clip(col: Column, low: float, high: float) -> Column:
    return F.when(col.isNull(), None).otherwise(F.least(F.greatest(col, F.lit(low)), F.lit(high)))


def merge_maps(*maps: Column) -> Column:
    """Later maps win; nulls are skipped (needs spark.sql.mapKeyDedupPolicy=LAST_WIN only without overlap checks)."""
    entries = F.concat(*[F.coalesce(F.map_entries(m), F.array().cast("array<struct<key:string,value:string>>")) for m in maps])
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]))
