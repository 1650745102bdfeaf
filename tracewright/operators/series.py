"""Number series in long form (key, idx, value) and their stages (W-8..W-11, A-20, X-1)."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.session import with_previous, with_running_sum


def _w(key: str, idx: str):
    return Window.partitionBy(key).orderBy(idx)


def rolling(df: DataFrame, key: str, idx: str, value: str, width: int, how: str = "mean") -> DataFrame:
    """Trailing mean or maximum over up to ``width`` values (W-8)."""
    if width < 1:
        raise ValueError("width must be 1 or more")
    fn = {"mean": F.avg, "max": F.max}[how]
    return df.withColumn(value, fn(value).over(_w(key, idx).rowsBetween(-(width - 1), 0)))


def cumsum(df: DataFrame, key: str, idx: str, value: str) -> DataFrame:
    """Sums up to each value (W-9)."""
    return with_running_sum(df, key, [idx], F.col(value), value)


def diff(df: DataFrame, key: str, idx: str, value: str) -> DataFrame:
    """Differences of neighbours; the first row of each key goes (W-9)."""
    seen = with_previous(df, key, [idx], {"__before": F.struct(F.col(value).alias("v"))})
    return seen.where("__before is not null").withColumn(value, F.col(value) - F.col("__before.v")).drop("__before")


def ewma(df: DataFrame, key: str, idx: str, value: str, alpha: float) -> DataFrame:
    """Exponentially weighted mean (W-10): e0 = x0, e = alpha*x + (1-alpha)*e.

    With t = row number, e_t = (1-alpha)^t * (x0 + sum of alpha*x_k*(1-alpha)^-k).  To keep the powers in
    range the sum is taken over blocks of rows and carried from block to block: two window passes, no
    gathered array."""
    if not 0 < alpha <= 1:
        raise ValueError("alpha must lie in (0, 1]")
    if alpha == 1:
        return df
    import math

    block = max(1, min(256, int(-200 / math.log10(1 - alpha)))) if alpha < 1 else 1
    keep = 1 - alpha
    w = _w(key, idx)
    r = df.withColumn("__t", F.row_number().over(w) - 1).withColumn("__b", F.floor(F.col("__t") / block)).withColumn("__k", F.col("__t") % block)
    gain = F.when(F.col("__t") == 0, F.lit(1.0)).otherwise(F.lit(alpha))
    inside = F.sum(gain * F.col(value) * F.pow(F.lit(keep), -F.col("__k"))).over(Window.partitionBy(key, "__b").orderBy("__k").rowsBetween(Window.unboundedPreceding, 0)) * F.pow(F.lit(keep), F.col("__k"))
    r = r.withColumn("__in", inside)
    ends = r.groupBy(key, "__b").agg(F.max_by("__in", "__k").alias("__end"), F.count(F.lit(1)).alias("__n"))
    carried = ends.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__b", "__end", "__n"))).alias("__e"))  # one entry a block
    step = lambda s, e: F.struct((e["__end"] + s["c"] * F.pow(F.lit(keep), e["__n"])).alias("c"), F.concat(s["out"], F.array(F.struct(e["__b"].alias("__b"), s["c"].alias("__carry")))).alias("out"))
    start = F.struct(F.lit(0.0).alias("c"), F.array().cast("array<struct<__b:bigint,__carry:double>>").alias("out"))
    carries = carried.select(key, F.explode(F.aggregate("__e", start, step, lambda s: s["out"])).alias("x")).select(key, "x.*")
    out = r.join(carries, [key, "__b"]).withColumn(value, F.col("__in") + F.col("__carry") * F.pow(F.lit(keep), F.col("__k") + 1))
    return out.select(*df.columns)


def minmax(df: DataFrame, key: str, idx: str, value: str) -> DataFrame:
    """Values scaled to 0..1 in their key; a constant series gives 0 (W-11)."""
    w = Window.partitionBy(key)
    low, high = F.min(value).over(w), F.max(value).over(w)
    return df.withColumn(value, F.when(high == low, 0.0).otherwise((F.col(value) - low) / (high - low)))


def clip(df: DataFrame, key: str, idx: str, value: str, low: float, high: float) -> DataFrame:
    return df.withColumn(value, F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def describe(df: DataFrame, key: str, value: str) -> DataFrame:
    """count, mean, sample deviation, min, max (A-20)."""
    r = lambda c, n: F.round(c, 6).alias(n)
    return df.groupBy(key).agg(F.count(value).alias("count"), r(F.avg(value), "mean"), r(F.stddev_samp(value), "std"), F.min(value).alias("min"), F.max(value).alias("max"))


def outliers(df: DataFrame, key: str, value: str, threshold: float = 3.0) -> DataFrame:
    """Rows more than ``threshold`` sample deviations from the mean; none where there are fewer than two or no spread."""
    w = Window.partitionBy(key)
    z = df.withColumn("__m", F.avg(value).over(w)).withColumn("__s", F.stddev_samp(value).over(w))
    return z.where((F.col("__s") > 0) & (F.abs((F.col(value) - F.col("__m")) / F.col("__s")) > threshold)).drop("__m", "__s")


#: Stages by name, each with the parameters it takes (X-1).
STAGES: dict[str, tuple[Callable, frozenset[str]]] = {
    "smooth": (lambda df, k, i, v, width: rolling(df, k, i, v, width), frozenset({"width"})),
    "rolling_max": (lambda df, k, i, v, width: rolling(df, k, i, v, width, "max"), frozenset({"width"})),
    "ewma": (ewma, frozenset({"alpha"})),
    "scale": (minmax, frozenset()),
    "clip": (clip, frozenset({"low", "high"})),
    "diff": (diff, frozenset()),
    "cumsum": (cumsum, frozenset()),
}


def pipeline(df: DataFrame, config: str | list, key: str, idx: str, value: str) -> DataFrame:
    """Runs configured stages in order; unknown stages and wrong parameters are errors before any data is read."""
    stages = json.loads(config) if isinstance(config, str) else config
    for s in stages:
        name, given = s.get("stage"), set(s) - {"stage"}
        if name not in STAGES:
            raise ValueError(f"unknown stage: {name}")
        if given != STAGES[name][1]:
            raise ValueError(f"stage {name} takes {sorted(STAGES[name][1])}, not {sorted(given)}")
    for s in stages:
        df = STAGES[s["stage"]][0](df, key, idx, value, **{k: v for k, v in s.items() if k != "stage"})
    return df
