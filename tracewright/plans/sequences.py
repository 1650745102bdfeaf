"""Queries on number series and streams' batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.functions import arrays as A
from tracewright.operators import series as S
from tracewright.plans.contract import query
from tracewright.session import table
from tracewright.streaming import streams as R

_BASE = "WITH b AS (SELECT user_id, event_id, value FROM events)"
_W = "(PARTITION BY user_id ORDER BY event_id"


def _base(s, d):
    return table(s, d, "events").select("user_id", "event_id", "value")


def _rounded(df):
    return df.select("user_id", "event_id", F.round("value", 4).alias("value"))


def _three(df):
    return df.select("user_id", "event_id", F.round("value", 3).alias("value"))


@query("rolling_mean_3", _BASE + f" SELECT user_id, event_id, round(avg(value) OVER {_W} ROWS 2 PRECEDING), 4) AS value FROM b")
def rolling_mean_3(s, d):
    return _rounded(S.rolling(_base(s, d), "user_id", "event_id", "value", 3))


@query("rolling_max_3", _BASE + f" SELECT user_id, event_id, round(max(value) OVER {_W} ROWS 2 PRECEDING), 4) AS value FROM b")
def rolling_max_3(s, d):
    return _rounded(S.rolling(_base(s, d), "user_id", "event_id", "value", 3, "max"))


@query("cumsum", _BASE + f" SELECT user_id, event_id, round(sum(value) OVER {_W} ROWS UNBOUNDED PRECEDING), 3) AS value FROM b")
def cumsum(s, d):
    return S.cumsum(_base(s, d), "user_id", "event_id", "value").select("user_id", "event_id", F.round("value", 3).alias("value"))


@query("diff", _BASE + f" SELECT * FROM (SELECT user_id, event_id, round(value - lag(value) OVER {_W}), 4) AS value, row_number() OVER {_W}) AS n FROM b) WHERE n > 1".replace("SELECT * FROM", "SELECT user_id, event_id, value FROM"))
def diff(s, d):
    return _rounded(S.diff(_base(s, d), "user_id", "event_id", "value"))


@query("ewma", """WITH RECURSIVE b AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events), e AS (SELECT user_id, event_id, k, value AS v FROM b WHERE k = 1 UNION ALL SELECT b.user_id, b.event_id, b.k, b.value / 3 + e.v * 2 / 3 FROM e JOIN b ON b.user_id = e.user_id AND b.k = e.k + 1) SELECT user_id, event_id, round(v, 4) AS value FROM e""")
def ewma(s, d):
    return _rounded(S.ewma(_base(s, d), "user_id", "event_id", "value", 1 / 3))


@query("clip", _BASE + " SELECT user_id, event_id, round(least(greatest(value, 10), 50), 4) AS value FROM b")
def clip(s, d):
    return _rounded(S.clip(_base(s, d), "user_id", "event_id", "value", 10.0, 50.0))


@query("minmax_scale", _BASE + " SELECT user_id, event_id, round(CASE WHEN max(value) OVER w = min(value) OVER w THEN 0.0 ELSE (value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w) END, 4) AS value FROM b WINDOW w AS (PARTITION BY user_id)")
def minmax_scale(s, d):
    return _rounded(S.minmax(_base(s, d), "user_id", "event_id", "value"))


@query("zscore_outliers", _BASE + ", z AS (SELECT *, avg(value) OVER (PARTITION BY user_id) AS m, stddev_samp(value) OVER (PARTITION BY user_id) AS s FROM b) SELECT user_id, event_id, round(value, 4) AS value FROM z WHERE s > 0 AND abs((value - m) / s) > 2.5")
def zscore_outliers(s, d):
    return _rounded(S.outliers(_base(s, d), "user_id", "value", 2.5))


@query("describe", _BASE + " SELECT user_id, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max FROM b GROUP BY 1")
def describe(s, d):
    return S.describe(_base(s, d), "user_id", "value")


@query("one_hot", "SELECT event_id, [CASE WHEN event_type = 'click' THEN 1 ELSE 0 END, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END]::VARCHAR AS hot FROM events")
def one_hot(s, d):
    hot = A.one_hot(F.col("event_type"), ["click", "signup", "error"])
    return table(s, d, "events").select("event_id", F.concat(F.lit("["), F.array_join(F.transform(hot, lambda x: x.cast("string")), ", "), F.lit("]")).alias("hot"))


@query("stage_pipeline", _BASE + f", c AS (SELECT user_id, event_id, least(greatest(value, 0), 80) AS v FROM b), r AS (SELECT user_id, event_id, avg(v) OVER {_W} ROWS 4 PRECEDING) AS v FROM c), d AS (SELECT user_id, event_id, v - lag(v) OVER {_W}) AS v, row_number() OVER {_W}) AS n FROM r) SELECT user_id, event_id, round(v, 3) AS value FROM d WHERE n > 1")
def stage_pipeline(s, d):
    return _three(S.pipeline(_base(s, d), [{"stage": "clip", "low": 0.0, "high": 80.0}, {"stage": "smooth", "width": 5}, {"stage": "diff"}], "user_id", "event_id", "value"))


@query("token_bucket", None)
def token_bucket(s, d):
    e = table(s, d, "events")
    requests = e.select(F.col("user_id").cast("string").alias("key"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("ts"), F.lit(1.0).alias("cost"))
    return R.token_bucket(requests, 2.0, 1 / 3600).groupBy("key").agg(F.count_if("granted").alias("granted"), F.count(F.lit(1)).alias("n"))


@query("dispatch_counts", "SELECT event_type AS kind, count(*) FILTER (value <= 50) AS accepted, count(*) FILTER (NOT value <= 50) AS rejected FROM events GROUP BY 1")
def dispatch_counts(s, d):
    e = table(s, d, "events").select(F.col("event_type").alias("kind"), F.col("value").alias("amount"), F.lit(None).cast("int").alias("ttl"))
    kinds = {k: 50.0 for k in ("click", "view", "purchase", "signup", "error", "login", "logout", "search", "heartbeat")}
    return R.dispatch_counts(R.dispatch(e, kinds))


@query("windowed_sessions", """WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= 1800000000 THEN 1 ELSE 0 END AS gap FROM events),
n AS (SELECT *, sum(gap) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS no FROM g) SELECT user_id, min(epoch_us(ts)) AS start, count(*) AS n_events FROM n GROUP BY user_id, no""")
def windowed_sessions(s, d):
    out = R.sessions(table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts")
    return out.select("user_id", F.unix_micros("start").alias("start"), "n_events")
