"""Queries on corpora: decontamination, dedupe, balance, splits, sets, joins of the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.functions import text as X
from tracewright.operators import curate as C
from tracewright.operators import messages as M
from tracewright.plans.contract import query
from tracewright.session import table

_NORM = "trim(regexp_replace(lower({0}), '\\s+', ' ', 'g'))"
_GRAMS = """SELECT {key}, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(list_slice(w, i, i + 12), ' '))) AS g FROM (SELECT {key}, string_split(""" + _NORM.format("text") + """, ' ') AS w FROM {t} WHERE text IS NOT NULL) WHERE len(w) >= 13"""


@query("decontam_13gram", "WITH b AS (SELECT DISTINCT g FROM (" + _GRAMS.format(key="item_id", t="eval_items") + ")), d AS (" + _GRAMS.format(key="doc_id", t="documents") + ") SELECT DISTINCT doc_id FROM d SEMI JOIN b USING (g)")
def decontam_13gram(s, d):
    return C.contaminated(table(s, d, "documents"), "doc_id", "text", table(s, d, "eval_items"), "text")


@query("decontam_by_source", "WITH b AS (SELECT DISTINCT g FROM (" + _GRAMS.format(key="item_id", t="eval_items") + ")), d AS (" + _GRAMS.format(key="doc_id", t="documents") + "), c AS (SELECT DISTINCT doc_id FROM d SEMI JOIN b USING (g)) SELECT coalesce(nullif(lower(trim(source)), ''), 'unknown') AS source, count(*) AS total, count(c.doc_id) AS contaminated FROM documents LEFT JOIN c USING (doc_id) GROUP BY 1")
def decontam_by_source(s, d):
    from tracewright.session import clean_label

    docs = table(s, d, "documents")
    hits = C.contaminated(docs, "doc_id", "text", table(s, d, "eval_items"), "text").withColumn("hit", F.lit(1))
    return docs.select("doc_id", clean_label(F.col("source")).alias("source")).join(hits, "doc_id", "left").groupBy("source").agg(F.count(F.lit(1)).alias("total"), F.count("hit").alias("contaminated"))


def _markers(s):
    return s.createDataFrame([("cache", 0, "cache_report"), ("cache", 1, "flaky cache"), ("errors", 0, "KeyError"), ("errors", 1, "OSError"), ("log", 0, "traceback")], "problem string, pos int, marker string")


@query("marker_scan", """SELECT doc_id, 'cache' AS problem, CASE WHEN contains(lower(text), 'cache_report') THEN 'cache_report' ELSE 'flaky cache' END AS marker FROM documents WHERE contains(lower(text), 'cache_report') OR contains(lower(text), 'flaky cache')
UNION ALL SELECT doc_id, 'errors', CASE WHEN contains(lower(text), 'keyerror') THEN 'KeyError' ELSE 'OSError' END FROM documents WHERE contains(lower(text), 'keyerror') OR contains(lower(text), 'oserror')
UNION ALL SELECT doc_id, 'log', 'traceback' FROM documents WHERE contains(lower(text), 'traceback')""")
def marker_scan(s, d):
    return C.marker_hits(table(s, d, "documents"), "doc_id", "text", _markers(s))


@query("exact_dedupe", "SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY text")
def exact_dedupe(s, d):
    docs = table(s, d, "documents").where("text is not null")
    return docs.groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")).drop("h")


@query("prefix_dedupe", """WITH k AS (SELECT sample_id, coalesce(len(messages), 0) AS n, coalesce(_split = 'eval', false) AS e, sha256(coalesce(list_filter(messages, lambda m: m.role = 'system')[1].content, '') || chr(0) || coalesce(list_filter(messages, lambda m: m.role = 'user')[1].content, '')) AS session_key FROM sft_dataset),
a AS (SELECT session_key, bool_or(e) AS any_eval FROM k GROUP BY 1), r AS (SELECT *, row_number() OVER (PARTITION BY session_key ORDER BY n DESC, e DESC, CASE WHEN e THEN sample_id ELSE -sample_id END DESC) AS rn FROM k) SELECT session_key, sample_id, any_eval FROM r JOIN a USING (session_key) WHERE rn = 1""")
def prefix_dedupe(s, d):
    out = C.prefix_dedupe(table(s, d, "sft_dataset").select("sample_id", "messages", "_split"), "sample_id")
    return out.select("session_key", "sample_id", F.coalesce(F.col("_split") == "eval", F.lit(False)).alias("any_eval"))


@query("near_dup_kept", None)
def near_dup_kept(s, d):
    convs = table(s, d, "synthetic_conversations").where("messages is not null").select("conv_id", M.dedup_signature(F.col("messages")).alias("sig"))
    return C.greedy_near_dedupe(convs, "conv_id", "sig")


@query("shingle_jaccard", """WITH p AS (SELECT a.id AS a, b.id AS b, list_distinct(string_split(""" + _NORM.format("a.prompt") + """, ' ')) AS x, list_distinct(string_split(""" + _NORM.format("b.prompt") + """, ' ')) AS y FROM tasks a JOIN tasks b ON a.repo = b.repo AND a.id < b.id) SELECT a, b, round(len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))), 6) AS jaccard FROM p""")
def shingle_jaccard(s, d):
    t = table(s, d, "tasks").select("repo", "id", F.array_distinct(X.words(F.col("prompt"))).alias("w"))
    a, b = t.select("repo", F.col("id").alias("a"), F.col("w").alias("x")), t.select("repo", F.col("id").alias("b"), F.col("w").alias("y"))
    return a.join(b, "repo").where("a < b").select("a", "b", F.round(X.jaccard(F.col("x"), F.col("y")), 6).alias("jaccard"))


@query("balance_by_source", """WITH r AS (SELECT doc_id, coalesce(nullif(lower(trim(source)), ''), 'unknown') AS source FROM documents), c AS (SELECT source, count(*) AS n FROM r GROUP BY 1), k AS (SELECT greatest(1, floor(min(n) * 3))::BIGINT AS cap FROM c)
SELECT doc_id, source FROM r, k QUALIFY row_number() OVER (PARTITION BY source ORDER BY substr(sha256('0:' || doc_id), 1, 16), doc_id) <= cap""")
def balance_by_source(s, d):
    from tracewright.session import clean_label

    rows = table(s, d, "documents").select("doc_id", clean_label(F.col("source")).alias("source"))
    return C.balance(rows, "source", "doc_id", 3.0)


@query("hash_group_split", """WITH g AS (SELECT DISTINCT coalesce(_group, '') AS g FROM sft_dataset), n AS (SELECT greatest(1, round_even(count(*) * 0.1, 0))::BIGINT AS cap FROM g), e AS (SELECT g FROM g, n QUALIFY row_number() OVER (ORDER BY substr(sha256('0:' || g), 1, 16), g) <= cap)
SELECT sample_id, CASE WHEN e.g IS NOT NULL THEN 'eval' ELSE 'train' END AS _split FROM sft_dataset s LEFT JOIN e ON coalesce(s._group, '') = e.g""")
def hash_group_split(s, d):
    return C.hash_group_split(table(s, d, "sft_dataset").select("sample_id", "_group"), "_group", 0.1).select("sample_id", "_split")


@query("leak_check", "SELECT DISTINCT _group FROM sft_dataset WHERE _split = 'train' AND _group IS NOT NULL INTERSECT SELECT DISTINCT _group FROM sft_dataset WHERE _split = 'eval'")
def leak_check(s, d):
    r = table(s, d, "sft_dataset").where("_group is not null")
    return C.leaked_keys(r.where("_split = 'train'"), r.where("_split = 'eval'"), "_group")


@query("source_allow_list", "SELECT sample_id FROM sft_dataset WHERE lower(trim(source)) IN ('frontier', 'cursor')")
def source_allow_list(s, d):
    from tracewright.session import clean_label

    return table(s, d, "sft_dataset").where(clean_label(F.col("source")).isin("frontier", "cursor")).select("sample_id")


@query("source_totals", "SELECT coalesce(nullif(lower(trim(source)), ''), 'unknown') AS source, count(*) AS n, sum(coalesce(length(text), 0))::BIGINT AS tokens FROM documents GROUP BY 1")
def source_totals(s, d):
    from tracewright.session import clean_label

    rows = table(s, d, "documents").select(clean_label(F.col("source")).alias("source"), F.length("text").cast("bigint").alias("tokens"))
    return C.source_totals(rows, "source", "tokens")


@query("union_all_sources", "SELECT 'sft' AS kind, sample_id AS id, source FROM sft_dataset UNION ALL SELECT 'synthetic', conv_id, source FROM synthetic_conversations")
def union_all_sources(s, d):
    a = table(s, d, "sft_dataset").select(F.lit("sft").alias("kind"), F.col("sample_id").alias("id"), "source")
    return C.union_sources(a, table(s, d, "synthetic_conversations").select(F.lit("synthetic").alias("kind"), F.col("conv_id").alias("id"), "source"))


@query("intersect_keys", "SELECT repo FROM tasks INTERSECT SELECT repo FROM documents")
def intersect_keys(s, d):
    return table(s, d, "tasks").select("repo").intersect(table(s, d, "documents").select("repo"))


@query("except_keys", "SELECT repo FROM documents EXCEPT SELECT repo FROM tasks")
def except_keys(s, d):
    return table(s, d, "documents").select("repo").subtract(table(s, d, "tasks").select("repo"))


@query("distinct_sources", "SELECT DISTINCT source FROM documents")
def distinct_sources(s, d):
    return table(s, d, "documents").select("source").distinct()


@query("sanitised_messages", None)
def sanitised_messages(s, d):
    out = C.sanitise(table(s, d, "sft_dataset"), "curated-model", "/work/clean")
    return out.select("sample_id", F.md5(F.to_json("messages")).alias("digest"))


@query("recipe_counts", None)
def recipe_counts(s, d):
    r = C.Recipe("sample_id", table(s, d, "eval_items"), "text", _markers(s))
    base = table(s, d, "sft_dataset").withColumn("_ord", F.col("sample_id"))
    counts = [getattr(r, name)(base).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("recipe"), "n") for name in ("library", "command", "raw")]
    return C.union_sources(*counts)


@query("cosine_neighbours", """SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE a.vec_id % 50 = 0 OR b.vec_id % 50 = 0""")
def cosine_neighbours(s, d):
    from tracewright.operators.vectors import cosine_to_queries

    return cosine_to_queries(table(s, d, "embeddings"), "vec_id", "embedding", None, 50)


@query("top_entities", None)
def top_entities(s, d):
    return table(s, d, "documents").where("text is not null").select(F.explode(X.entities(F.col("text"))).alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))


@query("pricing_summary", """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(s, d):
    return table(s, d, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02 00:00:00'").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("n"))


@query("nation_revenue", """SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def nation_revenue(s, d):
    per_order = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    joined = per_order.join(table(s, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(s, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.join(table(s, d, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.round(F.sum("revenue"), 2).alias("revenue"))
