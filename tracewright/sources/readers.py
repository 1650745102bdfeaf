"""Readers (S-1..S-7, S-9..S-22): JSON lines, traces, transcripts, texts, CSV, KEY=VALUE, catalogues.

Lines are read as text and parsed with an explicit schema; the raw line rides along where a sink needs
it.  Order matters to some operators, so readers that need one add ``_ord``: the line's place in its
file after the file's name (no global numbering job)."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.functions import text as X
from tracewright.functions.jsonx import strict_json
from tracewright.operators import messages as M
from tracewright.session import MESSAGE

SESSION = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE)), T.StructField("tools", T.StringType()), T.StructField("source", T.StringType()), T.StructField("model", T.StringType()), T.StructField("_group", T.StringType()), T.StructField("_split", T.StringType())])
#: Folders and endings of the text corpus scan.
SKIP_FOLDERS = ["runs", ".git", "__pycache__", "node_modules", ".venv"]
TEXT_ENDINGS = ["py", "md", "txt", "json", "jsonl", "jsx", "js", "ts", "tsx", "toml", "yaml", "yml", "sh", "css", "html", "jinja", "lock"]
TRAIN_NAMES = ["train.jsonl", "data/train.jsonl", "dataset.jsonl"]
EVAL_NAMES = ["eval.jsonl", "data/eval.jsonl", "test.jsonl", "validation.jsonl"]


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, _ord, value): non-blank lines; _ord rises within a file."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("_ord"), "value")
    return raw.where(F.trim("value") != "")


def jsonl_lenient(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Sessions of JSON lines (S-1): blank and malformed lines and rows without a message list are skipped."""
    parsed = lines(spark, path).select("file", "_ord", F.col("value").alias("_raw"), F.from_json("value", SESSION, {"mode": "PERMISSIVE"}).alias("r"))
    return parsed.where("r.messages is not null").select("file", "_ord", "_raw", "r.*")


def jsonl_strict(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Rows of JSON lines; a malformed line is an error with its file (S-2, S-17)."""
    l = lines(spark, path)  # noqa: E741
    ok = F.when(F.try_parse_json("value").isNull(), F.raise_error(F.concat(F.lit("malformed line in "), F.col("file"), F.lit(": "), F.substring("value", 1, 80)))).otherwise(F.col("value"))
    return l.select("file", "_ord", F.from_json(ok, schema, {"mode": "FAILFAST"}).alias("r")).select("file", "_ord", "r.*")


PROXY = T.StructType(
    [
        T.StructField("timestamp", T.StringType()), T.StructField("upstream", T.StringType()), T.StructField("elapsed_ms", T.LongType()),
        T.StructField("request", T.StructType([T.StructField("model", T.StringType()), T.StructField("messages", T.ArrayType(MESSAGE)), T.StructField("tools", T.StringType())])),
        T.StructField("response", T.StructType([T.StructField("message", MESSAGE), T.StructField("finish_reason", T.StringType()), T.StructField("model", T.StringType()), T.StructField("usage", T.StringType())])),
        T.StructField("replay", T.StructType([T.StructField("task_id", T.StringType()), T.StructField("type", T.StringType()), T.StructField("pass", T.BooleanType()), T.StructField("score", T.DoubleType())])),
    ]
)


def proxy_folder(spark: SparkSession, path: str) -> DataFrame:
    """Trace records, one JSON file each, with file and the parsed fields (S-3)."""
    return spark.read.schema(PROXY).option("multiLine", True).option("pathGlobFilter", "*.json").json(path).select("*", F.col("_metadata.file_path").alias("file"), F.lit(0).cast("long").alias("_ord"))


def collapse_traces(traces: DataFrame, exclude: DataFrame | None = None) -> DataFrame:
    """Sessions of trace records (S-3, S-5): held-out tasks and failed replays go, the conversation is the
    request's messages and the reply; of one opening (system, first user) the longest stays, of equally
    long ones the first file."""
    kept = traces.where("replay is null or coalesce(replay.pass, false)").where("request.messages is not null")
    if exclude is not None:
        kept = kept.join(exclude.select(F.col("task_id").alias("__t")).distinct(), F.col("replay.task_id") == F.col("__t"), "left_anti")
    convo = F.concat(F.col("request.messages"), F.when(F.col("response.message").isNotNull(), F.array("response.message")).otherwise(F.expr("filter(request.messages, x -> false)")))
    rows = kept.select(
        "file", "timestamp", convo.alias("messages"), F.col("request.tools").alias("tools"), F.coalesce("response.model", "request.model").alias("model"),
        F.when(F.lower("upstream") == "openrouter", "frontier").when(F.col("replay").isNotNull(), "replay").otherwise("opencode").alias("source"), F.col("replay.task_id").alias("_group"),
    )
    m = F.col("messages")
    key = X.prefix_key(M.nth_text(m, "system", 1), M.nth_text(m, "user", 1))
    packed = F.struct(*[F.col(c) for c in rows.columns])
    # the first file of the longest: sizes descending, then names ascending
    return rows.groupBy(key.alias("session_key")).agg(F.min_by(packed, F.struct(-F.size(m), F.col("file"))).alias("r")).select("session_key", "r.*")


def transcripts(spark: SparkSession, path: str, least: int = 200) -> DataFrame:
    """Question and answer pairs of transcript folders (S-4): *.jsonl at any depth but index.jsonl and subagents."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").text(path).select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("line_no"), "value")
    raw = raw.where(~F.col("path").rlike(r"/index\.jsonl$|/subagents/")).where(F.trim("value") != "")
    content = F.coalesce(F.get_json_object("value", "$.content"), F.get_json_object("value", "$.message.content"), F.get_json_object("value", "$.text"))
    rows = raw.select("path", "line_no", F.coalesce(F.get_json_object("value", "$.role"), F.get_json_object("value", "$.message.role")).alias("role"), M.content_text(content).alias("text"))
    return M.tagged_turns(rows).where(F.length("answer") >= least)


def parse_input(df: DataFrame, text: str) -> DataFrame:
    """One row for each record of whole texts (S-6): a JSON array gives its items, an object one, else each line must be JSON."""
    whole = df.withColumn("__t", F.trim(text)).withColumn("__json", strict_json(F.trim(text)))
    t = F.col("__t")
    each_line = F.filter(F.split(t, r"\r?\n"), lambda x: F.trim(x) != "")
    items = F.transform(F.try_variant_get(F.try_parse_json(t), "$", "array<variant>"), lambda v: F.to_json(v))
    records = F.when(t == "", F.raise_error(F.lit("empty input"))).when(F.col("__json") & t.startswith("["), items).when(F.col("__json") & t.startswith("{"), F.array(t)).otherwise(each_line)
    rows = whole.select(*[c for c in df.columns if c != text], "__json", F.posexplode(records).alias("record_no", "record"))
    fine = F.col("__json") | strict_json(F.col("record"))
    return rows.withColumn("record", F.when(fine, F.col("record")).otherwise(F.raise_error(F.concat(F.lit("bad line: "), F.substring("record", 1, 80))))).drop("__json")


def extract_session(record: Column) -> Column:
    """The messages (JSON text) of a record of any of four shapes, null for others (S-7): trace record,
    object with messages, bare list, object with a content list that is not the user's."""
    request, reply = F.get_json_object(record, "$.request.messages"), F.get_json_object(record, "$.response.message")
    joined = F.when(reply.isNotNull(), F.concat(F.regexp_replace(request, r"\]\s*$", ""), F.when(F.json_array_length(request) > 0, F.lit(",")).otherwise(F.lit("")), reply, F.lit("]"))).otherwise(request)
    listed = F.get_json_object(record, "$.messages")
    content = F.get_json_object(record, "$.content")
    own = F.when(F.json_array_length(content).isNotNull() & (F.coalesce(F.get_json_object(record, "$.role"), F.lit("")) != "user"), F.concat(F.lit("["), record, F.lit("]")))
    return F.coalesce(joined, F.when(F.json_array_length(listed).isNotNull(), listed), F.when(F.trim(record).startswith("["), record), own)


def dataset_files(spark: SparkSession, root: str) -> tuple[str, str | None]:
    """The train file (first known name, else the first *.jsonl) and the eval file, if any, of a folder (S-9)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = hadoop.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    there = lambda n: fs.exists(hadoop.Path(base, n))
    train = next((n for n in TRAIN_NAMES if there(n)), None)
    if train is None:
        names = sorted(s.getPath().getName() for s in fs.listStatus(base) if s.getPath().getName().endswith(".jsonl"))
        if not names:
            raise FileNotFoundError(f"no JSON lines in {root}")
        train = names[0]
    held = next((n for n in EVAL_NAMES if there(n) and n != train), None)
    return f"{root}/{train}", f"{root}/{held}" if held else None


def text_corpus(spark: SparkSession, root: str) -> DataFrame:
    """(path, text) of the text files below a folder, without some folders (S-10)."""
    df = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return df.where(F.lower(F.substring_index("path", ".", -1)).isin(TEXT_ENDINGS)).where(~F.col("path").rlike("/(" + "|".join(s.replace(".", r"\.") for s in SKIP_FOLDERS) + ")/"))


def git_log(log: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(commits, numstat) of a log text (S-11): records start with \\x1e, fields are split by \\x1f, the
    numstat lines follow: sha, parent, ts, subject, body."""
    rec = log.select(F.explode(F.split(value, "\u001e")).alias("r")).where(F.trim("r") != "")
    parts = rec.select(F.split("r", "\u001f").alias("f"))
    at = lambda k: F.try_element_at("f", F.lit(k))
    commits = parts.select(F.trim(at(1)).alias("sha"), at(2).alias("parent"), F.timestamp_seconds(at(3).try_cast("long")).alias("ts"), at(4).alias("subject"), at(5).alias("body"), at(6).alias("stat"))
    stat = commits.select("sha", F.explode(F.split(F.coalesce("stat", F.lit("")), r"\n")).alias("l")).where(F.col("l").rlike(r"^(\d+|-)\t(\d+|-)\t"))
    return commits.drop("stat"), stat.select("sha", F.split_part("l", F.lit("\t"), F.lit(1)).alias("added"), F.split_part("l", F.lit("\t"), F.lit(3)).alias("path"))


def result_files(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All *.jsonl of a folder, in the order of names (S-12)."""
    return spark.read.schema(schema).option("pathGlobFilter", "*.jsonl").json(root).select("*", F.col("_metadata.file_path").alias("file"))


def embedded_rows(df: DataFrame, text: str) -> DataFrame:
    """Evaluation rows of a text that is a list or an object with rows (S-14)."""
    from tracewright.operators.evals import is_eval_row

    inner = F.coalesce(F.get_json_object(text, "$.rows"), F.col(text))
    rows = F.transform(F.try_variant_get(F.try_parse_json(inner), "$", "array<variant>"), lambda v: F.to_json(v))
    return df.select(F.posexplode(rows).alias("_ord", "row")).where(is_eval_row(F.col("row")))


def messy_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, comment lines that may be indented, and blank lines (S-15)."""
    kept = spark.read.text(path).where(~F.ltrim("value").startswith("#") & (F.trim("value") != ""))
    return _csv_from_lines(spark, kept)


def _csv_from_lines(spark: SparkSession, kept: DataFrame) -> DataFrame:
    header = kept.first()
    if header is None:
        return spark.createDataFrame([], "empty string").drop("empty")
    names = [n.strip() for n in header.value.split(",")]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return kept.where(F.col("value") != header.value).select(F.from_csv("value", schema.simpleString()[7:-1].replace(":", " ")).alias("r")).select("r.*")


def csv_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One CSV column as numbers, unreadable ones null (S-16)."""
    return spark.read.option("header", True).csv(path).select(F.col(column).try_cast("double").alias(column))


#: Readers by file ending (S-18, X-3).
LOADERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def loader(ending: str):
    def put(fn):
        LOADERS[ending] = fn
        return fn

    return put


@loader(".json")
def _load_json(spark: SparkSession, path: str) -> DataFrame:
    """The items of a list, or the value itself."""
    whole = spark.read.text(path, wholetext=True)
    v = F.parse_json("value")
    items = F.when(F.schema_of_variant(v).startswith("ARRAY"), F.variant_get(v, "$", "array<variant>")).otherwise(F.array(v))
    return whole.select(F.posexplode(items).alias("_ord", "item")).select("_ord", F.to_json("item").alias("item"))


@loader(".jsonl")
def _load_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Each line's value; a bad line is an error with the path and its number from 1."""
    whole = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("k", "line")).where(F.trim("line") != "")
    bad = F.raise_error(F.concat(F.lit(f"{path}:"), (F.col("k") + 1).cast("string"), F.lit(": bad JSON")))
    return whole.select(F.col("k").alias("_ord"), F.when(F.try_parse_json("line").isNull(), bad).otherwise(F.col("line")).alias("item"))


def load_any(spark: SparkSession, path: str) -> DataFrame:
    """A file by its ending; unknown endings are errors (S-18)."""
    ending = PurePosixPath(path).suffix.lower()
    if ending not in LOADERS:
        raise ValueError(f"no loader for {ending or 'files without ending'}")
    return LOADERS[ending](spark, path)


def task_manifest(spark: SparkSession, path: str) -> DataFrame:
    """task_id, type, prompt, weight of JSON lines (S-19): the weight is 1 only where the key is absent."""
    l = lines(spark, path)  # noqa: E741
    has = F.array_contains(F.json_object_keys("value"), "weight")
    get = lambda k: F.get_json_object("value", f"$.{k}")
    return l.select(get("task_id").alias("task_id"), get("type").alias("type"), get("prompt").alias("prompt"), F.when(has, get("weight").try_cast("double")).otherwise(F.lit(1.0)).alias("weight"))


def key_values(df: DataFrame, text: str) -> DataFrame:
    """key, value of KEY=VALUE texts (S-20): blanks and comments skipped, the last assignment wins; a line
    without '=' or with white space in its key is an error that names its number."""
    rows = df.select(F.posexplode(F.split(text, r"\r?\n")).alias("k", "line")).withColumn("line", F.trim("line")).where((F.col("line") != "") & ~F.col("line").startswith("#"))
    key = F.trim(F.substring_index("line", "=", 1))
    fine = F.col("line").contains("=") & (key != "") & ~key.rlike(r"\s")
    name = F.when(fine, key).otherwise(F.raise_error(F.concat(F.lit("line "), (F.col("k") + 1).cast("string"), F.lit(": not KEY=VALUE"))))
    value = F.trim(F.expr("substr(line, instr(line, '=') + 1)"))
    return rows.select("k", name.alias("key"), value.alias("value")).groupBy("key").agg(F.max_by("value", "k").alias("value"))


def run_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """Run artefacts (S-21): metadata of runs/*/*/metadata.json with the summary beside it, if any."""
    meta = spark.read.text(f"{root}/*/*/metadata.json", wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/([^/]+)/metadata\.json$", 1).alias("run"), F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/([^/]+)/metadata\.json$", 2).alias("problem"), F.col("value").alias("metadata"))
    try:
        notes = spark.read.text(f"{root}/*/*/failure-summary.json", wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/([^/]+)/[^/]+$", 1).alias("run"), F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/([^/]+)/[^/]+$", 2).alias("problem"), F.col("value").alias("summary"))
    except Exception:  # noqa: BLE001  no summary file exists
        return meta.withColumn("summary", F.lit(None).cast("string"))
    return meta.join(notes, ["run", "problem"], "left")


def problem_catalogue(spark: SparkSession, problems: list[dict]) -> DataFrame:
    """number, slug and the given fields, in the order of numbers (S-22)."""
    df = spark.createDataFrame([(json.dumps(p),) for p in problems], "p string").select(F.get_json_object("p", "$.id").alias("id"), F.get_json_object("p", "$.title").alias("title"), F.get_json_object("p", "$.kind").alias("kind"), F.get_json_object("p", "$.difficulty").alias("difficulty"))
    return df.withColumn("number", F.regexp_extract("id", r"(\d+)", 1).try_cast("int")).withColumn("slug", X.slugify(F.col("title"))).orderBy("number", "id")


def harness_profile(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prompts, tools) seen in requests (S-23, A-23): by role the longest system prompt and the count, and
    the first schema of each tool name."""
    system = M.nth_text(F.col("request.messages"), "system", 1)
    rows = records.where(system.isNotNull()).select("record_id", system.alias("prompt"), X.prompt_role(system).alias("role"))
    prompts = rows.groupBy("role").agg(F.max_by("prompt", F.struct(F.length("prompt"), -F.col("record_id"))).alias("prompt"), F.count(F.lit(1)).alias("n"))
    listed = records.select("record_id", F.posexplode(F.try_variant_get(F.try_parse_json("request.tools"), "$", "array<variant>")).alias("k", "t"))
    named = listed.select("record_id", "k", F.coalesce(F.try_variant_get("t", "$.function.name", "string"), F.try_variant_get("t", "$.name", "string")).alias("name"), F.to_json("t").alias("schema"))
    return prompts, named.where("name is not null").groupBy("name").agg(F.min_by("schema", F.struct("record_id", "k")).alias("schema"))
