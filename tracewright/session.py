"""Session helpers: table access, durable intermediate results, checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side is broadcast only when it is proven to be at most this large.
BROADCAST_LIMIT_BYTES = 64 << 20


_shipped: set[str] = set()
_folders: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors unless their Python path already has it."""
    root = Path(__file__).resolve().parent.parent
    app = spark.sparkContext.applicationId
    if app in _shipped or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    archive = Path(tempfile.mkdtemp(prefix="tracewright-")) / "tracewright.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted((root / "tracewright").rglob("*.py")):
            z.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of the directory; a file or a folder of part files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` wins.  Only a local master may fall back to a folder of its own:
    on a cluster a machine-local folder would be lost with its machine, so that is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return named or current.get()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tracewright-")
    sc.setCheckpointDir(named)
    return named


def scratch(spark: SparkSession) -> str:
    """A fresh path in the shared checkpoint folder; removed when the application ends."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/tracewright-{spark.sparkContext.applicationId}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(base)
    if base not in _folders:
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
        _folders.add(base)
    return f"{base}/{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written into the shared checkpoint folder; survives lost executors.

    Columnar and compressed, so a later step reads only the columns it needs and the planner knows the
    table's size.  The folder is removed when the application ends."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_collect(df: DataFrame, max_rows: int, what: str) -> list:
    """Collect a table that must be small; more than ``max_rows`` rows is an error, never a cut."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows; raise the bound or work in blocks")
    return rows


def ensure_small(nbytes: int, what: str, limit: int = BROADCAST_LIMIT_BYTES) -> None:
    if nbytes > limit:
        raise ValueError(f"{what}: {nbytes} bytes exceed the broadcast bound of {limit}")


def with_rank(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """The rows with their place (from 0) in a total order, without one task that sees all of them:
    range-sorted parts are written once, and each part's first place is the size of the parts before it."""
    parts = df.repartitionByRange(max(2, shuffle_partitions(df.sparkSession)), *order).sortWithinPartitions(*order)
    placed = durable(parts.withColumn("__part", F.spark_partition_id()).withColumn("__line", F.monotonically_increasing_id()))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__line").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each part
    offsets = sizes.select("__part", "__first", before.alias("__before"))
    return placed.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__line") - F.col("__first") + F.col("__before")).drop("__part", "__line", "__first", "__before")


def with_previous(df: DataFrame, key: str, order: list[str], values: dict[str, Column]) -> DataFrame:
    """The rows with, for each name, the last non-null value of its expression among the rows before in the
    order of the key.  Range-sorted parts are folded apart and meet through one row a key and part, so a
    key of any size spreads over tasks.  ``order`` should be total; ties fall either way."""
    made = df.select("*", *[v.alias(f"__{n}") for n, v in values.items()])
    parts = made.repartitionByRange(max(2, shuffle_partitions(df.sparkSession)), key, *order).withColumn("__part", F.spark_partition_id())
    placed = durable(parts)
    here = Window.partitionBy(key, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    place = F.struct(*order)
    ends = placed.groupBy(F.col(key).alias("__key"), "__part").agg(*[F.max_by(F.col(f"__{n}"), F.when(F.col(f"__{n}").isNotNull(), place)).alias(f"__end_{n}") for n in values])
    before = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    carried = ends.select("__key", F.col("__part").alias("__of"), *[F.last(f"__end_{n}", ignorenulls=True).over(before).alias(f"__carry_{n}") for n in values])
    local = placed.select("*", *[F.last(f"__{n}", ignorenulls=True).over(here).alias(f"__local_{n}") for n in values])
    both = local.join(carried, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__part") == F.col("__of")), "left")
    return both.select(*df.columns, *[F.coalesce(f"__local_{n}", f"__carry_{n}").alias(n) for n in values])


def with_running_sum(df: DataFrame, key: str, order: list[str], value: Column, name: str) -> DataFrame:
    """The rows with the sum of the expression up to and with each row, in the order of the key.

    Range-sorted parts are summed apart and the sums of the parts before are added, so a key of any size
    spreads over tasks.  Null values count for nothing; ``order`` should be total."""
    made = df.withColumn("__value", value)
    placed = durable(made.repartitionByRange(max(2, shuffle_partitions(df.sparkSession)), key, *order).withColumn("__part", F.spark_partition_id()))
    here = Window.partitionBy(key, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    sums = placed.groupBy(F.col(key).alias("__key"), F.col("__part").alias("__of")).agg(F.sum("__value").alias("__total")).withColumnRenamed("__of", "__part")
    carried = sums.select("__key", F.col("__part").alias("__of"), F.sum("__total").over(before).alias("__sum_before"))
    local = placed.withColumn("__sum_here", F.sum("__value").over(here))
    both = local.join(carried, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__part") == F.col("__of")), "left")
    total = F.coalesce(F.col("__sum_here") + F.col("__sum_before"), "__sum_here", "__sum_before")
    return both.select(*[c for c in df.columns if c != name], total.alias(name)).select(*df.columns, *([] if name in df.columns else [name]))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def local_session(cpus: int | None = None, name: str = "tracewright") -> SparkSession:
    """A session for tests and the bench on one machine."""
    cpus = cpus or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


MESSAGE = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("reasoning_content", T.StringType()),
        T.StructField(
            "tool_calls",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField("type", T.StringType()),
                        T.StructField(
                            "function",
                            T.StructType([T.StructField("name", T.StringType()), T.StructField("arguments", T.StringType())]),
                        ),
                    ]
                )
            ),
        ),
        T.StructField("tool_call_id", T.StringType()),
        T.StructField("name", T.StringType()),
    ]
)


def clean_label(col, default: str = "unknown"):
    """A label without case or outer spacing; blank and null become ``default``."""
    return F.coalesce(F.nullif(F.lower(F.trim(col)), F.lit("")), F.lit(default))
