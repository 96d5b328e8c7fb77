"""Session set-up, the shared scratch folder and staged tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Runtime settings the operators are designed for. AQE sizes the shuffles and
# splits skewed join partitions; the forced skew join lets it do so even when a
# split costs one more shuffle, which is cheaper than one task with a third of
# the rows.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}
# The most bytes, as shuffled, that a task is given, and from which a partition of
# a join counts as skewed. In memory rows take some twenty times as much, and a task
# sorts and hashes several inputs at once. A session that asks for less keeps it.
MOST_BYTES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 48 << 20,
}


def build_session(
    app_name: str = "layerwright",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the runtime settings above; ``settings`` win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **MOST_BYTES, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else has built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    for key, most in MOST_BYTES.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, most)
    return spark


def _bytes(size: str) -> int:
    """A size as Spark's settings write it, in bytes."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)i?b?\s*", size.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def scratch_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="layerwright-"))
    return context.getCheckpointDir().rstrip("/")


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The Hadoop file system of a path, and the path as it knows it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def scratch_root(spark: SparkSession) -> str:
    """The folder that holds all an application stages."""
    return f"{scratch_dir(spark)}/layerwright/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the application's scratch folder that nobody has used yet.

    The folder is removed when the application ends, or before by ``clear_scratch``.
    """
    root = scratch_root(spark)
    files, folder = hadoop_path(spark, root)
    if not files.exists(folder):
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all the application has staged. DataFrames that read it can be used until then, not after."""
    files, folder = hadoop_path(spark, scratch_root(spark))
    files.delete(folder, True)


def stage(df: DataFrame, label: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the scratch folder and read it back.

    Cuts the lineage for loops, survives the loss of executors, and gives the
    optimizer true sizes for its join choice. Unlike a checkpoint it stays
    columnar, so later reads are pruned.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def stage_counted(df: DataFrame, label: str = "stage", path: str | None = None) -> tuple[DataFrame, int]:
    """``stage`` and the number of rows, counted as they are written."""
    seen = Observation()
    staged = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), label, path)
    return staged, seen.get["rows"]
