"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PART_BYTES = 8 << 20


def build_session(master: str = "local[*]", app: str = "talkatlas", **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Shuffle width and driver memory are set for a local master only; a cluster keeps its own.
    """
    local = master.startswith("local[") and not master.startswith("local-cluster")
    cores = master[len("local["):-1] if local else "*"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
    )
    if local:
        builder = builder.config("spark.sql.shuffle.partitions", "8" if cores == "*" else cores)
        builder = builder.config("spark.driver.memory", "12g")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there the
    driver and the executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="talkatlas-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so reruns cannot collide."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, by: str | None = None) -> DataFrame:
    """Spread a stored table over the cores when it has fewer splits than cores.

    For a table read straight from files, ahead of work that is heavy per row. A
    large table has splits enough and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, by) if by else df.repartition(cores)


def dealt(df: DataFrame, by: str, text: str) -> DataFrame:
    """Deal rows by a key to tasks of about ``PART_BYTES`` of ``text`` each.

    Ahead of work that makes many times its bytes of a text. The number of tasks follows the texts and not the session,
    so neither the memory of a task nor what it would have to spill grows with the table.
    """
    held = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-held // PART_BYTES)), by)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written copy.

    Used where several branches read one expensive result, or where row
    positions must not change when a lost task is run again.
    """
    sc = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from the written copy.

    Unlike a checkpoint, which keeps the estimate of its plan, the size of the files is known to Spark,
    so only a lookup that is small is broadcast.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
