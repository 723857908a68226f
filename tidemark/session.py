"""Session helpers: builder for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


#: What a local run uses; under spark-submit only what the submitter has left open.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "tidemark") -> SparkSession:
    """The session: as submitted, or a local one with the given settings.

    Under spark-submit (which starts the JVM before Python and names its
    gateway in the environment) master, memory and shuffle partitions are the
    submitter's, and each of DEFAULTS is set only if the submitter has not.
    """
    builder = SparkSession.builder.appName(app_name)
    if "PYSPARK_GATEWAY_PORT" in os.environ:
        given = SparkConf()
        for key, value in DEFAULTS.items():
            if not given.contains(key):
                builder = builder.config(key, value)
    else:
        builder = builder.master(master).config(map=DEFAULTS | {
            "spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own. On a
    cluster a missing setting is an error: a folder of the driver's machine
    would hold data that executors and later sessions cannot see.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir is not set on {master}: name a folder that all machines share")
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_checkpoints", None) != path:  # every call makes a folder: once an application
        sc.setCheckpointDir(path)
        sc._tidemark_checkpoints = path
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's folder below ``spark.checkpoint.dir``, which goes when the application ends."""
    sc = spark.sparkContext
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{sc.applicationId}"
    if not getattr(sc, "_tidemark_cuts", False):
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
        sc._tidemark_cuts = True
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (survives executor loss); a load leaves no copy of its rows."""
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (Hadoop file system summary, no data read)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def size_shuffles(spark: SparkSession, paths, target_bytes: int = TARGET_PARTITION_BYTES,
                  max_partitions: int = 200_000) -> int | None:
    """Size AQE's initial shuffle partition count from the input volume.

    Only when the submitter has not set it: one partition per ``target_bytes``
    of input (at least the default parallelism), so the first shuffle of a
    100 TB job does not squeeze into 200 partitions and spill. AQE then
    coalesces small partitions (the aggregated shuffles are far smaller).
    ``max_partitions`` bounds the number of shuffle files only: beyond it
    partitions grow, results stay the same.
    Returns the value set, or None if the setting was already given.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(key, None):
        return None
    n = -(-input_bytes(spark, paths) // target_bytes)
    n = int(min(max(n, spark.sparkContext.defaultParallelism), max_partitions))
    spark.conf.set(key, str(n))
    if not spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes // 2))
    return n
