"""Layered tables on a shared folder: conform, publish, read, upsert in place.

Layout: ``<root>/<layer>/<name>`` as Parquet. Views are temp views (recomputed
on read, like the staging/intermediate layers); tables are written (marts).
Every write goes to a fresh path first, so a job never reads its own output
and a lost executor only re-runs tasks of a written stage.

SURVEY §2: S5, S7, S9 (stored), S16, S18, F18, U1 (counts).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import INGESTION_LOG, MAX_LENGTHS, observations_contract
from .snapshots import AuditFailed, SnapshotTable

LAYERS = ("raw", "staging", "intermediate", "marts")


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None,
            max_lengths: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Cast to ``schema``, fill defaults, and split off rows that break it.

    Returns ``(ok, violations)``; a violation is a NULL in a NOT NULL column,
    a text longer than its limit, or a value that does not cast.
    """
    defaults = defaults or {}
    max_lengths = max_lengths or {}
    cols, bad = [], []
    for f in schema.fields:
        src = F.col(f.name) if f.name in df.columns else F.lit(None)
        cast = src.try_cast(f.dataType)
        if f.name in df.columns:
            bad.append(src.isNotNull() & cast.isNull())   # text that does not cast
        c = F.coalesce(cast, defaults[f.name]) if f.name in defaults else cast
        cols.append(c.alias(f.name))
        if not f.nullable:
            bad.append(c.isNull())
        if f.name in max_lengths:
            bad.append(F.length(c) > F.lit(max_lengths[f.name]))
    flagged = df.select(*cols, F.greatest(*[F.coalesce(b, F.lit(False)) for b in bad], F.lit(False))
                        .alias("_violation"))
    return (flagged.filter(~F.col("_violation")).drop("_violation"),
            flagged.filter(F.col("_violation")).drop("_violation"))


def raw_limits(table: str) -> dict:
    return MAX_LENGTHS.get(table, {})


def layer_path(root: str, layer: str, name: str) -> str:
    return os.path.join(root, layer, name)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def layer_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """Named source scan: a registered view if present, else the stored table."""
    view = f"{layer}__{name}"
    if spark.catalog.tableExists(view):
        return spark.table(view)
    return spark.read.parquet(layer_path(root, layer, name))


def publish(df: DataFrame, root: str, layer: str, name: str, as_: str = "table",
            partition_by: list[str] | None = None, sort_within: list[str] | None = None,
            audit=None, cluster_by: list[str] | None = None, lookups: list[str] = ()) -> DataFrame:
    """Materialise a layer: a temp view (recomputed on read) or a written table.

    Tables are written to a fresh versioned folder and then become the
    current version by a pointer file (write, audit, publish): readers never
    see a half-written or failing table, and the writer never reads its own
    output. Versions older than the one before the current are removed.
    ``audit``: a ``quality.Watch``, collected by the job that writes; any failure keeps
    the version from being published. ``cluster_by``: deal rows to files by ranges of
    these columns, and store the range of the first in every file beside the version,
    so that ``read_mart`` opens only the files that a range of it needs; ``lookups`` get
    bloom filters.
    """
    spark = df.sparkSession
    if as_ == "view":
        df.createOrReplaceTempView(f"{layer}__{name}")
        return df
    base = layer_path(root, layer, name)
    version = os.path.join(base, f"v={uuid.uuid4().hex}")
    out = df
    if cluster_by:
        out = out.repartitionByRange(*cluster_by)
        sort_within = sort_within or cluster_by
    if audit is not None:
        out = audit.on(out)   # after the exchange, whose sampling runs what lies before it
    out = out.sortWithinPartitions(*sort_within) if sort_within else out
    w = out.write.mode("overwrite")
    for c in lookups:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(version)
    written = spark.read.schema(out.schema).parquet(version)   # partition values keep their type
    if audit is not None:
        failures = audit.failures()
        if failures:
            raise AuditFailed(f"{layer}/{name} not published: " + "; ".join(failures))
    if cluster_by:
        first = F.col(cluster_by[0])
        written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min(first).alias("lo"), F.max(first).alias("hi"), F.count_if(first.isNull()).alias("nulls")).write.parquet(
            os.path.join(version, FILE_RANGES))  # a name that readers of the version pass over
    _write_pointer(spark, base, version)
    _drop_old_versions(spark, base, version)
    return written


POINTER, FILE_RANGES = "CURRENT", "_ranges"
#: Versions kept beside the current one, for readers that opened them before the switch.
KEPT_VERSIONS = 1


def _fs(spark: SparkSession, path: str):
    """(Hadoop file system, path) of ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write_pointer(spark: SparkSession, base: str, version: str) -> None:
    """Make ``version`` the current one: a new pointer file renamed over the old one in one step."""
    jvm = spark._jvm
    fs, fresh = _fs(spark, os.path.join(base, f"_pointer-{uuid.uuid4().hex}"))
    out = fs.create(fresh, False)
    out.write(bytearray(os.path.basename(version).encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(base, POINTER)), options)


def _drop_old_versions(spark: SparkSession, base: str, current: str) -> None:
    """Remove versions older than the current one and the KEPT_VERSIONS before it."""
    fs, p = _fs(spark, base)
    found = sorted((s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(p)
                   if s.isDirectory() and s.getPath().getName().startswith("v="))
    old = [n for _, n in found if n != os.path.basename(current)]
    for name in old[:len(old) - KEPT_VERSIONS] if len(old) > KEPT_VERSIONS else []:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(base, name), True)


def current_version(spark: SparkSession, base: str) -> str | None:
    ptr = os.path.join(base, POINTER)
    if not exists(spark, ptr):
        return None
    rows = spark.read.text(ptr).limit(1).collect()
    return os.path.join(base, rows[0][0]) if rows else None


def read_mart(spark: SparkSession, root: str, name: str, layer: str = "marts",
              sort: bool = False, lo=None, hi=None) -> DataFrame:
    """Serving read: current version, lower-case column names, month as timestamp.

    ``lo``, ``hi``: only months from and up to these (inclusive). Of a table that is
    clustered by month only the files whose months overlap are opened. ``sort=True``
    returns the rows ordered by month (the serving order of a single-entity mart; a
    range shuffle, so leave it off for large panels).
    """
    path = current_version(spark, layer_path(root, layer, name))
    if path is None:
        raise FileNotFoundError(f"no published table {layer}/{name}")
    df, bounded = spark.read.parquet(path), lo is not None or hi is not None
    if bounded and exists(spark, os.path.join(path, FILE_RANGES)):
        ranges = spark.read.parquet(os.path.join(path, FILE_RANGES))
        if lo is not None:
            ranges = ranges.where(F.col("hi") >= F.lit(str(lo)).cast("date"))
        if hi is not None:
            ranges = ranges.where(F.col("lo") <= F.lit(str(hi)).cast("date"))
        files = sorted(os.path.join(path, r[0]) for r in ranges.select("file").collect())  # names of the files that are read
        df = spark.read.schema(df.schema).parquet(*files) if files else spark.createDataFrame([], df.schema)
    df = df.toDF(*[c.lower() for c in df.columns])
    if bounded:
        month = F.col("observation_month")
        df = df.where((month >= F.lit(str(lo)).cast("date")) if lo is not None else F.lit(True)).where(
            (month <= F.lit(str(hi)).cast("date")) if hi is not None else F.lit(True))
    if "observation_month" in df.columns:
        df = df.withColumn("observation_month", F.col("observation_month").cast("timestamp_ntz"))
        if sort:
            df = df.orderBy("observation_month")
    return df


def read_current(spark: SparkSession, root: str, layer: str, name: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Current version of a table; ``schema`` where its partition values must keep their types."""
    path = current_version(spark, layer_path(root, layer, name))
    if path is None:
        return None
    return spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)


def append_log(log: DataFrame, path: str) -> None:
    """Append a run's log rows, partitioned by run_id.

    Dynamic partition overwrite replaces only this run's partition: every run
    adds its own rows (append-only log), and a replayed run or micro-batch
    with the same run_id writes the same rows again instead of duplicating them.
    """
    (log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id").parquet(path))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The stored ingestion log under its contract (run ids that look like numbers stay text)."""
    return spark.read.schema(INGESTION_LOG).parquet(path)


#: Partitions of the stored raw observations: what a batch touches is replaced, the rest stays.
RAW_PARTS = {"series_id": "series_id", "obs_year": "year(observation_date)"}


def observations_table(spark: SparkSession, path: str, keys=()) -> SnapshotTable:
    return SnapshotTable(spark, path, observations_contract(keys), RAW_PARTS)


def has_observations(spark: SparkSession, path: str) -> bool:
    """True once a load has committed (a crashed first load leaves folders, not a table)."""
    return observations_table(spark, path).version() is not None


def read_observations(spark: SparkSession, path: str, keys=()) -> DataFrame:
    """Stored raw observations of the last commit, with the columns of their contract (series ids such as '001' stay text)."""
    return observations_table(spark, path, keys).read()


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, keys=(), now=None) -> int:
    """Idempotent upsert of ``batch`` into the stored raw observations; returns the rows merged.

    ``keys``: entity key columns. The table is partitioned by series and year of
    the date; only the pairs that the batch touches are read and rewritten, and all
    of them change with one commit: a reader sees the version before or after. A load
    that another one has overtaken raises ``Conflict`` and changes nothing; run again,
    it starts from the newer version.
    """
    from ..operators.load import _ts, dedup_batch, upsert
    from ..session import cut_lineage

    row_key = [*keys, "series_id", "observation_date"]
    contract = observations_contract(keys)
    table = observations_table(spark, path, keys)
    base = table.version()
    fresh = cut_lineage(dedup_batch(batch, row_key).select(
        *[F.col(f.name) if f.name in batch.columns else _ts(now).alias(f.name) for f in contract.fields]))
    n = fresh.count()
    if not n:
        return 0
    touched = cut_lineage(table.values(fresh))
    merged = fresh if base is None else upsert(table.read(touched, base), fresh, row_key, now)
    table.replace(merged, touched, base)
    return n
