"""Incremental load as a Structured Streaming query over the landing folder.

New payload files are picked up by the file source; each micro-batch runs the
same load as the batch job (isolate bad series, upsert good rows, append the
run log). The stream checkpoint remembers which files were processed, so rows
of a series that fails must not be lost with their file: they are kept in the
quarantine table and loaded again with the series' next files, the latest file
winning for each key. A series leaves quarantine when all that counts of its
rows is good. ``run_incremental_load`` drains the folder once and then raises if
series are left in quarantine or failed in this run; the good ones are stored.

A replayed micro-batch gives the same tables: the upsert is idempotent, the
quarantine is replaced by what the same rows give again, and the run id follows
from the stream's id (kept in its checkpoint) and the micro-batch's number.

SURVEY §2.12.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import load
from ..schemas import DEFAULT_SERIES, DEFAULT_START_DATE, observation_fields
from ..session import cut_lineage
from ..sources import landing, tables

_NAMESPACE = uuid.UUID("5b0e7c1e-3f0b-4f57-9a37-6f3b8d2f9f10")


def observation_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None,
                       keys: Sequence[str] = ()) -> DataFrame:
    """Streaming frame of payload documents: series_id, observations, error fields, file_time, file_name.

    A line of a line-delimited file (``*.jsonl``) is a document of one observation: both
    forms are sources of one stream, and large files are split over tasks."""
    def reader(fmt_schema, pattern: str):
        r = spark.readStream.schema(fmt_schema).option("pathGlobFilter", pattern)
        return r.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else r

    raw = reader("value string", "*.json").option("wholetext", True).text(landing_dir).select(
        F.col("value").alias("payload"), *landing._file_columns())
    documents = landing.parse_payloads(raw.withColumn("series_id", landing.series_of_file("file_name")), "payload", keys)
    lines = reader(observation_fields(keys, with_series=True), "*.jsonl*").json(landing_dir).select(
        F.coalesce("series_id", landing.series_of_file(F.col("_metadata.file_name"))).alias("series_id"),
        F.array(F.struct("date", "value", *keys)).alias("observations"), F.lit(None).cast("int").alias("error_code"),
        F.lit(None).cast("string").alias("error_message"), *landing._file_columns())
    return documents.unionByName(lines)


def run_id_of(stream_id: str, epoch_id: int) -> str:
    """36 characters, the same for a replayed micro-batch and no other."""
    return str(uuid.uuid5(_NAMESPACE, f"{stream_id}/{epoch_id}"))


def quarantine_schema(keys: Sequence[str] = ()) -> T.StructType:
    return T.StructType([T.StructField("series_id", T.StringType()), *[T.StructField(k, T.StringType()) for k in keys],
                         T.StructField("observation_date", T.DateType()), T.StructField("raw_value", T.StringType()),
                         T.StructField("file_time", T.TimestampNTZType()), T.StructField("file_name", T.StringType())])


def read_quarantine(spark: SparkSession, root: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of series whose load failed, to be loaded with the series' next files."""
    kept = tables.read_current(spark, root, "raw", "quarantine", quarantine_schema(keys))
    return kept if kept is not None else spark.createDataFrame([], quarantine_schema(keys))


def _micro_batch(root: str, specs, now, load_start, keys: Sequence[str] = (), stream_id: str | None = None):
    def handle(payloads: DataFrame, epoch_id: int) -> None:
        spark = payloads.sparkSession
        own_id = stream_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "unnamed"
        columns = [f.name for f in quarantine_schema(keys).fields]
        payloads = cut_lineage(payloads)
        good, bad = landing.split_malformed(payloads)
        present = payloads.select("series_id").distinct()
        kept = read_quarantine(spark, root, keys)
        again = kept.join(present, "series_id", "left_semi")
        rows = cut_lineage(landing.payload_rows(good, keys).select(*columns).unionByName(again).distinct())
        dim = load.series_dim(spark, specs).join(present, "series_id", "left_semi")
        batch, log = load.run_load(rows, dim, None, False, now, run_id_of(own_id, epoch_id), bad.select("series_id"),
                                   load_start, keys, materialise=True)
        tables.upsert_table(spark, tables.layer_path(root, "raw", "observations"), batch, keys, now=now)
        failed = log.filter(F.col("status") == "FAILED").select("series_id")
        tables.publish(kept.join(present, "series_id", "left_anti").unionByName(
            rows.join(failed, "series_id", "left_semi")), root, "raw", "quarantine")
        tables.append_log(log, tables.layer_path(root, "raw", "ingestion_log"))
    return handle


def start_incremental_load(spark: SparkSession, landing_dir: str, root: str, checkpoint_location: str,
                           specs=DEFAULT_SERIES, now=None, available_now: bool = True,
                           load_start: str = DEFAULT_START_DATE, keys: Sequence[str] = ()):
    """Start the stream; returns the StreamingQuery (call ``awaitTermination()``).

    ``checkpoint_location`` has to be a lasting shared folder: it remembers the
    files that were processed from session to session."""
    w = (observation_stream(spark, landing_dir, keys=keys).writeStream
         .foreachBatch(_micro_batch(root, specs, now, load_start, keys))
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()


def run_incremental_load(spark: SparkSession, landing_dir: str, root: str, checkpoint_location: str, **options) -> None:
    """Load all new files, then raise ``LoadFailed`` if a series failed in this run or still waits in quarantine."""
    path = tables.layer_path(root, "raw", "ingestion_log")
    before = (cut_lineage(tables.read_log(spark, path).select("run_id").distinct()) if tables.exists(spark, path)
              else spark.createDataFrame([], "run_id string"))
    start_incremental_load(spark, landing_dir, root, checkpoint_location, **options).awaitTermination()
    if tables.exists(spark, path):
        load.raise_if_failed(tables.read_log(spark, path).join(before, "run_id", "left_anti"))
    waiting = read_quarantine(spark, root, options.get("keys", ())).select("series_id").distinct()
    load.raise_if_failed(waiting.withColumn("status", F.lit("FAILED")))
