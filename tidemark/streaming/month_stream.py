"""The month grid kept up to date by an event-time stream over the landing folder.

The event time of an observation is its month. A stateful aggregate keeps, per
(entity, series, date), the value of the latest file; it runs in update mode, so a
micro-batch hands on the keys that it changed, and the panel
(``plans.incremental``) recomputes the touched months from there. The watermark
trails the newest month by ``LATENESS``: state of months behind it is dropped, so
state stays bounded however long the stream runs.

Late rows, of months behind the watermark, are left out by the aggregate. The rule
for them: after every run the files that are new since the run before are read once
more for such rows, and the latest per key is merged into the panel. Nothing is
lost, and a row that is applied twice changes nothing. The time up to which files
have been looked through stands beside the stream's checkpoint.

After any number of runs, restarts and replays the panel equals one batch load of
all files. Rows that do not parse take no part (the load stream reports them).

SURVEY §2.12, W1, W3, A1.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import is_bad_value, month_of, parse_value
from ..operators.dedup import latest_per_key
from ..plans.incremental import Panel
from ..session import cut_lineage
from ..sources import landing
from .landing_stream import observation_stream

#: How far months may come after newer ones and still be aggregated in the stream.
LATENESS = "100 days"
MARK = "late-rows-seen"


def good_rows(payloads: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """[keys,] series_id, observation_date, value, file_time, file_name and month_at (event time) of rows that parse."""
    rows = landing.payload_rows(landing.split_malformed(payloads)[0], keys)
    return rows.where(F.col("observation_date").isNotNull() & ~is_bad_value("raw_value")).select(
        *keys, "series_id", "observation_date", parse_value("raw_value").alias("value"), *landing.FILE_ORDER,
        month_of("observation_date").cast("timestamp").alias("month_at"))


def latest_values(rows: DataFrame, keys: Sequence[str] = (), lateness: str = LATENESS) -> DataFrame:
    """The value of the latest file per key, as a stateful aggregate with a watermark on the month."""
    load = F.struct(*landing.FILE_ORDER)
    return (rows.withWatermark("month_at", lateness).groupBy(*keys, "series_id", "observation_date", "month_at")
            .agg(F.max_by("value", load).alias("value"), F.max(load).alias("load")))


def _apply(panel: Panel, as_of: str):
    def handle(changed: DataFrame, epoch_id: int) -> None:
        panel.load(changed.select(*panel.keys, "series_id", "observation_date", "value", F.col("load.file_time").alias("ingested_at"),
                                  F.col("load.file_name").alias("source_url")), as_of, F.col("ingested_at"))
    return handle


def start_month_stream(panel: Panel, landing_dir: str, checkpoint_location: str, as_of: str, available_now: bool = True,
                       lateness: str = LATENESS, max_files_per_trigger: int | None = None):
    """Start the stream; returns the StreamingQuery."""
    rows = good_rows(observation_stream(panel.spark, landing_dir, max_files_per_trigger, panel.keys), panel.keys)
    w = (latest_values(rows, panel.keys, lateness).writeStream.outputMode("update")
         .foreachBatch(_apply(panel, as_of)).option("checkpointLocation", checkpoint_location))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")).start()


def run_month_stream(panel: Panel, landing_dir: str, checkpoint_location: str, as_of: str, **options):
    """Load all new files, then the late rows among them; returns the finished query."""
    spark = panel.spark
    query = start_month_stream(panel, landing_dir, checkpoint_location, as_of, **options)
    query.awaitTermination()
    mark = os.path.join(checkpoint_location, MARK)
    seen = _read_mark(spark, mark)
    rows, _ = landing.read_observation_landing(spark, landing_dir, panel.keys)
    fresh = rows.where(F.col("observation_date").isNotNull() & ~is_bad_value("raw_value"))
    if seen is not None:  # file times are compared whole: a file of the same second is looked through again
        fresh = fresh.where(F.col("file_time") >= F.lit(seen).cast("timestamp_ntz"))
    newest = rows.agg(F.max("file_time")).first()[0]
    progress = [p for p in query.recentProgress if p.get("eventTime", {}).get("watermark")]
    if progress:
        watermark = max(p["eventTime"]["watermark"] for p in progress)
        behind = F.lit(watermark).cast("timestamp") > month_of("observation_date").cast("timestamp")
        late = cut_lineage(latest_per_key(fresh.where(behind), [*panel.keys, "series_id", "observation_date"],
                                          [F.col(c).desc() for c in landing.FILE_ORDER]).select(
            *panel.keys, "series_id", "observation_date", parse_value("raw_value").alias("value"),
            F.col("file_time").alias("ingested_at"), F.col("file_name").alias("source_url")))
        if late.limit(1).count():
            panel.load(late, as_of, F.col("ingested_at"))
    if newest is not None:
        _write_mark(spark, mark, newest.isoformat(sep=" "))
    return query


def _read_mark(spark: SparkSession, path: str) -> str | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_mark(spark: SparkSession, path: str, text: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
