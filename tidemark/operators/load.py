"""Loading: idempotent upsert, replace-by-key, watermarks, per-series run log.

All steps are keyed joins and aggregates over the whole batch (one job for
all series), not a per-series driver loop. Only rows of series without an
error enter the batch, so a bad series never blocks the others.

SURVEY §2: S4, S8-S14, J7, P17, A4, A10, A11, F13-F15.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import is_bad_value, parse_value, truncate_text
from ..schemas import DEFAULT_SERIES, DEFAULT_START_DATE, INGESTION_LOG, MAX_LENGTHS, SeriesSpec

OBS_KEYS = ("series_id", "observation_date")
SOURCE_URL_BASE = "landing://series/observations?series_id="


def _ts(now) -> Column:
    if now is None:
        return F.localtimestamp()
    if isinstance(now, Column):
        return now
    if isinstance(now, dt.datetime):
        now = now.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(now).cast("timestamp_ntz")


def dedup_batch(batch: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key; without an explicit order, the greatest row wins (deterministic)."""
    from .dedup import latest_per_key

    if order is None:
        rest = [c for c in batch.columns if c not in keys]
        if len(rest) == 1 and isinstance(batch.schema[rest[0]].dataType, T.NumericType):
            # the greatest row of a key is its greatest number: a hash aggregate, no sort
            return batch.groupBy(*keys).agg(F.max(rest[0]).alias(rest[0])).select(*batch.columns)
        order = [F.col(c).desc_nulls_last() for c in rest]
    return latest_per_key(batch, list(keys), list(order))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str] = OBS_KEYS,
           now=None, stamp: str | None = "ingested_at",
           order: Sequence[Column] | None = None) -> DataFrame:
    """MERGE semantics: of target and batch together, one row per key, the batch's first.

    Matched keys take the batch row (a NULL batch value overwrites); unmatched
    batch rows are inserted; ``stamp`` is set to ``now`` on every merged row.
    Both sides are shuffled by key once and read once. Applying the same batch
    twice gives the same result (idempotent).
    """
    from .dedup import latest_per_key

    keys = list(keys)
    b = dedup_batch(batch, keys, order)
    if stamp is not None and stamp in target.columns:
        b = b.withColumn(stamp, _ts(now))
    side = "_from_batch"
    both = target.withColumn(side, F.lit(0)).unionByName(b.select(*target.columns).withColumn(side, F.lit(1)))
    rest = [F.col(c).desc_nulls_last() for c in target.columns if c not in keys]
    return latest_per_key(both, keys, [F.col(side).desc(), *rest]).drop(side)


def replace_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """DELETE rows of the batch's keys, then INSERT the batch (no stamp change)."""
    keys = list(keys)
    b = batch.select(*target.columns)
    return target.join(b.select(*keys).distinct(), keys, "left_anti").unionByName(b)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each named table: table_name, row_count (one aggregate each, one job for all)."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        out = c if out is None else out.unionByName(c)
    return out


def merged_count(batch: DataFrame, keys: Sequence[str] = OBS_KEYS) -> DataFrame:
    """Rows merged (inserted + updated) = distinct batch keys; empty batch gives 0."""
    return batch.select(*keys).distinct().agg(F.count(F.lit(1)).alias("rows_merged"))


def series_dim(spark: SparkSession, specs: Sequence[SeriesSpec] = DEFAULT_SERIES) -> DataFrame:
    """Series catalogue from configuration (small; planned as a local relation)."""
    return spark.createDataFrame([(s.series_id, s.name, s.frequency, s.column, s.align) for s in specs],
                                 "series_id string, name string, frequency string, column string, align string")


def watermarks(obs: DataFrame, dim: DataFrame, default: str = DEFAULT_START_DATE) -> DataFrame:
    """Per series: last stored observation date, else the default start.

    The date is used inclusively (the last date is fetched again). Rows with a
    NULL value count too.
    """
    last = obs.groupBy("series_id").agg(F.max("observation_date").alias("_last"))
    return (dim.select("series_id").join(last, "series_id", "left")
               .select("series_id", F.coalesce("_last", F.to_date(F.lit(default))).alias("start_date")))


def _with_start(landing: DataFrame, dim: DataFrame, target: DataFrame | None, incremental: bool, default_start: str) -> DataFrame:
    """Rows on or after their series' start date (rows with an unparseable date stay: they fail their series)."""
    from ..session import cut_lineage
    from .joins import broadcast_if_small

    date = F.col("observation_date")
    if not (incremental and target is not None):
        return landing.filter(date.isNull() | (date >= F.to_date(F.lit(default_start))))
    # one row per configured series, materialised once: a hot series holding a third of
    # the rows then never lands in one task
    starts = broadcast_if_small(cut_lineage(watermarks(target, dim, default_start)))
    return landing.join(starts, "series_id").filter(date.isNull() | (date >= F.col("start_date"))).drop("start_date")


def run_load(landing: DataFrame, dim: DataFrame, target: DataFrame | None = None,
             incremental: bool = False, now=None, run_id: str | None = None,
             malformed: DataFrame | None = None, default_start: str = DEFAULT_START_DATE,
             keys: Sequence[str] = (), materialise: bool = False):
    """One load over all series.

    ``landing``: (series_id, [keys,] observation_date DATE, raw_value STRING) rows,
    with ``file_time`` and ``file_name`` if they come from files: of several
    rows of a key the latest file's counts, for the values and for what fails.
    ``malformed``: series ids whose payload had no observations (fail).
    Returns ``(batch, log)``: the rows to upsert (good series only, rows on or
    after each series' start date) and one log row per configured series.

    ``materialise=True`` (stored loads) writes the parsed rows and the log once
    to the shared folder, so payloads are parsed once and the log that decides
    what is loaded is the log that is stored; nothing is run otherwise.
    """
    from ..session import cut_lineage
    from ..sources.landing import FILE_ORDER
    from .dedup import latest_per_key
    from .joins import broadcast_if_small

    run_id = run_id or str(uuid.uuid4())
    ts = _ts(now)
    rows = _with_start(landing, dim, target, incremental, default_start)
    if materialise:
        rows = cut_lineage(rows)
    date, obs_keys = F.col("observation_date"), [*keys, "series_id", "observation_date"]
    latest = rows
    if set(FILE_ORDER) <= set(rows.columns):
        # rows without a date share no key: each is judged
        dated = latest_per_key(rows.filter(date.isNotNull()), obs_keys,
                               [*(F.col(c).desc() for c in FILE_ORDER), F.col("raw_value").desc_nulls_last()])
        latest = dated.unionByName(rows.filter(date.isNull()))
    # a row the raw table contract rejects (bad number, bad date, over-long id, missing key) fails its series
    max_id = MAX_LENGTHS["observations"]["series_id"]
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    error = (F.when(date.isNull(), F.lit("<bad date>"))
              .when(F.length("series_id") > F.lit(max_id), F.lit("<series id too long>"))
              .when(no_key, F.lit("<entity key missing>"))
              .when(is_bad_value("raw_value"), F.coalesce("raw_value", F.lit("<no value>"))))
    # one pass: first by (series, error), a hash aggregate that leaves few rows, then by series
    marks = (latest.withColumn("_error", error).groupBy("series_id", "_error").agg(F.count(F.lit(1)).alias("_n"))
                   .groupBy("series_id").agg(F.sum("_n").alias("_n"), F.min("_error").alias("_bad_text")))
    status = dim.select("series_id").join(marks, "series_id", "left")
    if latest is not rows:
        fetched = rows.groupBy("series_id").agg(F.count(F.lit(1)).alias("_fetched"))
        status = status.join(fetched, "series_id", "left").withColumn("_n", F.col("_fetched")).drop("_fetched")
    if malformed is not None:
        status = status.join(malformed.select("series_id").distinct().withColumn("_malformed", F.lit(True)),
                             "series_id", "left")
    else:
        status = status.withColumn("_malformed", F.lit(None).cast("boolean"))
    failed = F.col("_bad_text").isNotNull() | F.coalesce(F.col("_malformed"), F.lit(False))
    message = (F.when(F.col("_malformed"), F.lit("payload has no observations"))
                .otherwise(F.concat(F.lit("could not convert value to float: '"),
                                    F.col("_bad_text"), F.lit("'"))))
    log = status.select(
        F.lit(run_id).alias("run_id"), "series_id",
        F.when(failed, F.lit(0)).otherwise(F.coalesce(F.col("_n"), F.lit(0))).cast("int").alias("records_fetched"),
        F.when(failed, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
        ts.alias("started_at"), ts.alias("completed_at"),
        F.when(failed, truncate_text(message, 2000)).alias("error_message"))
    if materialise:
        log = cut_lineage(log)
    good = log.filter(F.col("status") == "SUCCESS").select("series_id")
    batch = (latest.join(broadcast_if_small(good) if materialise else good, "series_id", "left_semi")
                   .select("series_id", *keys, "observation_date", parse_value("raw_value").alias("value"),
                           F.concat(F.lit(SOURCE_URL_BASE), F.col("series_id")).alias("source_url")))
    return batch, log


def with_failures(log: DataFrame, failures: DataFrame) -> DataFrame:
    """``log`` with the series of ``failures`` (series_id, error) marked FAILED with 0 records; earlier errors stay."""
    f = failures.groupBy("series_id").agg(F.min("error").alias("_error"))
    hit = F.col("_error").isNotNull() & (F.col("status") == "SUCCESS")
    return log.join(f, "series_id", "left").select(
        "run_id", "series_id", F.when(hit, F.lit(0)).otherwise(F.col("records_fetched")).alias("records_fetched"),
        F.when(hit, F.lit("FAILED")).otherwise(F.col("status")).alias("status"),
        "started_at", "completed_at", F.when(hit, truncate_text("_error", 2000)).otherwise(F.col("error_message")).alias("error_message"))


def run_summary(log: DataFrame) -> DataFrame:
    """succeeded / failed / total over a run log (one row)."""
    return log.agg(F.count_if(F.col("status") == "SUCCESS").alias("succeeded"),
                   F.count_if(F.col("status") == "FAILED").alias("failed"),
                   F.count(F.lit(1)).alias("total"))


class LoadFailed(RuntimeError):
    """Raised after a load in which at least one series failed (good data stays loaded)."""


#: So many names stand in the error text; the log has all of them.
NAMED_FAILURES = 20


def raise_if_failed(log: DataFrame) -> None:
    """Raise with the number of failed series, the first names and where the rest stand."""
    failed = log.filter(F.col("status") == "FAILED")
    n = failed.count()
    if n:
        names = [r.series_id for r in failed.orderBy("series_id").select("series_id").limit(NAMED_FAILURES).collect()]
        more = f" and {n - len(names)} more (all in the ingestion log)" if n > len(names) else ""
        raise LoadFailed(f"{n} series failed: {', '.join(names)}{more}")


LOG_SCHEMA = INGESTION_LOG
