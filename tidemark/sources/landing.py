"""Landing readers: JSON payloads landed in a folder, read by Spark in parallel.

Any fetcher may land the files. Three forms are read:

* ``<series id>[__<anything>].json``: one payload document per file;
* ``<series id>[__<anything>].jsonl``: one observation per line, for series too
  large for one document (Spark splits such files over tasks);
* text rows that hold payload documents (``parse_payloads``).

The series id is the payload's own ``series_id`` field if it has one, else the
file name up to the first ``__`` or, without one, up to the extension (ids may
hold dots). Each row carries its file's time and name: where files disagree on
a key, the latest file wins.

SURVEY §2: S1-S3, F5, F16.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import METADATA_PAYLOAD, observation_fields, observation_payload

FILE_ORDER = ("file_time", "file_name")


def series_of_file(file_name: str | Column) -> Column:
    """Series id of a file name: the part before ``__``, else the name without its extension."""
    return F.split_part(F.regexp_replace(file_name, r"\.jsonl?(\.gz)?$", ""), F.lit("__"), F.lit(1))


def _file_columns() -> list[Column]:
    return [F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("file_time"),
            F.col("_metadata.file_name").alias("file_name")]


def parse_payloads(texts: DataFrame, text: str = "payload", keys: Sequence[str] = ()) -> DataFrame:
    """Payload documents to series_id, observations (null: malformed), error fields; other columns stay.

    A ``series_id`` column of ``texts`` is the fallback for documents without
    that field. Text that is no JSON document is malformed."""
    doc = F.from_json(F.col(text), observation_payload(keys))
    rest = [c for c in texts.columns if c not in (text, "series_id")]
    parsed = texts.select(*rest, *([F.col("series_id").alias("_own")] if "series_id" in texts.columns
                                   else [F.lit(None).cast("string").alias("_own")]), doc.alias("_doc"))
    return parsed.select(*rest, F.coalesce("_doc.series_id", "_own").alias("series_id"), "_doc.observations",
                         "_doc.error_code", "_doc.error_message")


def read_observation_payloads(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row per payload file: series_id, observations (array or NULL), error fields, file_time, file_name."""
    raw = (spark.read.option("wholetext", True).option("pathGlobFilter", "*.json*").text(path)
                .select(F.col("value").alias("payload"), *_file_columns())
                .where(~F.col("file_name").rlike(r"\.jsonl(\.gz)?$")))
    return parse_payloads(raw.withColumn("series_id", series_of_file("file_name")), "payload", keys)


def split_malformed(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): a payload without the observations key is malformed.

    An empty observations array is a good payload with zero rows.
    """
    bad = F.col("observations").isNull()
    return payloads.filter(~bad), payloads.filter(bad)


def payload_rows(good: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Observation rows of good payloads: series_id, keys, observation_date, raw_value and the columns beside.

    A date that does not parse is NULL; it fails the series in the load."""
    beside = [c for c in good.columns if c not in ("series_id", "observations", "error_code", "error_message")]
    return (good.select("series_id", *beside, F.inline("observations"))
                .select("series_id", *keys, F.try_to_date("date").alias("observation_date"),
                        F.col("value").alias("raw_value"), *beside))


def read_observation_lines(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame:
    """Observation rows of the line-delimited files (``*.jsonl``): the same columns as ``payload_rows``."""
    return (spark.read.schema(observation_fields(keys, with_series=True)).option("pathGlobFilter", "*.jsonl*").json(path)
                 .select(F.coalesce("series_id", series_of_file(F.col("_metadata.file_name"))).alias("series_id"), *keys,
                         F.try_to_date("date").alias("observation_date"), F.col("value").alias("raw_value"),
                         *_file_columns()))


def read_observation_landing(spark: SparkSession, path: str, keys: Sequence[str] = ()):
    """Landed observation rows and malformed series.

    Returns ``(rows, malformed)``: rows of every good payload and of the
    line-delimited files (start date applied later by run_load); malformed
    lists series ids whose payload was malformed.
    """
    good, bad = split_malformed(read_observation_payloads(spark, path, keys))
    rows = payload_rows(good, keys).unionByName(read_observation_lines(spark, path, keys))
    return rows, bad.select("series_id")


def read_metadata_landing(spark: SparkSession, path: str, now=None) -> DataFrame:
    """First element of ``seriess`` per file; a missing key or empty list gives no row.

    ``last_updated`` is a wall-clock column without a zone: the payload's offset
    is not applied. Of several files of a series the latest counts.
    ``bad_metadata`` marks rows whose ``last_updated`` does not parse.
    """
    from ..operators.dedup import latest_per_key
    from ..operators.load import _ts

    first = F.get(F.from_json("value", METADATA_PAYLOAD)["seriess"], 0)
    df = (spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(path)
               .select(first.alias("m"), *_file_columns())
               .filter(F.col("m").isNotNull())
               .withColumn("series_id", series_of_file("file_name")))
    df = latest_per_key(df, ["series_id"], [F.col(c).desc() for c in FILE_ORDER])
    wall_clock = F.substring(F.col("m.last_updated"), 1, 19).try_cast("timestamp_ntz")
    return df.select(
        "series_id", F.col("m.title").alias("title"), F.col("m.frequency").alias("frequency"),
        F.col("m.units").alias("units"), F.col("m.seasonal_adjustment").alias("seasonal_adj"),
        wall_clock.alias("last_updated"), _ts(now).alias("ingested_at"),
        (F.col("m.last_updated").isNotNull() & wall_clock.isNull()).alias("bad_metadata"))
