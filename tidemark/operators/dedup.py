"""Latest-load-wins dedup and the two staging models.

SURVEY §2: W1, W2, P1, P2, F12, M1, M2.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import surrogate_key

_RN = "_rn"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   keep: Column | None = None) -> DataFrame:
    """Keep the first row per key under ``order``; then apply ``keep``.

    ``keep`` is applied *after* the pick, so a latest row that fails it removes
    the key (a retraction), it does not fall back to an older row. Spark plans
    this as a partial ``WindowGroupLimit`` before the shuffle and a final one
    after it, so a hot key ships at most one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1)
    if keep is not None:
        out = out.filter(keep)
    return out.drop(_RN)


def latest_load_order(tie_break: Sequence[Column] = ()) -> list[Column]:
    """Newest load first; a NULL load time sorts first, as in the warehouse."""
    return [F.col("ingested_at").desc_nulls_first(), *tie_break]


def stage_observations(raw: DataFrame, tie_break: Sequence[Column] = (),
                       keys: Sequence[str] = ()) -> DataFrame:
    """Staged observations: latest load per ([entity keys,] series_id, observation_date),
    NULL values retracted. The surrogate key hashes the same columns."""
    key_cols = [*keys, "series_id", "observation_date"]
    # same key set, date first: the sort before the partial WindowGroupLimit
    # then gets an integer prefix instead of a low-cardinality string
    picked = latest_per_key(raw, ["observation_date", *keys, "series_id"], latest_load_order(tie_break),
                            keep=F.col("value").isNotNull())
    return picked.select(
        surrogate_key(*key_cols).alias("observation_id"),
        *keys, "series_id", "observation_date", "value", "ingested_at", "source_url")


def stage_metadata(raw: DataFrame, tie_break: Sequence[Column] = ()) -> DataFrame:
    """Staged metadata: latest load per series, columns renamed."""
    picked = latest_per_key(raw, ["series_id"], latest_load_order(tie_break))
    return picked.select(
        "series_id",
        F.col("title").alias("series_title"),
        F.col("frequency").alias("data_frequency"),
        F.col("units").alias("measurement_units"),
        F.col("seasonal_adj").alias("seasonal_adjustment"),
        F.col("last_updated").alias("source_last_updated"),
        "ingested_at")
