"""Calendar helpers: the month spine as a generator, not a join."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MONTH


def _as_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, (dt.date, dt.datetime)):
        d = d.strftime("%Y-%m-%d")
    return F.to_date(F.lit(d))


def month_sequence(start, as_of) -> Column:
    """Array of month starts from month(start) up to the last month <= as_of."""
    return F.sequence(F.trunc(_as_date(start), "MM"), F.trunc(_as_date(as_of), "MM"),
                      F.expr("INTERVAL 1 MONTH"))


def month_spine(spark: SparkSession, start, as_of) -> DataFrame:
    """One row per month from ``start`` to ``as_of`` (inclusive, ascending)."""
    return spark.range(1).select(F.explode(month_sequence(start, as_of)).alias(MONTH))


def spine_for(entities: DataFrame, keys, start, as_of) -> DataFrame:
    """The month spine repeated for each entity row, generated in place.

    This is a narrow per-row generator over the (small, distinct) entity frame,
    so no join and no all-pairs step is planned.
    """
    return entities.select(*keys, F.explode(month_sequence(start, as_of)).alias(MONTH))
