"""Mergeable statistics: small states per (entity, year) from which summaries are put together.

A state holds what the dashboard rows of one entity and year add to the indicator
summary, the observation counts and the row reconciliation: counts, sums and
extremes, the year's latest row with an unemployment value and the row of the
calendar month before it, and the December row (the predecessor of a January).
States of different years merge by plain aggregates, so a load recomputes the
states of the years that it touches and a summary reads one row a year instead of
one a month.

Distinct observation dates are counted exactly with one bit per day in a number per
(entity, month): set by the aggregate that builds the monthly values, merged by
bitwise or. (Spark's bitmap aggregates hold 4 KB a group, some 500 times a number.)

SURVEY §2: A2, A5, A7, M7, D5.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import MONTH, WIDE_COLUMNS
from .marts import _SUMMARY_INDICATORS, SUMMARY_COLUMNS
from .quality import row_ratio_of

YEAR = "_year"


def summary_states(dash: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, year) of the dashboard: keys, _year and the state's columns."""
    columns = [c for _, c in _SUMMARY_INDICATORS]
    u = F.col("unemployment_rate")
    row = F.struct(MONTH, "recession_risk_level", "recession_signal_count", *columns)
    aggs = [F.sort_array(F.collect_list(row)).alias("_rows"), F.count(F.lit(1)).alias("_n")]  # twelve rows at most
    aggs += [F.count(c).alias(f"_known_{c}") for c in WIDE_COLUMNS]
    for p, c in _SUMMARY_INDICATORS:
        hist = F.when(u.isNotNull(), F.col(c))
        aggs += [F.count(hist).alias(f"_{p}_n"), F.sum(hist).alias(f"_{p}_sum"), F.min(hist).alias(f"_{p}_min"), F.max(hist).alias(f"_{p}_max")]
    last = lambda a: F.get(a, F.size(a) - 1)
    per = dash.groupBy(*keys, F.year(MONTH).alias(YEAR)).agg(*aggs)
    per = per.withColumn("_latest", last(F.filter("_rows", lambda r: r["unemployment_rate"].isNotNull())))
    return per.withColumns({
        "_before": last(F.filter("_rows", lambda r: r[MONTH] == F.add_months(F.col(f"_latest.{MONTH}"), -1))),
        "_december": last(F.filter("_rows", lambda r: F.month(r[MONTH]) == 12))}).drop("_rows")


def summary_of(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The indicator summary from the states of all years (equal to ``marts.indicator_summary`` of the rows)."""
    keys = list(keys)
    before = Window.partitionBy(*keys).orderBy(YEAR)
    at = F.col(f"_latest.{MONTH}")
    of_last_year = F.when(F.lag(YEAR).over(before) == F.col(YEAR) - 1, F.lag("_december").over(before))
    s = states.withColumn("_previous", F.when(F.month(at) == 1, of_last_year).otherwise(F.col("_before"))).withColumn("_at", at)
    aggs = [F.max_by("_latest", "_at").alias("_latest"), F.max_by("_previous", "_at").alias("_previous")]
    for p, _ in _SUMMARY_INDICATORS:
        aggs += [F.min(f"_{p}_min").alias(f"{p}_min"), F.max(f"_{p}_max").alias(f"{p}_max"),
                 F.round(F.sum(f"_{p}_sum") / F.nullif(F.sum(f"_{p}_n"), F.lit(0)), 2).alias(f"{p}_avg")]
    one = s.groupBy(*keys).agg(*aggs).where("_latest is not null and _previous is not null")
    out = {"latest_month": F.col(f"_latest.{MONTH}"), "current_risk_level": F.col("_latest.recession_risk_level"),
           "active_signals": F.col("_latest.recession_signal_count")}
    for p, c in _SUMMARY_INDICATORS:
        now, then = F.col(f"_latest.{c}"), F.col(f"_previous.{c}")
        out |= {f"{p}_current": now, f"{p}_previous": then, f"{p}_mom_change": now - then}
    return one.select(*keys, *[out.get(c, F.col(c)).alias(c) for c in SUMMARY_COLUMNS])


def counts_of(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Non-NULL months per indicator from the states (equal to ``serving.observation_counts`` of the rows)."""
    sums = states.groupBy(*keys).agg(*[F.sum(f"_known_{c}").alias(c) for c in WIDE_COLUMNS])
    return sums.unpivot(list(keys), list(WIDE_COLUMNS), "indicator", "observation_count").where("observation_count > 0")


def reconcile(values: DataFrame, dates: str, count: str, lo: float = 0.5, hi: float = 1.1, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct observation dates against month rows, from monthly values with a date mask (``dates``): one pass.

    Equal to ``quality.staging_reconcile`` of the observations and the wide table."""
    one = values.groupBy(*keys).agg(
        F.coalesce(F.sum(F.bit_count(F.coalesce(dates, F.lit(0)))), F.lit(0)).cast("long").alias("staging_months"),
        F.count_if(F.col(count) > 0).alias("pivoted_rows"))
    if keys:
        one = one.where("staging_months > 0 or pivoted_rows > 0")
    return row_ratio_of(one, "staging_months", "pivoted_rows", lo, hi, keys)
