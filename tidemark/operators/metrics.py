"""Derived time-series metrics over the wide monthly table.

Every window is keyed by the entity columns and ordered by month, so Spark
plans one hash exchange on the keys and evaluates all lags and frames of the
same spec in one Window node. Lags are positional (rows), like the reference.

SURVEY §2: W5-W8, F7, F8, F11, M4.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import lag_diff, pct_change, rolling, time_window
from ..schemas import MONTH, WIDE_COLUMNS

# Derived metric columns in the order of the reference model.
METRIC_COLUMNS = (
    "unemployment_rate_mom_change", "unemployment_rate_yoy_change",
    "unemployment_rate_3m_avg", "unemployment_rate_12m_avg", "unemployment_rate_12m_low",
    "inflation_rate_yoy", "inflation_rate_mom_annualized",
    "fed_funds_rate_mom_change", "fed_funds_rate_yoy_change",
    "sentiment_mom_change", "sentiment_3m_avg",
    "gdp_qoq_growth_rate", "treasury_spread_3m_avg",
)


def metric_columns(keys: Sequence[str] = ()) -> dict:
    w = time_window(keys)
    return {
        "unemployment_rate_mom_change": lag_diff("unemployment_rate", 1, w),
        "unemployment_rate_yoy_change": lag_diff("unemployment_rate", 12, w),
        "unemployment_rate_3m_avg": rolling("unemployment_rate", "avg", 3, w),
        "unemployment_rate_12m_avg": rolling("unemployment_rate", "avg", 12, w),
        "unemployment_rate_12m_low": rolling("unemployment_rate", "min", 12, w),
        # year-over-year inflation (x100) and month-over-month annualised (x1200, linear)
        "inflation_rate_yoy": pct_change("cpi_index", 12, 100, w),
        "inflation_rate_mom_annualized": pct_change("cpi_index", 1, 1200, w),
        "fed_funds_rate_mom_change": lag_diff("fed_funds_rate", 1, w),
        "fed_funds_rate_yoy_change": lag_diff("fed_funds_rate", 12, w),
        "sentiment_mom_change": lag_diff("consumer_sentiment", 1, w),
        "sentiment_3m_avg": rolling("consumer_sentiment", "avg", 3, w),
        # three rows back on the filled monthly GDP = previous quarter
        "gdp_qoq_growth_rate": pct_change("gdp", 3, 100, w),
        "treasury_spread_3m_avg": rolling("treasury_spread_10y2y", "avg", 3, w),
    }


def with_indicator_columns(wide: DataFrame) -> DataFrame:
    """Add any of the six indicator columns the series configuration left out, as NULL."""
    missing = [c for c in WIDE_COLUMNS if c not in wide.columns]
    return wide.withColumns({c: F.lit(None).cast("double") for c in missing}) if missing else wide


def derived_metrics(wide: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Wide table plus the 13 derived metric columns."""
    cols = metric_columns(keys)
    return with_indicator_columns(wide).select("*", *[cols[c].alias(c) for c in METRIC_COLUMNS])


def changes(wide: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Absolute MoM / YoY differences only."""
    cols = metric_columns(keys)
    names = ["unemployment_rate_mom_change", "unemployment_rate_yoy_change",
             "fed_funds_rate_mom_change", "fed_funds_rate_yoy_change", "sentiment_mom_change"]
    return wide.select(*keys, MONTH, *[cols[c].alias(c) for c in names])


def pct_changes(wide: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    cols = metric_columns(keys)
    names = ["inflation_rate_yoy", "inflation_rate_mom_annualized", "gdp_qoq_growth_rate"]
    return wide.select(*keys, MONTH, *[cols[c].alias(c) for c in names])


def rolling_avgs(wide: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    cols = metric_columns(keys)
    names = ["unemployment_rate_3m_avg", "unemployment_rate_12m_avg",
             "sentiment_3m_avg", "treasury_spread_3m_avg"]
    return wide.select(*keys, MONTH, *[cols[c].alias(c) for c in names])


def rolling_low(wide: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    cols = metric_columns(keys)
    return wide.select(*keys, MONTH, "unemployment_rate",
                       cols["unemployment_rate_12m_low"].alias("unemployment_rate_12m_low"))
