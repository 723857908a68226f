"""Serving datasets behind each dashboard element, computed per entity.

Ranges are month predicates that reach the Parquet scan when the mart is
read from storage; "latest" picks are ``max_by`` aggregates per entity, so
nothing is sliced on the driver.

SURVEY §2: V1-V13, P10-P12, A7-A9, F17, F20, O2-O4.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import status_label
from ..schemas import MONTH, WIDE_COLUMNS

# Dashboard signal labels and the column that drives each one.
SIGNAL_LABELS = (
    ("Sahm Rule", "signal_sahm_rule", "sahm_rule_value"),
    ("Yield Curve", "signal_yield_curve_inverted", "treasury_spread_10y2y"),
    ("High Inflation", "signal_high_inflation", "inflation_rate_yoy"),
    ("Low Sentiment", "signal_low_sentiment", "consumer_sentiment"),
    ("Fed Tightening", "signal_fed_tightening", "fed_funds_rate_yoy_change"),
)

# KPI cards (label, summary prefix).
KPI_CARDS = (
    ("Unemployment Rate", "unemployment"),
    ("Inflation (YoY)", "inflation"),
    ("Fed Funds Rate", "fed_funds"),
    ("Consumer Sentiment", "sentiment"),
)


# The columns behind each chart of the dashboard.
CHART_SERIES = {
    "overview": ("unemployment_rate", "inflation_rate_yoy", "fed_funds_rate", "consumer_sentiment"),
    "signal_count": ("recession_signal_count",),
    "sahm": ("sahm_rule_value",),
    "unemployment": ("unemployment_rate", "unemployment_rate_3m_avg", "unemployment_rate_12m_avg"),
    "inflation": ("cpi_index", "inflation_rate_yoy"),
    "fed_funds": ("fed_funds_rate", "fed_funds_rate_yoy_change"),
    "sentiment": ("consumer_sentiment", "sentiment_3m_avg", "sentiment_mom_change"),
    "treasury_spread": ("treasury_spread_10y2y",),
    "gdp_level": ("gdp",),
    "gdp_growth": ("gdp_qoq_growth_rate",),
}
# charts that drop rows where their single series is NULL
CHART_DROP_NULL = {"sahm": ("sahm_rule_value",), "gdp_growth": ("gdp_qoq_growth_rate",)}


def chart_series(df: DataFrame, chart: str, lo=None, hi=None, keys: Sequence[str] = ()) -> DataFrame:
    """Data behind one dashboard chart, within an inclusive month range."""
    return range_series(df, CHART_SERIES[chart], lo, hi, CHART_DROP_NULL.get(chart), keys)


def month_bounds(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Min and max month per entity."""
    return df.groupBy(*keys).agg(F.min(MONTH).alias("min_month"), F.max(MONTH).alias("max_month"))


def range_series(df: DataFrame, cols: Sequence[str], lo=None, hi=None,
                 drop_null: Sequence[str] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Columns of the mart within an inclusive month range; optional NULL drop."""
    out = df
    m = F.col(MONTH)
    if lo is not None:
        out = out.filter(m >= F.to_date(F.lit(lo)))
    if hi is not None:
        out = out.filter(m <= F.to_date(F.lit(hi)))
    out = out.select(*keys, MONTH, *cols)
    if drop_null:
        out = out.na.drop(subset=list(drop_null))
    return out


def kpi_table(summary: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """KPI cards: indicator, current value, month-over-month delta (NULL kept)."""
    cards = F.array(*[F.struct(F.lit(label).alias("indicator"),
                               F.col(f"{p}_current").alias("current_value"),
                               F.col(f"{p}_mom_change").alias("mom_change"))
                      for label, p in KPI_CARDS])
    return summary.select(*keys, "latest_month", F.inline(cards))


def _latest_with_level(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    pick = F.when(F.col("recession_risk_level").isNotNull(), F.col(MONTH))
    return df.groupBy(*keys).agg(F.max(pick).alias("latest_month"),
                                 *[F.max_by(c, pick).alias(c) for c in cols])


def current_risk(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Risk level and active-signal count of the last month with a level."""
    return (_latest_with_level(df, ["recession_risk_level", "recession_signal_count"], keys)
            .filter(F.col("latest_month").isNotNull()))


def signal_status(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Five rows per entity: signal, flag, status text, driving value."""
    cols = sorted({c for _, f, v in SIGNAL_LABELS for c in (f, v)})
    latest = _latest_with_level(df, cols, keys).filter(F.col("latest_month").isNotNull())
    rows = F.array(*[F.struct(F.lit(label).alias("signal"), F.col(f).alias("flag"),
                              status_label(F.col(f)).alias("status"),
                              F.col(v).cast("double").alias("driving_value"))
                     for label, f, v in SIGNAL_LABELS])
    return latest.select(*keys, "latest_month", F.inline(rows))


def observation_counts(df: DataFrame, cols: Sequence[str] = WIDE_COLUMNS,
                       keys: Sequence[str] = ()) -> DataFrame:
    """Non-NULL months per indicator (an all-NULL indicator has no row)."""
    long = df.unpivot([*keys, MONTH], list(cols), "indicator", "value")
    return (long.filter(F.col("value").isNotNull())
                .groupBy(*keys, "indicator").agg(F.count(F.lit(1)).alias("observation_count")))


def completeness(df: DataFrame, cols: Sequence[str] = (MONTH, *WIDE_COLUMNS), months: int = 24,
                 keys: Sequence[str] = ()) -> DataFrame:
    """NULL count per column over the trailing window [max - months, max]
    (inclusive, so up to months + 1 rows), per entity."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys)
    recent = (df.withColumn("_max", F.max(MONTH).over(w))
                .filter(F.col(MONTH) >= F.add_months(F.col("_max"), -months)))
    counts = recent.groupBy(*keys).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot(list(keys), list(cols), "column_name", "missing_values")


def recent_runs(log: DataFrame, n: int = 20, tie_break: Sequence[str] | None = None) -> DataFrame:
    """Top-n log rows, newest first (a top-k report: the limit is the feature).

    Rows of one start time are ordered by ``tie_break``, by default run and series."""
    ties = ("run_id", "series_id") if tie_break is None else tie_break
    order = [F.col("started_at").desc(), *[F.col(c).desc() for c in ties]]
    return log.orderBy(*order).limit(n)
