"""Recession-warning signals and the composite risk level (pure projections).

SURVEY §2: G1-G7, P14, F9, F10, M5.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag
from ..schemas import MONTH, RISK_LEVELS, Thresholds

SIGNAL_FLAGS = ("signal_sahm_rule", "signal_yield_curve_inverted", "signal_high_inflation",
                "signal_low_sentiment", "signal_fed_tightening")


def risk_level(count: Column, t: Thresholds = Thresholds()) -> Column:
    high, elevated, moderate = t.level_cuts
    low, mod, elev, hi = RISK_LEVELS
    return (F.when(count >= high, F.lit(hi))
             .when(count >= elevated, F.lit(elev))
             .when(count >= moderate, F.lit(mod))
             .otherwise(F.lit(low)))


def with_signals(metrics: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Add Sahm value, five 0/1 flags, their count and the risk level."""
    sahm_gap = F.col("unemployment_rate_3m_avg") - F.col("unemployment_rate_12m_low")
    flags = {
        # the flag uses the unrounded gap; the reported value is rounded
        "signal_sahm_rule": flag(sahm_gap >= F.lit(t.sahm_rule)),
        "signal_yield_curve_inverted": flag(F.col("treasury_spread_10y2y") < F.lit(t.yield_curve)),
        "signal_high_inflation": flag(F.col("inflation_rate_yoy") > F.lit(t.high_inflation)),
        "signal_low_sentiment": flag(F.col("consumer_sentiment") < F.lit(t.low_sentiment)),
        "signal_fed_tightening": flag(F.col("fed_funds_rate_yoy_change") >= F.lit(t.fed_tightening)),
    }
    # the count is computed once per row by common-subexpression elimination
    count = sum((F.coalesce(flags[c], F.lit(0)) for c in SIGNAL_FLAGS[1:]),
                F.coalesce(flags[SIGNAL_FLAGS[0]], F.lit(0)))
    return metrics.withColumns({"sahm_rule_value": F.round(sahm_gap, 2), **flags,
                                "recession_signal_count": count,
                                "recession_risk_level": risk_level(count, t)})


SIGNAL_MODEL_COLUMNS = (
    "unemployment_rate_3m_avg", "unemployment_rate_12m_low", "sahm_rule_value", "signal_sahm_rule",
    "treasury_spread_10y2y", "signal_yield_curve_inverted",
    "inflation_rate_yoy", "signal_high_inflation",
    "consumer_sentiment", "signal_low_sentiment",
    "fed_funds_rate_yoy_change", "signal_fed_tightening",
    "recession_signal_count", "recession_risk_level",
)


def recession_signals(metrics: DataFrame, t: Thresholds = Thresholds(),
                      keys: Sequence[str] = ()) -> DataFrame:
    """The signal model: month, inputs, flags, count and level."""
    return with_signals(metrics, t).select(*keys, MONTH, *SIGNAL_MODEL_COLUMNS)
