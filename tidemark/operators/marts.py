"""Dashboard mart (one row per entity-month) and the indicator summary.

SURVEY §2: J4, J5, P6-P8, P13, A2, A3, M6, M7.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import MONTH, WIDE_COLUMNS, Thresholds
from .metrics import METRIC_COLUMNS
from .signals import SIGNAL_FLAGS, with_signals

# Dashboard columns after the month, in the order of the reference mart
# (the 12-month low is not published).
DASHBOARD_COLUMNS = (
    *WIDE_COLUMNS,
    *[c for c in METRIC_COLUMNS if c != "unemployment_rate_12m_low"],
    "sahm_rule_value", *SIGNAL_FLAGS, "recession_signal_count", "recession_risk_level",
)


def economic_dashboard(metrics: DataFrame, t: Thresholds = Thresholds(),
                       keys: Sequence[str] = ()) -> DataFrame:
    """Metrics and signals side by side. Signals are columns of the same rows,
    so no self-join on the month is needed."""
    return with_signals(metrics, t).select(*keys, MONTH, *DASHBOARD_COLUMNS)


# (output prefix, dashboard column) for the summary's four indicators.
_SUMMARY_INDICATORS = (
    ("unemployment", "unemployment_rate"),
    ("inflation", "inflation_rate_yoy"),
    ("fed_funds", "fed_funds_rate"),
    ("sentiment", "consumer_sentiment"),
)

SUMMARY_COLUMNS = (
    "latest_month", "current_risk_level", "active_signals",
    *[f"{p}_{s}" for p, _ in _SUMMARY_INDICATORS
      for s in ("current", "previous", "mom_change", "min", "max", "avg")],
)


def indicator_summary(dashboard: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Latest values, calendar-previous values and history per entity.

    "Latest" is the last month with an unemployment value; "previous" is the
    calendar month before it. If that month is absent, the entity has no row
    (inner-join semantics). History covers months with an unemployment value.

    Plan: one keyed window (previous row = calendar previous month iff it is
    the positionally previous row, since months are unique and ordered), then
    one keyed aggregate with ``max_by`` picks. The aggregate reuses the
    window's partitioning, so the whole summary adds no shuffle of its own.
    """
    keys = list(keys)
    m = F.col(MONTH)
    w = Window.partitionBy(*keys).orderBy(m.asc())
    has_prev = F.lag(m, 1).over(w) == F.add_months(m, -1)
    u = F.col("unemployment_rate")
    pick = F.when(u.isNotNull(), m)  # ordering for max_by; NULL rows are skipped
    prev_cols = {f"_prev_{c}": F.when(has_prev, F.lag(c, 1).over(w)) for _, c in _SUMMARY_INDICATORS}
    rows = dashboard.select(*keys, MONTH, "recession_risk_level", "recession_signal_count",
                            *[c for _, c in _SUMMARY_INDICATORS],
                            has_prev.alias("_has_prev"),
                            *[v.alias(k) for k, v in prev_cols.items()])
    aggs = [F.max(pick).alias("latest_month"),
            F.max_by("recession_risk_level", pick).alias("current_risk_level"),
            F.max_by("recession_signal_count", pick).alias("active_signals"),
            F.max_by("_has_prev", pick).alias("_has_prev")]
    for p, c in _SUMMARY_INDICATORS:
        hist = F.when(u.isNotNull(), F.col(c))
        aggs += [F.max_by(c, pick).alias(f"{p}_current"),
                 F.max_by(f"_prev_{c}", pick).alias(f"{p}_previous"),
                 F.min(hist).alias(f"{p}_min"), F.max(hist).alias(f"{p}_max"),
                 F.round(F.avg(hist), 2).alias(f"{p}_avg")]
    agg = rows.groupBy(*keys).agg(*aggs)
    agg = agg.filter(F.col("latest_month").isNotNull() & F.col("_has_prev"))
    diffs = {f"{p}_mom_change": F.col(f"{p}_current") - F.col(f"{p}_previous")
             for p, _ in _SUMMARY_INDICATORS}
    return agg.select(*keys, *[diffs[c].alias(c) if c in diffs else F.col(c)
                               for c in SUMMARY_COLUMNS])
