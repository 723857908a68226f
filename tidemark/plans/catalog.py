"""Registered queries: (spark, sf_dir) -> DataFrame, plus their DuckDB oracle SQL.

Every query reads the driver's tables through the fixture adapters in
``tidemark.sources.fixtures``, so its work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import align, dedup, load, marts, metrics, quality, serving, signals
from ..schemas import AS_IS, DEFAULT_SERIES, MAX_LENGTHS, MONTH, OBSERVATIONS, RISK_LEVELS, Thresholds
from ..sources import fixtures as fx
from ..sources import landing
from ..sources.tables import conform

FIX_T = Thresholds(**fx.FIXTURE_THRESHOLDS)
PANEL = ["entity"]
RUN_ID = "run-fixture"
NOW = "2024-02-01 00:00:00"          # load time stamped by the fixture upsert / load
FRESHNESS_NOW = "2024-02-02 00:00:00"
RANGE_FROM = "1998-01-01"            # dashboard date-range filter of the fixture
META_BATCH_FROM = "2001-01-01"       # loads from here on, of the series that sort below
META_BATCH_BELOW = "3"               # this, are the batch; all others are the target
CONTRACT_URL_LENGTH = 10             # so that some of the fixture's urls break the limit


# ---------------------------------------------------------------- builders

def _obs(spark, sf_dir, entity=None, series=None):
    return fx.econ_observations(spark, sf_dir, entity, series), (PANEL if entity else [])


def _wide(spark, sf_dir, entity=None):
    obs, keys = _obs(spark, sf_dir, entity)
    return align.monthly_wide(obs, start=fx.SPINE_START, as_of=fx.AS_OF, keys=keys), keys


def _metrics(spark, sf_dir, entity=None):
    wide, keys = _wide(spark, sf_dir, entity)
    return metrics.derived_metrics(wide, keys), keys


def _dashboard(spark, sf_dir, entity=None):
    m, keys = _metrics(spark, sf_dir, entity)
    return marts.economic_dashboard(m, FIX_T, keys), keys


def _panel(fn):
    def run(spark, sf_dir):
        return fn(spark, sf_dir, "priority")
    run.__name__ = f"panel_{fn.__name__}"
    return run


# ---------------------------------------------------------------- staging / load

def dedup_latest_observation(spark, sf_dir):
    raw = fx.revised_observations(spark, sf_dir)
    return dedup.stage_observations(raw, tie_break=[F.col("event_id").desc()])


def dedup_hot_keys(spark, sf_dir):
    """Latest load per key when each series holds a third of all loads."""
    raw = fx.hot_key_loads(spark, sf_dir)
    return dedup.stage_observations(raw, tie_break=[F.col("l_orderkey").desc(), F.col("l_linenumber").desc()])


def dedup_latest_metadata(spark, sf_dir):
    raw = fx.metadata_loads(spark, sf_dir)
    return dedup.stage_metadata(raw, tie_break=[F.col("o_orderkey").desc()])


def clean_missing_marker(spark, sf_dir):
    from ..functions.columns import is_bad_value, parse_value

    land = fx.landing_text(spark, sf_dir)
    return land.select("event_id", "series_id", "observation_date", "raw_value",
                       parse_value("raw_value").alias("value"), is_bad_value("raw_value").alias("is_bad"))


def _dim_with_events(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select(F.col("event_type").alias("series_id"))
    return load.series_dim(spark).select("series_id").unionByName(events).distinct()


def series_watermark(spark, sf_dir):
    raw = fx.revised_observations(spark, sf_dir)
    return load.watermarks(raw, _dim_with_events(spark, sf_dir))


def upsert_result(spark, sf_dir):
    target, batch = fx.revision_split(spark, sf_dir)
    return load.upsert(target, batch, now=NOW)


def upsert_recent_batch(spark, sf_dir):
    """Upsert of a 10 % batch (the last three days of loads) into the rest."""
    target, batch = fx.revision_split(spark, sf_dir, fx.REV_RECENT_TARGET_BEFORE, fx.REV_RECENT_BATCH_FROM)
    return load.upsert(target, batch, now=NOW)


def upsert_colocated(spark, sf_dir):
    """The upsert of a half batch into a table stored in buckets of its key: only the batch is shuffled."""
    from ..session import scratch_path
    from ..sources.bucketed import BucketedTable

    target, batch = fx.revision_split(spark, sf_dir)
    table = BucketedTable(spark, scratch_path(spark, "bucketed"), OBSERVATIONS, ["series_id", "observation_date"], 16)
    table.write(target)
    return table.merged(batch, NOW)


def replace_by_key_result(spark, sf_dir):
    """A batch of fresh metadata of some series replaces them; the other series keep all their loads."""
    raw = fx.metadata_loads(spark, sf_dir)
    in_batch = (F.col("ingested_at") >= F.lit(META_BATCH_FROM).cast("timestamp_ntz")) & (F.col("series_id") < META_BATCH_BELOW)
    batch = dedup.latest_per_key(raw.filter(in_batch), ["series_id"],
                                 [F.col("ingested_at").desc(), F.col("o_orderkey").desc()]).drop("o_orderkey")
    return load.replace_by_key(raw.filter(~in_batch).drop("o_orderkey"), batch, ["series_id"])


def merged_rows(spark, sf_dir):
    """Rows that an upsert of all loads merges: the distinct keys."""
    return load.merged_count(fx.revised_observations(spark, sf_dir))


def contract_violations(spark, sf_dir):
    """Raw loads that break the raw contract (short id limit), with defaults filled in."""
    raw = fx.revised_observations(spark, sf_dir).drop("event_id")
    limits = dict(MAX_LENGTHS["observations"], source_url=CONTRACT_URL_LENGTH)
    return conform(raw, OBSERVATIONS, {"ingested_at": F.lit(NOW).cast("timestamp_ntz")}, limits)[1]


def contract_rows(spark, sf_dir):
    raw = fx.revised_observations(spark, sf_dir).drop("event_id")
    limits = dict(MAX_LENGTHS["observations"], source_url=CONTRACT_URL_LENGTH)
    return conform(raw, OBSERVATIONS, {"ingested_at": F.lit(NOW).cast("timestamp_ntz")}, limits)[0]


def _two_contracts(spark, sf_dir):
    """A stored table whose partitions were written under two contracts, read under the later one."""
    from pyspark.sql import types as T

    from ..session import scratch_path
    from ..sources.snapshots import SnapshotTable

    first, second = fx.contract_loads(spark, sf_dir)
    fields = [T.StructField("series_id", T.StringType(), False), T.StructField("event_id", T.LongType(), False),
              T.StructField("observation_date", T.DateType(), False)]
    old = T.StructType([*fields, T.StructField("value", T.IntegerType())])
    new = T.StructType([*fields, T.StructField("value", T.DoubleType()), T.StructField("unit", T.StringType(), False)])
    path, part = scratch_path(spark, "contracts"), {"series_id": "series_id"}
    SnapshotTable(spark, path, old, part).replace(first)
    table = SnapshotTable(spark, path, new, part, [old], {"unit": "'count'"})
    table.replace(second, table.values(second), 1)
    return table.read_checked({"unit": fx.CONTRACT_UNIT_LENGTH})


def contract_upgrade_rows(spark, sf_dir):
    return _two_contracts(spark, sf_dir)[0]


def contract_upgrade_violations(spark, sf_dir):
    return _two_contracts(spark, sf_dir)[1]


def dashboard_month_range(spark, sf_dir):
    """Serving read of a range of months from a published panel mart, opening only the files of these months."""
    from ..session import scratch_path
    from ..sources import tables

    root = scratch_path(spark, "serving")
    tables.publish(_dashboard(spark, sf_dir, "supplier")[0], root, "marts", "economic_dashboard", cluster_by=[MONTH, *PANEL], lookups=PANEL)
    return tables.read_mart(spark, root, "economic_dashboard", lo=fx.SERVE_FROM, hi=fx.SERVE_TO)


def landing_rows(spark, sf_dir):
    """Payload documents of all events through the landing functions: the observation rows."""
    good, _ = landing.split_malformed(landing.parse_payloads(fx.landing_payloads(spark, sf_dir)))
    return landing.payload_rows(good)


def landing_malformed(spark, sf_dir):
    """The payload documents without observations, with the error they state."""
    bad = landing.split_malformed(landing.parse_payloads(fx.landing_payloads(spark, sf_dir)))[1]
    return bad.select("event_id", "series_id", "error_code", "error_message")


def _run(spark, sf_dir):
    land = fx.landing_text(spark, sf_dir).drop("event_id")
    return load.run_load(land, _dim_with_events(spark, sf_dir), now=NOW, run_id=RUN_ID)


def load_batch(spark, sf_dir):
    return _run(spark, sf_dir)[0]


def malformed_split(spark, sf_dir):
    """The quarantined side: landed rows of series that failed to load."""
    land = fx.landing_text(spark, sf_dir)
    log = _run(spark, sf_dir)[1]
    failed = log.filter(F.col("status") == "FAILED").select("series_id")
    return land.join(failed, "series_id", "left_semi")


def load_log(spark, sf_dir):
    return _run(spark, sf_dir)[1]


def run_summary(spark, sf_dir):
    return load.run_summary(_run(spark, sf_dir)[1])


def raw_row_counts(spark, sf_dir):
    return load.table_counts({"OBSERVATIONS": fx.revised_observations(spark, sf_dir),
                              "SERIES_METADATA": fx.metadata_loads(spark, sf_dir),
                              "INGESTION_LOG": fx.run_log(spark, sf_dir)})


# ---------------------------------------------------------------- alignment

def month_spine(spark, sf_dir):
    """Per-entity month calendar over each entity's own order-date range."""
    o = fx.table(spark, sf_dir, "orders")
    bounds = o.groupBy(F.col("o_orderpriority").alias("entity")).agg(
        F.min(F.trunc("o_orderdate", "MM")).alias("lo"), F.max(F.trunc("o_orderdate", "MM")).alias("hi"))
    return bounds.select("entity", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias(MONTH))


def monthly_pivot(spark, sf_dir, entity=None):
    obs, keys = _obs(spark, sf_dir, entity, [s.series_id for s in DEFAULT_SERIES if s.align == AS_IS])
    return align.pivot_series(obs, DEFAULT_SERIES, keys)


def gdp_forward_fill(spark, sf_dir, entity=None):
    obs, keys = _obs(spark, sf_dir, entity, ["GDP"])
    return align.forward_filled(obs, "GDP", "gdp", fx.SPINE_START, fx.AS_OF, keys)


def month_end_daily(spark, sf_dir, entity=None):
    obs, keys = _obs(spark, sf_dir, entity, ["T10Y2Y"])
    return align.month_end_values(obs, "T10Y2Y", "treasury_spread_10y2y", keys)


def monthly_wide(spark, sf_dir, entity=None):
    return _wide(spark, sf_dir, entity)[0]


# ---------------------------------------------------------------- metrics / signals / marts

def mom_yoy_changes(spark, sf_dir, entity=None):
    wide, keys = _wide(spark, sf_dir, entity)
    return metrics.changes(wide, keys)


def pct_changes(spark, sf_dir, entity=None):
    wide, keys = _wide(spark, sf_dir, entity)
    return metrics.pct_changes(wide, keys)


def rolling_avgs(spark, sf_dir, entity=None):
    wide, keys = _wide(spark, sf_dir, entity)
    return metrics.rolling_avgs(wide, keys)


def rolling_low(spark, sf_dir, entity=None):
    wide, keys = _wide(spark, sf_dir, entity)
    return metrics.rolling_low(wide, keys)


def derived_metrics(spark, sf_dir, entity=None):
    return _metrics(spark, sf_dir, entity)[0]


def recession_signals(spark, sf_dir, entity=None):
    m, keys = _metrics(spark, sf_dir, entity)
    return signals.recession_signals(m, FIX_T, keys)


def signal_flags(spark, sf_dir, entity=None):
    m, keys = _metrics(spark, sf_dir, entity)
    return signals.with_signals(m, FIX_T).select(*keys, MONTH, "sahm_rule_value", *signals.SIGNAL_FLAGS)


def signal_count_level(spark, sf_dir, entity=None):
    m, keys = _metrics(spark, sf_dir, entity)
    return signals.with_signals(m, FIX_T).select(*keys, MONTH, "recession_signal_count", "recession_risk_level")


def economic_dashboard(spark, sf_dir, entity=None):
    return _dashboard(spark, sf_dir, entity)[0]


def supplier_economic_dashboard(spark, sf_dir):
    return economic_dashboard(spark, sf_dir, "supplier")


def _revised_panel(spark, sf_dir):
    """A stored supplier panel: a first load, then the batch applied to what it touches."""
    from ..session import scratch_path
    from .incremental import Panel

    first, batch = fx.panel_revision(spark, sf_dir)
    panel = Panel(spark, scratch_path(spark, "panel"), PANEL, thresholds=FIX_T, start=fx.SPINE_START, buckets=16)
    panel.load(first, fx.AS_OF, NOW)
    panel.load(batch, fx.AS_OF, NOW)
    return panel


def incremental_dashboard(spark, sf_dir):
    """The dashboard of a stored panel after an incremental load."""
    return _revised_panel(spark, sf_dir).dashboard()


def summary_from_states(spark, sf_dir):
    """The summary of the stored panel, merged from its states per supplier and year."""
    return _revised_panel(spark, sf_dir).summary()


def reconcile_from_bitmaps(spark, sf_dir):
    """Distinct observation dates (date bits) against month rows of the stored panel, per supplier."""
    return _revised_panel(spark, sf_dir).reconciliation()


def indicator_summary(spark, sf_dir, entity=None):
    d, keys = _dashboard(spark, sf_dir, entity)
    return marts.indicator_summary(d, keys)


# ---------------------------------------------------------------- hot keys, as-of

def hot_rolling(spark, sf_dir):
    """Lags, growth and rolling frames over keys that hold a third of all rows each, cut into ranges."""
    from ..functions.columns import lag_diff, pct_change, rolling
    from ..operators.split_windows import RangeSplit

    columns = {"change_1": lambda w: lag_diff("cents", 1, w), "change_12": lambda w: lag_diff("cents", 12, w),
               "avg_3": lambda w: rolling("cents", "avg", 3, w), "low_12": lambda w: rolling("cents", "min", 12, w),
               "growth_3": lambda w: pct_change("cents", 3, 100, w)}
    out = RangeSplit(fx.hot_lines(spark, sf_dir), ["l_returnflag"], fx.HOT_ORDER).apply(columns, back=12)
    return out.select("l_returnflag", "l_orderkey", "l_linenumber", "l_shipdate", "cents", *columns)


def hot_forward_fill(spark, sf_dir):
    """The last price without a discount carried over each hot key's lines."""
    from ..operators.split_windows import RangeSplit

    lines = fx.hot_lines(spark, sf_dir).withColumn("full_price", F.when(F.col("l_discount") == 0, F.col("cents")))
    out = RangeSplit(lines, ["l_returnflag"], fx.HOT_ORDER).fill(["full_price"])
    return out.select("l_returnflag", "l_orderkey", "l_linenumber", "l_shipdate", "cents", "full_price")


def asof_daily_quarterly(spark, sf_dir):
    """Every daily value with the last quarterly report of its entity, if it is recent enough."""
    from ..operators.asof import asof_join

    daily = fx.econ_observations(spark, sf_dir, "priority", ["T10Y2Y"]).select("entity", "observation_date", "value")
    return asof_join(daily, fx.quarterly_reports(spark, sf_dir), ["entity"], "observation_date", "reported",
                     {"reported": "reported", "gdp": "level"}, within=F.expr(f"INTERVAL {fx.ASOF_DAYS} DAY"), tie=["revision"])


def asof_events(spark, sf_dir):
    """Errors with the user's purchase before, after and nearest to them (within two days); times are unaligned."""
    from ..operators.asof import asof_join

    e = fx.table(spark, sf_dir, "events")
    errors = e.where("event_type = 'error'").select("event_id", "user_id", "ts")
    bought = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("purchase"))
    out = asof_join(errors, bought, ["user_id"], "ts", "at", {"last_purchase": "purchase"})
    out = asof_join(out, bought, ["user_id"], "ts", "at", {"next_purchase": "purchase"}, "forward", F.expr("INTERVAL 5 DAY"))
    return asof_join(out, bought, ["user_id"], "ts", "at", {"nearest_purchase": "purchase"}, "nearest", F.expr("INTERVAL 2 DAY"))


# ---------------------------------------------------------------- data quality

def dq_unique(spark, sf_dir):
    return quality.unique(fx.revised_observations(spark, sf_dir), ["series_id", "observation_date"])


def dq_not_null(spark, sf_dir):
    raw = fx.revised_observations(spark, sf_dir)
    return quality.not_null(raw, "value").select("series_id", "observation_date", "source_url")


def dq_accepted_values(spark, sf_dir):
    staged = dedup_latest_observation(spark, sf_dir)
    bad = quality.accepted_values(staged, "series_id", [s.series_id for s in DEFAULT_SERIES])
    return bad.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_rows"))


def dq_range(spark, sf_dir):
    sig = recession_signals(spark, sf_dir)
    return quality.in_range(sig, "sahm_rule_value", 0, 10).select(MONTH, "sahm_rule_value")


def dq_row_reconcile(spark, sf_dir, entity=None):
    from ..operators import states

    obs, keys = _obs(spark, sf_dir, entity)
    values = align.monthly_values(obs, keys=keys, dates_of="UNRATE")
    return states.reconcile(values, align.DATES, "_n_monthly", keys=keys)


def dq_freshness(spark, sf_dir):
    return quality.freshness(fx.revised_observations(spark, sf_dir), "ingested_at", FRESHNESS_NOW)


def dq_report(spark, sf_dir):
    d, _ = _dashboard(spark, sf_dir)
    return quality.check_report(d, [
        ("month_not_null", "not_null", MONTH),
        ("risk_level_accepted", "accepted_values", "recession_risk_level", RISK_LEVELS),
        ("sahm_in_range", "in_range", "sahm_rule_value", 0, 10),
        ("unemployment_not_null", "not_null", "unemployment_rate"),
    ])


def dq_suite(spark, sf_dir):
    """Every data test of every layer as one suite over the FX-ECON chain (metadata FX-META, freshness on FX-REV).

    Each layer is written once to the shared folder, as a stored run does; the tests read what was written."""
    from ..session import cut_lineage
    from .layers import data_tests

    obs = fx.econ_observations(spark, sf_dir).withColumns(
        {"ingested_at": F.lit(NOW).cast("timestamp_ntz"), "source_url": F.lit("fixture")})
    staged = cut_lineage(dedup.stage_observations(obs))
    wide = cut_lineage(align.monthly_wide(staged, start=fx.SPINE_START, as_of=fx.AS_OF))
    changes = cut_lineage(metrics.derived_metrics(wide))
    sig = cut_lineage(signals.recession_signals(changes, FIX_T))
    dash = cut_lineage(marts.economic_dashboard(changes, FIX_T))
    summary = cut_lineage(marts.indicator_summary(dash))
    meta = cut_lineage(dedup_latest_metadata(spark, sf_dir))
    tests = data_tests(staged, wide, changes, sig, dash, summary, meta,
                       fx.revised_observations(spark, sf_dir), DEFAULT_SERIES, [], FRESHNESS_NOW)
    return quality.suite(tests)


# ---------------------------------------------------------------- serving

def observation_counts(spark, sf_dir, entity=None):
    d, keys = _dashboard(spark, sf_dir, entity)
    return serving.observation_counts(d, keys=keys)


def completeness_24m(spark, sf_dir, entity=None):
    d, keys = _dashboard(spark, sf_dir, entity)
    return serving.completeness(d, keys=keys)


def recent_runs_top20(spark, sf_dir):
    return serving.recent_runs(fx.run_log(spark, sf_dir), 20, tie_break=["event_id"])


def kpi_table(spark, sf_dir, entity=None):
    s = indicator_summary(spark, sf_dir, entity)
    return serving.kpi_table(s, PANEL if entity else [])


def current_risk(spark, sf_dir, entity=None):
    d, keys = _dashboard(spark, sf_dir, entity)
    return serving.current_risk(d, keys)


def signal_status(spark, sf_dir, entity=None):
    d, keys = _dashboard(spark, sf_dir, entity)
    return serving.signal_status(d, keys)


OVERVIEW_COLUMNS = ("unemployment_rate", "inflation_rate_yoy", "fed_funds_rate", "consumer_sentiment")


def range_series(spark, sf_dir):
    d, _ = _dashboard(spark, sf_dir)
    return serving.range_series(d, OVERVIEW_COLUMNS, lo=RANGE_FROM)


def sahm_history(spark, sf_dir):
    d, _ = _dashboard(spark, sf_dir)
    return serving.range_series(d, ["sahm_rule_value"], lo=RANGE_FROM, drop_null=["sahm_rule_value"])


def gdp_history(spark, sf_dir):
    d, _ = _dashboard(spark, sf_dir)
    return serving.range_series(d, ["gdp", "gdp_qoq_growth_rate"], lo=RANGE_FROM,
                                drop_null=["gdp_qoq_growth_rate"])


def _chart(name):
    def run(spark, sf_dir):
        d, _ = _dashboard(spark, sf_dir)
        return serving.chart_series(d, name, lo=RANGE_FROM)
    run.__name__ = f"chart_{name}"
    return run


# V5, V7-V11 and the GDP level chart (overview, sahm and GDP growth are registered above)
CHARTS = ("signal_count", "unemployment", "inflation", "fed_funds", "sentiment", "treasury_spread", "gdp_level")


def month_bounds(spark, sf_dir, entity=None):
    d, keys = _dashboard(spark, sf_dir, entity)
    return serving.month_bounds(d, keys)


# ---------------------------------------------------------------- registry

_PANEL_VARIANTS = (monthly_pivot, gdp_forward_fill, month_end_daily, monthly_wide, mom_yoy_changes,
                   pct_changes, rolling_avgs, rolling_low, derived_metrics, recession_signals,
                   signal_flags, signal_count_level, economic_dashboard, indicator_summary,
                   observation_counts, completeness_24m, kpi_table, current_risk, signal_status,
                   month_bounds, dq_row_reconcile)

_PLAIN = (dedup_latest_observation, dedup_hot_keys, dedup_latest_metadata, clean_missing_marker, series_watermark,
          upsert_result, upsert_recent_batch, upsert_colocated, replace_by_key_result, load_batch, malformed_split, load_log, run_summary,
          raw_row_counts, merged_rows, contract_rows, contract_violations, landing_rows, landing_malformed, month_spine, *_PANEL_VARIANTS, supplier_economic_dashboard, contract_upgrade_rows, contract_upgrade_violations, dashboard_month_range,
          incremental_dashboard, summary_from_states, reconcile_from_bitmaps,
          hot_rolling, hot_forward_fill, asof_daily_quarterly, asof_events,
          dq_unique, dq_not_null, dq_accepted_values, dq_range, dq_freshness,
          dq_report, dq_suite, recent_runs_top20, range_series, sahm_history, gdp_history)


def _plain(fn):
    def run(spark, sf_dir):
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {fn.__name__: _plain(fn) for fn in _PLAIN}
    out.update({f"chart_{c}": _chart(c) for c in CHARTS})
    out.update({f"panel_{fn.__name__}": _panel(fn) for fn in _PANEL_VARIANTS})
    return out


def oracle_sql() -> dict[str, str]:
    from .oracle_catalog import ORACLE

    return dict(ORACLE())
