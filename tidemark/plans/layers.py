"""Layered run: load -> staging -> intermediate -> marts -> tests, in one application.

Each layer is a DataFrame function of the layer below. By default every layer
is written to the shared folder: the staged observations feed the wide table
and five data tests, so as views the dedup over the whole raw table would be
recomputed by each consumer; written once, each consumer reads the result,
and a lost executor never recomputes from raw. ``RunConfig.views=True`` keeps
staging and intermediate as temp views (the modelled layout). Marts are
written, audited, then published. The summary reads the *written* dashboard.
A failing layer stops the run.

SURVEY §2: S12, S16, S19, D10, and the data tests of §2.10.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import align, dedup, load, marts, metrics, quality, signals
from ..schemas import (DEFAULT_SERIES, DEFAULT_START_DATE, MONTH, RISK_LEVELS, SERIES_METADATA, SeriesSpec, Thresholds,
                       observations_contract)
from ..session import cut_lineage
from ..sources import landing as landing_src
from ..sources import tables

LAYER_ORDER = ("load", "staging", "intermediate", "marts", "tests")


@dataclass
class RunConfig:
    root: str                                   # shared folder holding all layers
    landing_obs: str | None = None              # folder of observation payloads
    landing_meta: str | None = None             # folder of metadata payloads
    specs: Sequence[SeriesSpec] = DEFAULT_SERIES
    thresholds: Thresholds = field(default_factory=Thresholds)
    start: str = DEFAULT_START_DATE             # first month of the calendar spine
    load_start: str = DEFAULT_START_DATE        # first observation date fetched on a full load
    as_of: str | None = None
    now: str | None = None
    incremental: bool = False
    run_id: str | None = None
    keys: Sequence[str] = ()
    views: bool = False                         # staging/intermediate as temp views instead of tables


class LayerFailed(RuntimeError):
    pass


def _raw(spark, cfg, name):
    return tables.layer_path(cfg.root, "raw", name)


def load_layer(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Read landed payloads, upsert observations, replace metadata, append the log.

    The log is written whatever fails: a series with a bad row, a malformed
    payload or bad metadata is marked FAILED and the others are loaded."""
    return load_batch(spark, cfg)[0]


def load_batch(spark: SparkSession, cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """``load_layer``'s work; returns the log and the batch that was merged."""
    keys = list(cfg.keys)
    obs_path = _raw(spark, cfg, "observations")
    dim = load.series_dim(spark, cfg.specs)
    rows, malformed = landing_src.read_observation_landing(spark, cfg.landing_obs, keys)
    target = tables.read_observations(spark, obs_path, keys) if tables.has_observations(spark, obs_path) else None
    batch, log = load.run_load(rows, dim, target, cfg.incremental, cfg.now, cfg.run_id, malformed,
                               cfg.load_start, keys, materialise=True)
    tables.upsert_table(spark, obs_path, batch, keys, now=cfg.now)
    if cfg.landing_meta:
        meta = cut_lineage(landing_src.read_metadata_landing(spark, cfg.landing_meta, cfg.now))
        bad = meta.filter("bad_metadata").select("series_id", F.lit("metadata: last_updated does not parse").alias("error"))
        good = log.filter(F.col("status") == "SUCCESS").select("series_id")
        meta = meta.filter(~F.col("bad_metadata")).drop("bad_metadata").join(good, "series_id", "left_semi")
        log = cut_lineage(load.with_failures(log, bad))
        old = tables.read_current(spark, cfg.root, "raw", "series_metadata", SERIES_METADATA)
        new = meta if old is None else load.replace_by_key(old, meta, ["series_id"])
        tables.publish(new, cfg.root, "raw", "series_metadata")
    tables.append_log(log, _raw(spark, cfg, "ingestion_log"))
    return log, batch


def _mode(cfg: RunConfig) -> str:
    return "view" if cfg.views else "table"


def _read(spark: SparkSession, cfg: RunConfig, layer: str, name: str) -> DataFrame:
    if cfg.views:
        return tables.layer_table(spark, cfg.root, layer, name)
    return tables.read_current(spark, cfg.root, layer, name, _staged_contract(cfg) if (layer, name) == STAGED else None)


STAGED = ("staging", "observations")


def _staged_contract(cfg: RunConfig) -> T.StructType:
    """Staged observations are partitioned by series id, which must stay text."""
    fields = observations_contract(cfg.keys).fields
    return T.StructType([T.StructField("observation_id", T.StringType()), *fields])


def staging_layer(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    raw = tables.read_observations(spark, _raw(spark, cfg, "observations"), cfg.keys)
    staged = tables.publish(dedup.stage_observations(raw, keys=list(cfg.keys)), cfg.root, "staging", "observations",
                            as_=_mode(cfg), partition_by=None if cfg.views else ["series_id"])
    meta = tables.read_current(spark, cfg.root, "raw", "series_metadata", SERIES_METADATA)
    if meta is not None:
        tables.publish(dedup.stage_metadata(meta), cfg.root, "staging", "series_metadata", as_=_mode(cfg))
    return staged


def intermediate_layer(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    staged = _read(spark, cfg, "staging", "observations")
    keys = list(cfg.keys)
    wide = tables.publish(align.monthly_wide(staged, cfg.specs, cfg.start, cfg.as_of, keys),
                          cfg.root, "intermediate", "indicators_wide", as_=_mode(cfg))
    m = tables.publish(metrics.derived_metrics(wide, keys), cfg.root, "intermediate",
                       "indicators_with_changes", as_=_mode(cfg))
    tables.publish(signals.recession_signals(m, cfg.thresholds, keys), cfg.root, "intermediate",
                   "recession_signals", as_=_mode(cfg))
    return m


def mart_audit(keys) -> quality.Watch:
    return quality.Watch([("month_not_null", "not_null", MONTH), ("risk_level_accepted", "accepted_values", "recession_risk_level", RISK_LEVELS)],
                         [*keys, MONTH])


def marts_layer(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    keys = list(cfg.keys)
    m = _read(spark, cfg, "intermediate", "indicators_with_changes")
    dash = marts.economic_dashboard(m, cfg.thresholds, keys)
    # served by ranges of months, looked up by entity
    written = tables.publish(dash, cfg.root, "marts", "economic_dashboard", audit=mart_audit(keys),
                             cluster_by=[MONTH, *keys], lookups=keys)
    summary = marts.indicator_summary(written, keys)
    tables.publish(summary, cfg.root, "marts", "indicator_summary")
    return written


def data_tests(staged: DataFrame, wide: DataFrame, changes: DataFrame, sig: DataFrame, dash: DataFrame,
               summary: DataFrame, meta: DataFrame | None, raw: DataFrame | None, specs, keys, now=None) -> list[tuple]:
    """The 23 data tests of all layers and the freshness of raw, as ``quality.suite`` checks.

    Row-level and uniqueness tests name their table, so the suite folds all
    tests of one table into one pass; reconciliation and freshness carry their
    own violation frames. Without metadata its three tests are left out.
    """
    Q = quality
    ids = [s.series_id for s in specs]
    month = [*keys, MONTH]
    tests = [
        ("observation_id_unique", "staging", "error", staged, Q.Unique(["observation_id"])),
        ("observation_id_not_null", "staging", "error", staged, Q.null_rows("observation_id")),
        ("series_id_accepted", "staging", "error", staged, Q.outside("series_id", ids)),
        ("series_id_not_null", "staging", "error", staged, Q.null_rows("series_id")),
        ("observation_date_not_null", "staging", "error", staged, Q.null_rows("observation_date")),
        ("value_not_null", "staging", "error", staged, Q.null_rows("value")),
        ("wide_month_unique", "intermediate", "error", wide, Q.Unique(month)),
        ("wide_month_not_null", "intermediate", "error", wide, Q.null_rows(MONTH)),
        ("changes_month_unique", "intermediate", "error", changes, Q.Unique(month)),
        ("changes_month_not_null", "intermediate", "error", changes, Q.null_rows(MONTH)),
        ("signals_month_unique", "intermediate", "error", sig, Q.Unique(month)),
        ("signals_month_not_null", "intermediate", "error", sig, Q.null_rows(MONTH)),
        ("signals_level_accepted", "intermediate", "error", sig, Q.outside("recession_risk_level", RISK_LEVELS)),
        ("sahm_rule_value_in_range", "intermediate", "error", sig, Q.out_of_range("sahm_rule_value", 0, 10)),
        ("staging_to_intermediate_row_count", "intermediate", "error",
         Q.staging_reconcile(staged, wide, keys=keys).filter("failed")),
        ("dashboard_month_unique", "marts", "error", dash, Q.Unique(month)),
        ("dashboard_month_not_null", "marts", "error", dash, Q.null_rows(MONTH)),
        ("dashboard_level_accepted", "marts", "error", dash, Q.outside("recession_risk_level", RISK_LEVELS)),
        ("summary_latest_not_null", "marts", "error", summary, Q.null_rows("latest_month")),
        ("summary_level_accepted", "marts", "error", summary, Q.outside("current_risk_level", RISK_LEVELS)),
    ]
    if meta is not None:
        tests += [("metadata_series_id_unique", "staging", "error", meta, Q.Unique(["series_id"])),
                  ("metadata_series_id_not_null", "staging", "error", meta, Q.null_rows("series_id")),
                  ("metadata_title_not_null", "staging", "error", meta, Q.null_rows("series_title"))]
    if raw is not None and now is not None:
        tests.append(("observations_freshness", "raw", "warn", Q.freshness_violations(raw, "ingested_at", now)))
    return tests


def tests_layer(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Data tests over raw, staging, intermediate and marts, as one suite.

    Returns the report (test_name, layer, severity, n_failed); failing rows of
    each failing test are stored under ``dq_failures``; raises if a test of
    severity ``error`` fails (``warn`` only reports).
    """
    keys = list(cfg.keys)
    raw_path = _raw(spark, cfg, "observations")
    raw = tables.read_observations(spark, raw_path, keys) if tables.has_observations(spark, raw_path) else None
    has_meta = tables.read_current(spark, cfg.root, "raw", "series_metadata") is not None
    tests = data_tests(_read(spark, cfg, "staging", "observations"),
                       _read(spark, cfg, "intermediate", "indicators_wide"),
                       _read(spark, cfg, "intermediate", "indicators_with_changes"),
                       _read(spark, cfg, "intermediate", "recession_signals"),
                       tables.read_current(spark, cfg.root, "marts", "economic_dashboard"),
                       tables.read_current(spark, cfg.root, "marts", "indicator_summary"),
                       _read(spark, cfg, "staging", "series_metadata") if has_meta else None,
                       raw, cfg.specs, keys, cfg.now)
    report = quality.suite(tests)
    rows = report.collect()                      # one row per test
    by_name = {t[0]: t for t in tests}
    failed = [r for r in rows if r.n_failed]
    for r in failed:
        quality.write_failures(quality.violations_of(by_name[r.test_name]), cfg.root, r.test_name)
    errors = [r.test_name for r in failed if r.severity == "error"]
    if errors:
        raise LayerFailed("data tests failed: " + ", ".join(errors))
    return spark.createDataFrame(rows, report.schema)


_LAYERS = {"load": load_layer, "staging": staging_layer, "intermediate": intermediate_layer,
           "marts": marts_layer, "tests": tests_layer}


def run_layers(spark: SparkSession, cfg: RunConfig, layers: Sequence[str] = LAYER_ORDER) -> dict:
    """Run the selected layers in order; the first failure stops the run.

    The load raises after all series are processed if any series failed;
    the good series stay loaded (per-series isolation).
    """
    from ..session import ensure_checkpoint_dir, size_shuffles

    ensure_checkpoint_dir(spark)
    size_shuffles(spark, [p for p in (cfg.landing_obs, _raw(spark, cfg, "observations")) if p])
    if "://" not in cfg.root:
        os.makedirs(cfg.root, exist_ok=True)
    out = {}
    for name in LAYER_ORDER:
        if name not in layers:
            continue
        out[name] = _LAYERS[name](spark, cfg)
        if name == "load":
            load.raise_if_failed(out[name])
    return out
