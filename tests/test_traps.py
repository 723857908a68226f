"""Hand-made frames with hand-computed answers for the semantic traps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import align, dedup, load, marts, metrics, quality, serving, signals
from tidemark.schemas import Thresholds

D = dt.date


def obs(spark, rows):
    return spark.createDataFrame(rows, "series_id string, observation_date date, value double")


def by_month(df, col):
    return {r.observation_month: r[col] for r in df.collect()}


# ---------------------------------------------------------------- staging

def raw_loads(spark, rows):
    return spark.createDataFrame(
        rows, "series_id string, observation_date date, value double, ingested_at timestamp_ntz, "
              "source_url string, load_id int")


def test_null_latest_load_retracts_key(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    raw = raw_loads(spark, [
        ("A", D(2024, 1, 1), 1.0, t1, "u", 1),
        ("A", D(2024, 1, 1), None, t2, "u", 2),    # latest load is NULL -> key disappears
        ("A", D(2024, 2, 1), None, t1, "u", 3),
        ("A", D(2024, 2, 1), 5.0, t2, "u", 4),     # latest load has a value -> kept
    ])
    out = dedup.stage_observations(raw, [F.col("load_id").desc()]).collect()
    assert [(r.observation_date, r.value) for r in out] == [(D(2024, 2, 1), 5.0)]


def test_null_ingested_at_sorts_first_and_tie_break(spark):
    t = dt.datetime(2024, 1, 5)
    raw = raw_loads(spark, [
        ("A", D(2024, 1, 1), 1.0, t, "u", 1),
        ("A", D(2024, 1, 1), 2.0, None, "u", 2),   # NULL load time counts as newest
        ("B", D(2024, 1, 1), 3.0, t, "u", 3),
        ("B", D(2024, 1, 1), 4.0, t, "u", 4),      # tie on time -> higher load_id wins
    ])
    out = {r.series_id: r.value for r in dedup.stage_observations(raw, [F.col("load_id").desc()]).collect()}
    assert out == {"A": 2.0, "B": 4.0}


def test_stage_metadata_renames_and_keeps_latest(spark):
    raw = spark.createDataFrame([
        ("A", "old", "Monthly", "u", "sa", None, dt.datetime(2024, 1, 1)),
        ("A", "new", "Monthly", "u", "sa", None, dt.datetime(2024, 1, 2)),
    ], "series_id string, title string, frequency string, units string, seasonal_adj string, "
       "last_updated timestamp_ntz, ingested_at timestamp_ntz")
    out = dedup.stage_metadata(raw).collect()
    assert len(out) == 1 and out[0].series_title == "new" and out[0].data_frequency == "Monthly"


# ---------------------------------------------------------------- alignment

def test_month_with_only_daily_data_is_dropped(spark):
    o = obs(spark, [("UNRATE", D(2020, 1, 1), 4.0),
                    ("T10Y2Y", D(2020, 1, 15), 0.5), ("T10Y2Y", D(2020, 1, 31), 0.7),
                    ("T10Y2Y", D(2020, 2, 10), 0.9)])   # February: daily only
    wide = align.monthly_wide(o, start="2020-01-01", as_of="2020-12-31").collect()
    assert [r.observation_month for r in wide] == [D(2020, 1, 1)]
    assert wide[0].treasury_spread_10y2y == 0.7        # last available day of the month


def test_value_before_spine_does_not_seed_fill(spark):
    o = obs(spark, [("GDP", D(2019, 10, 1), 100.0),
                    ("UNRATE", D(2019, 12, 1), 4.0), ("UNRATE", D(2020, 1, 1), 4.0),
                    ("UNRATE", D(2020, 4, 1), 4.0), ("GDP", D(2020, 4, 1), 110.0),
                    ("UNRATE", D(2020, 5, 1), 4.0), ("UNRATE", D(2021, 1, 1), 4.0)])
    wide = align.monthly_wide(o, start="2020-01-01", as_of="2020-12-31")
    gdp = by_month(wide, "gdp")
    assert gdp[D(2019, 12, 1)] is None      # outside the spine
    assert gdp[D(2020, 1, 1)] is None       # 2019 GDP never seeds the fill
    assert gdp[D(2020, 4, 1)] == 110.0
    assert gdp[D(2020, 5, 1)] == 110.0      # carried forward
    assert gdp[D(2021, 1, 1)] is None       # after as_of: outside the spine


def test_forward_filled_spine_rows(spark):
    o = obs(spark, [("GDP", D(2020, 1, 1), 1.0), ("GDP", D(2020, 4, 1), 2.0)])
    out = by_month(align.forward_filled(o, "GDP", "gdp", "2020-01-01", "2020-06-30"), "gdp")
    assert out == {D(2020, m, 1): (1.0 if m < 4 else 2.0) for m in range(1, 7)}


def test_positional_lag_over_a_gap(spark):
    o = obs(spark, [("UNRATE", D(2020, 1, 1), 1.0), ("UNRATE", D(2020, 3, 1), 4.0)])  # February missing
    m = metrics.derived_metrics(align.monthly_wide(o, start="2020-01-01", as_of="2020-12-31"))
    assert by_month(m, "unemployment_rate_mom_change")[D(2020, 3, 1)] == 3.0  # March - January


def test_partial_windows_and_rolling_low(spark):
    o = obs(spark, [("UNRATE", D(2020, m, 1), float(v)) for m, v in [(1, 6), (2, 3), (3, 9), (4, 3)]])
    m = metrics.derived_metrics(align.monthly_wide(o, start="2020-01-01", as_of="2020-12-31"))
    avg3 = by_month(m, "unemployment_rate_3m_avg")
    assert avg3[D(2020, 1, 1)] == 6.0 and avg3[D(2020, 2, 1)] == 4.5 and avg3[D(2020, 4, 1)] == 5.0
    assert by_month(m, "unemployment_rate_12m_low")[D(2020, 3, 1)] == 3.0


def test_zero_base_and_stale_fill_growth(spark):
    rows = [("UNRATE", D(2020, m, 1), 1.0) for m in range(1, 9)]
    rows += [("CPIAUCSL", D(2020, 1, 1), 0.0), ("CPIAUCSL", D(2020, 2, 1), 5.0)]
    rows += [("GDP", D(2020, 1, 1), 100.0), ("GDP", D(2020, 4, 1), 110.0)]
    m = metrics.derived_metrics(align.monthly_wide(obs(spark, rows), start="2020-01-01", as_of="2020-12-31"))
    assert by_month(m, "inflation_rate_mom_annualized")[D(2020, 2, 1)] is None   # zero base
    g = by_month(m, "gdp_qoq_growth_rate")
    assert g[D(2020, 4, 1)] == 10.0
    assert g[D(2020, 8, 1)] == 0.0          # fill is stale: same value three rows back


# ---------------------------------------------------------------- signals

def metric_row(spark, **kw):
    cols = ["unemployment_rate_3m_avg", "unemployment_rate_12m_low", "treasury_spread_10y2y",
            "inflation_rate_yoy", "consumer_sentiment", "fed_funds_rate_yoy_change"]
    vals = tuple(kw.get(c) for c in cols)
    return spark.createDataFrame([(D(2020, 1, 1), *vals)],
                                 "observation_month date, " + ", ".join(f"{c} double" for c in cols))


def test_null_inputs_give_zero_flags_and_low(spark):
    out = signals.with_signals(metric_row(spark)).first()
    assert out.recession_signal_count == 0 and out.recession_risk_level == "LOW"
    assert out.signal_sahm_rule == 0 and out.sahm_rule_value is None


def test_unrounded_sahm_rule(spark):
    # gap 0.4999 is shown as 0.50 but does not fire (the flag uses the unrounded gap)
    out = signals.with_signals(metric_row(spark, unemployment_rate_3m_avg=4.4999,
                                          unemployment_rate_12m_low=4.0)).first()
    assert out.sahm_rule_value == 0.5 and out.signal_sahm_rule == 0


@pytest.mark.parametrize("kw,count,level", [
    (dict(treasury_spread_10y2y=-0.1), 1, "MODERATE"),
    (dict(treasury_spread_10y2y=-0.1, consumer_sentiment=50.0), 2, "ELEVATED"),
    (dict(treasury_spread_10y2y=-0.1, consumer_sentiment=50.0, inflation_rate_yoy=5.01), 3, "HIGH"),
    (dict(treasury_spread_10y2y=0.0, consumer_sentiment=60.0, inflation_rate_yoy=5.0,
          fed_funds_rate_yoy_change=1.0), 1, "MODERATE"),   # strict <, strict >, >= 1.0
])
def test_levels_and_strictness(spark, kw, count, level):
    out = signals.with_signals(metric_row(spark, **kw), Thresholds()).first()
    assert (out.recession_signal_count, out.recession_risk_level) == (count, level)


# ---------------------------------------------------------------- marts and serving

def dashboard_rows(spark, rows):
    cols = ["unemployment_rate", "inflation_rate_yoy", "fed_funds_rate", "consumer_sentiment"]
    return spark.createDataFrame(
        [(m, *v, 1, "MODERATE") for m, v in rows],
        "observation_month date, " + ", ".join(f"{c} double" for c in cols)
        + ", recession_signal_count int, recession_risk_level string")


def test_summary_empty_when_calendar_previous_missing(spark):
    d = dashboard_rows(spark, [(D(2020, 1, 1), (4.0, 2.0, 1.0, 80.0)),
                               (D(2020, 3, 1), (5.0, 2.0, 1.0, 80.0))])  # February absent
    assert marts.indicator_summary(d).count() == 0


def test_summary_latest_is_last_unemployment_month(spark):
    d = dashboard_rows(spark, [(D(2020, 1, 1), (4.0, 2.0, 1.0, 80.0)),
                               (D(2020, 2, 1), (5.0, 3.0, 1.5, 70.0)),
                               (D(2020, 3, 1), (None, 9.0, 9.0, 9.0))])
    s = marts.indicator_summary(d).first()
    assert s.latest_month == D(2020, 2, 1)
    assert s.unemployment_mom_change == 1.0 and s.inflation_previous == 2.0
    assert s.sentiment_avg == 75.0 and s.fed_funds_max == 1.5   # history: months with unemployment


def test_all_null_indicator_absent_from_counts(spark):
    d = spark.createDataFrame([(D(2020, 1, 1), 1.0, None), (D(2020, 2, 1), None, None)],
                              "observation_month date, a double, b double")
    out = {r.indicator: r.observation_count for r in serving.observation_counts(d, ["a", "b"]).collect()}
    assert out == {"a": 1}


def test_trailing_24_months_is_25_rows(spark):
    months = [D(2018 + (m - 1) // 12, (m - 1) % 12 + 1, 1) for m in range(1, 37)]
    d = spark.createDataFrame([(m, None) for m in months], "observation_month date, x double")
    out = {r.column_name: r.missing_values for r in serving.completeness(d, ["observation_month", "x"]).collect()}
    assert out == {"observation_month": 0, "x": 25}


# ---------------------------------------------------------------- load

def test_upsert_null_overwrites_and_is_idempotent(spark):
    schema = "series_id string, observation_date date, value double, ingested_at timestamp_ntz, source_url string"
    t0 = dt.datetime(2024, 1, 1)
    target = spark.createDataFrame([("A", D(2024, 1, 1), 1.0, t0, "u"), ("A", D(2024, 1, 2), 2.0, t0, "u")], schema)
    batch = spark.createDataFrame([("A", D(2024, 1, 2), None, None, "v"), ("A", D(2024, 1, 3), 3.0, None, "v")], schema)
    now = "2024-02-01 00:00:00"
    once = load.upsert(target, batch, now=now)
    twice = load.upsert(once, batch, now=now)
    got = sorted((r.observation_date, r.value, r.source_url) for r in once.collect())
    assert got == [(D(2024, 1, 1), 1.0, "u"), (D(2024, 1, 2), None, "v"), (D(2024, 1, 3), 3.0, "v")]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert load.merged_count(batch).first().rows_merged == 2
    assert load.merged_count(batch.limit(0)).first().rows_merged == 0


def test_inclusive_watermark_and_default(spark):
    o = obs(spark, [("A", D(2024, 1, 1), 1.0), ("A", D(2024, 1, 5), None)])   # NULL value rows count
    dim = spark.createDataFrame([("A",), ("B",)], "series_id string")
    out = {r.series_id: r.start_date for r in load.watermarks(o, dim).collect()}
    assert out == {"A": D(2024, 1, 5), "B": D(2000, 1, 1)}
    land = spark.createDataFrame([("A", D(2024, 1, 4), "1"), ("A", D(2024, 1, 5), "2"), ("A", D(2024, 1, 6), ".")],
                                 "series_id string, observation_date date, raw_value string")
    batch, log = load.run_load(land, dim, o, incremental=True, now="2024-02-01 00:00:00", run_id="r")
    assert sorted(r.observation_date for r in batch.collect()) == [D(2024, 1, 5), D(2024, 1, 6)]


def test_bad_series_isolated(spark):
    land = spark.createDataFrame([("A", D(2024, 1, 1), "1.5"), ("B", D(2024, 1, 1), "oops"),
                                  ("B", D(2024, 1, 2), "2")],
                                 "series_id string, observation_date date, raw_value string")
    dim = spark.createDataFrame([("A",), ("B",), ("C",)], "series_id string")
    batch, log = load.run_load(land, dim, now="2024-02-01 00:00:00", run_id="r")
    assert [r.series_id for r in batch.collect()] == ["A"]
    st = {r.series_id: (r.status, r.records_fetched) for r in log.collect()}
    assert st == {"A": ("SUCCESS", 1), "B": ("FAILED", 0), "C": ("SUCCESS", 0)}   # empty payload succeeds
    msg = log.filter("series_id = 'B'").first().error_message
    assert "oops" in msg and len(msg) <= 2000
    s = load.run_summary(log).first()
    assert (s.succeeded, s.failed, s.total) == (2, 1, 3)
    with pytest.raises(load.LoadFailed):
        load.raise_if_failed(log)


def test_replace_by_key(spark):
    t = spark.createDataFrame([("A", "a1"), ("A", "a2"), ("B", "b1")], "series_id string, title string")
    b = spark.createDataFrame([("A", "a3")], "series_id string, title string")
    assert sorted(map(tuple, load.replace_by_key(t, b).collect())) == [("A", "a3"), ("B", "b1")]


# ---------------------------------------------------------------- quality

@pytest.mark.parametrize("hours,status", [(47, "PASS"), (49, "WARN"), (97, "ERROR")])
def test_freshness(spark, hours, status):
    last = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(last,)], "ingested_at timestamp_ntz")
    now = last + dt.timedelta(hours=hours)
    assert quality.freshness(df, "ingested_at", now).first().status == status


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "LOW", 0.5), (1, "BAD", 11.0), (None, None, -1.0)],
                               "k int, level string, v double")
    assert quality.unique(df, "k").count() == 1
    assert quality.not_null(df, "k").count() == 1
    assert quality.accepted_values(df, "level", ["LOW"]).count() == 1   # NULL passes
    assert quality.in_range(df, "v", 0, 10).count() == 2
    rep = {r.check_name: r.n_failed for r in quality.check_report(df, [
        ("k_nn", "not_null", "k"), ("lvl", "accepted_values", "level", ["LOW"]), ("rng", "in_range", "v", 0, 10)]).collect()}
    assert rep == {"k_nn": 1, "lvl": 1, "rng": 2}
    a = spark.createDataFrame([(10,)], "staging_months long")
    b = spark.createDataFrame([(12,)], "pivoted_rows long")
    assert quality.row_ratio(a, b).first().failed is True


def test_conform_casts_fills_and_splits_violations(spark):
    from tidemark.schemas import INGESTION_LOG, MAX_LENGTHS
    from tidemark.sources.tables import conform

    df = spark.createDataFrame([
        ("r1", "UNRATE", None, "SUCCESS", "2024-01-01 00:00:00", None),
        ("r1", None, "3", "SUCCESS", "2024-01-01 00:00:00", None),          # NOT NULL series_id
        ("r1", "X" * 21, "3", "SUCCESS", "2024-01-01 00:00:00", None),      # longer than 20
        ("r1", "GDP", "three", "SUCCESS", "2024-01-01 00:00:00", None),     # does not cast
    ], "run_id string, series_id string, records_fetched string, status string, started_at string, "
       "error_message string")
    ok, bad = conform(df, INGESTION_LOG, defaults={"records_fetched": F.lit(0)},
                      max_lengths=MAX_LENGTHS["ingestion_log"])
    rows = ok.collect()
    assert len(rows) == 1 and rows[0].records_fetched == 0 and rows[0].series_id == "UNRATE"
    assert dict(ok.dtypes)["started_at"] == "timestamp_ntz"
    assert bad.count() == 3


def test_panel_dedup_keeps_entities_apart(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    raw = spark.createDataFrame([
        ("east", "A", D(2024, 1, 1), 1.0, t1, "u"),
        ("west", "A", D(2024, 1, 1), 2.0, t2, "u"),   # same series and date, other entity
        ("east", "A", D(2024, 1, 1), 3.0, t2, "u"),
    ], "entity string, series_id string, observation_date date, value double, ingested_at timestamp_ntz, "
       "source_url string")
    out = dedup.stage_observations(raw, keys=["entity"]).collect()
    assert sorted((r.entity, r.value) for r in out) == [("east", 3.0), ("west", 2.0)]
    assert len({r.observation_id for r in out}) == 2


def test_bad_date_fails_only_its_series(spark, workdir):
    import json
    import os

    from tidemark.sources import landing

    d = os.path.join(workdir, "dates")
    os.makedirs(d)
    with open(os.path.join(d, "A.json"), "w") as f:
        json.dump({"observations": [{"date": "2024-01-01", "value": "1"}]}, f)
    with open(os.path.join(d, "B.json"), "w") as f:
        json.dump({"observations": [{"date": "2024-13-45", "value": "1"}, {"date": "2024-01-01", "value": "2"}]}, f)
    rows, bad = landing.read_observation_landing(spark, d)
    dim = spark.createDataFrame([("A",), ("B",)], "series_id string")
    batch, log = load.run_load(rows, dim, malformed=bad, now="2024-02-01 00:00:00", run_id="r")
    assert {r.series_id: r.status for r in log.collect()} == {"A": "SUCCESS", "B": "FAILED"}
    assert [r.series_id for r in batch.collect()] == ["A"]


def test_suite_one_row_per_test(spark):
    df = spark.createDataFrame([(1, "LOW"), (1, "BAD"), (2, None)], "k int, level string")
    rep = quality.suite([("k_unique", "staging", "error", quality.unique(df, "k")),
                         ("level_ok", "marts", "warn", quality.accepted_values(df, "level", ["LOW"])),
                         ("k_nn", "staging", "error", quality.not_null(df, "k"))])
    got = {r.test_name: (r.layer, r.severity, r.n_failed) for r in rep.collect()}
    assert got == {"k_unique": ("staging", "error", 1), "level_ok": ("marts", "warn", 1),
                   "k_nn": ("staging", "error", 0)}


def test_suite_folds_row_checks_of_one_table(spark):
    df = spark.createDataFrame([(1, "LOW"), (None, "BAD")], "k int, level string")
    rep = quality.suite([("k_nn", "staging", "error", df, quality.null_rows("k")),
                         ("lvl", "staging", "error", df, quality.outside("level", ["LOW"]))])
    assert {r.test_name: r.n_failed for r in rep.collect()} == {"k_nn": 1, "lvl": 1}
    p = rep._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert p.count("Scan ExistingRDD") == 1       # one pass over the table for both tests
    assert quality.violations_of(("lvl", "staging", "error", df, quality.outside("level", ["LOW"]))).count() == 1


def test_over_long_series_id_fails_only_its_series(spark):
    long_id = "X" * 21
    land = spark.createDataFrame([("A", D(2024, 1, 1), "1"), (long_id, D(2024, 1, 1), "2")],
                                 "series_id string, observation_date date, raw_value string")
    dim = spark.createDataFrame([("A",), (long_id,)], "series_id string")
    batch, log = load.run_load(land, dim, now="2024-02-01 00:00:00", run_id="r")
    assert {r.series_id: r.status for r in log.collect()} == {"A": "SUCCESS", long_id: "FAILED"}
    assert [r.series_id for r in batch.collect()] == ["A"]
