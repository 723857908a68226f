"""Landing payloads -> load -> staging -> intermediate -> marts -> tests, end to end."""

import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import load
from tidemark.plans import catalog
from tidemark.plans.layers import RunConfig, run_layers
from tidemark.sources import fixtures as fx
from tidemark.sources import landing, tables

from .conftest import SF_SMOKE

NOW1 = "2024-03-01 00:00:00"
NOW2 = "2024-03-02 00:00:00"


def write_payloads(folder, obs_rows, malformed=()):
    os.makedirs(folder, exist_ok=True)
    by_series = {}
    for r in obs_rows:
        by_series.setdefault(r.series_id, []).append(
            {"date": r.observation_date.isoformat(), "value": "." if r.value is None else repr(r.value)})
    for sid, items in by_series.items():
        with open(os.path.join(folder, f"{sid}.json"), "w") as f:
            json.dump({"observations": items}, f)
    for sid in malformed:
        with open(os.path.join(folder, f"{sid}.json"), "w") as f:
            json.dump({"error_code": 400, "error_message": "no such series"}, f)


def write_metadata(folder):
    os.makedirs(folder, exist_ok=True)
    docs = {
        "UNRATE": {"seriess": [{"id": "UNRATE", "title": "Unemployment Rate", "frequency": "Monthly",
                                "units": "Percent", "seasonal_adjustment": "Seasonally Adjusted",
                                "last_updated": "2024-02-02 07:44:02-06"}]},
        "GDP": {"seriess": []},   # empty list: no write
        "T10Y2Y": {},             # missing key: no write
    }
    for sid, doc in docs.items():
        with open(os.path.join(folder, f"{sid}.json"), "w") as f:
            json.dump(doc, f)


def test_landing_readers(spark, workdir):
    obs_dir = os.path.join(workdir, "obs")
    os.makedirs(obs_dir)
    with open(os.path.join(obs_dir, "A.json"), "w") as f:
        json.dump({"observations": [{"date": "2024-01-01", "value": "3.7"},
                                    {"date": "2024-02-01", "value": "."}]}, f)
    with open(os.path.join(obs_dir, "B.json"), "w") as f:
        json.dump({"observations": []}, f)
    with open(os.path.join(obs_dir, "C.json"), "w") as f:
        json.dump({"error_code": 400, "error_message": "no such series"}, f)
    rows, bad = landing.read_observation_landing(spark, obs_dir)
    assert sorted((r.series_id, str(r.observation_date), r.raw_value) for r in rows.collect()) == [
        ("A", "2024-01-01", "3.7"), ("A", "2024-02-01", ".")]
    assert [r.series_id for r in bad.collect()] == ["C"]
    good, malformed = landing.split_malformed(landing.read_observation_payloads(spark, obs_dir))
    assert sorted(r.series_id for r in good.collect()) == ["A", "B"]   # [] is not malformed
    meta_dir = os.path.join(workdir, "meta")
    write_metadata(meta_dir)
    meta = landing.read_metadata_landing(spark, meta_dir, NOW1).collect()
    assert [(m.series_id, m.title, m.seasonal_adj) for m in meta] == [
        ("UNRATE", "Unemployment Rate", "Seasonally Adjusted")]


@pytest.fixture(scope="module")
def econ_rows(spark):
    return fx.econ_observations(spark, SF_SMOKE).collect()


def test_run_layers_matches_registered_dashboard(spark, workdir, econ_rows):
    obs_dir, meta_dir = os.path.join(workdir, "landing1"), os.path.join(workdir, "meta")
    write_payloads(obs_dir, econ_rows)
    write_metadata(meta_dir)
    root = os.path.join(workdir, "warehouse")
    cfg = RunConfig(root=root, landing_obs=obs_dir, landing_meta=meta_dir, start=fx.SPINE_START,
                    load_start="1990-01-01", as_of=fx.AS_OF, thresholds=catalog.FIX_T, now=NOW1, run_id="run-1")
    run_layers(spark, cfg, ["load", "staging", "intermediate", "marts"])
    # the synthetic unemployment series swings widely: the Sahm range test must catch it
    from tidemark.plans.layers import LayerFailed, tests_layer
    with pytest.raises(LayerFailed, match="sahm_rule_value_in_range"):
        tests_layer(spark, cfg)
    stored = spark.read.parquet(os.path.join(root, "dq_failures", "sahm_rule_value_in_range"))
    assert stored.count() > 0 and stored.filter("sahm_rule_value <= 10").count() == 0
    written = tables.read_current(spark, root, "marts", "economic_dashboard")
    expected = catalog.economic_dashboard(spark, SF_SMOKE)
    cols = expected.columns
    assert sorted(map(tuple, written.select(*cols).collect())) == sorted(map(tuple, expected.collect()))
    summary = tables.read_current(spark, root, "marts", "indicator_summary")
    assert summary.count() == catalog.indicator_summary(spark, SF_SMOKE).count()
    served = tables.read_mart(spark, root, "economic_dashboard", sort=True)
    assert dict(served.dtypes)["observation_month"] == "timestamp_ntz"
    months = [r.observation_month for r in served.select("observation_month").collect()]
    assert months == sorted(months)
    meta = tables.read_current(spark, root, "raw", "series_metadata").collect()
    assert [m.series_id for m in meta] == ["UNRATE"]

    # incremental run: one revised UNRATE value on the watermark date, CPI payload malformed
    raw = tables.read_observations(spark, os.path.join(root, "raw", "observations"))
    last = raw.filter("series_id = 'UNRATE'").agg(F.max("observation_date")).first()[0]
    obs2 = os.path.join(workdir, "landing2")
    revised = [r for r in econ_rows if r.series_id == "UNRATE" and r.observation_date >= last]
    revised = [SimpleNamespace(series_id=r.series_id, observation_date=r.observation_date, value=99.0)
               for r in revised]
    write_payloads(obs2, revised, malformed=["CPIAUCSL"])
    cfg2 = RunConfig(root=root, landing_obs=obs2, start=fx.SPINE_START, load_start="1990-01-01", as_of=fx.AS_OF,
                     thresholds=catalog.FIX_T, now=NOW2, run_id="run-2", incremental=True)
    with pytest.raises(load.LoadFailed):
        run_layers(spark, cfg2, ["load"])
    raw = tables.read_observations(spark, os.path.join(root, "raw", "observations"))
    row = raw.filter((F.col("series_id") == "UNRATE") & (F.col("observation_date") == last)).collect()
    assert len(row) == 1 and row[0].value == 99.0
    assert raw.count() == len(econ_rows)           # revision updated in place, nothing duplicated
    log = spark.read.parquet(os.path.join(root, "raw", "ingestion_log")).filter("run_id = 'run-2'")
    st = {r.series_id: r.status for r in log.collect()}
    assert st["CPIAUCSL"] == "FAILED" and st["UNRATE"] == "SUCCESS"


def test_streaming_incremental_load(spark, workdir, econ_rows):
    from tidemark.streaming.landing_stream import start_incremental_load

    land = os.path.join(workdir, "stream-landing")
    monthly = [r for r in econ_rows if r.series_id in ("UNRATE", "GDP")]
    write_payloads(land, monthly)
    root = os.path.join(workdir, "stream-wh")
    ckpt = os.path.join(workdir, "stream-ckpt")
    q = start_incremental_load(spark, land, root, ckpt, now=NOW1, load_start="1990-01-01")
    q.awaitTermination(300)
    raw = tables.read_observations(spark, os.path.join(root, "raw", "observations"))
    assert raw.count() == len(monthly)
    # a second file for UNRATE with a revision arrives; replay only picks the new file
    with open(os.path.join(land, "UNRATE__rev1.json"), "w") as f:
        first = min(r.observation_date for r in monthly if r.series_id == "UNRATE")
        json.dump({"observations": [{"date": first.isoformat(), "value": "1.25"}]}, f)
    q = start_incremental_load(spark, land, root, ckpt, now=NOW2, load_start="1990-01-01")
    q.awaitTermination(300)
    raw = tables.read_observations(spark, os.path.join(root, "raw", "observations"))
    assert raw.count() == len(monthly)
    assert raw.filter((F.col("series_id") == "UNRATE") & (F.col("observation_date") == first)).first().value == 1.25


def test_replayed_micro_batch_changes_nothing(spark, workdir, econ_rows):
    """A micro-batch re-run after a failure (same epoch, same files) leaves the table unchanged."""
    from tidemark.streaming.landing_stream import _micro_batch

    land = os.path.join(workdir, "replay-landing")
    write_payloads(land, [r for r in econ_rows if r.series_id in ("UNRATE", "FEDFUNDS")])
    payloads = landing.read_observation_payloads(spark, land)
    root = os.path.join(workdir, "replay-wh")
    handle = _micro_batch(root, fx_specs(), NOW1, "1990-01-01")
    handle(payloads, 7)
    first = sorted(map(tuple, tables.read_observations(spark, os.path.join(root, "raw", "observations")).collect()))
    handle(payloads, 7)
    again = sorted(map(tuple, tables.read_observations(spark, os.path.join(root, "raw", "observations")).collect()))
    assert first == again and len(first) > 0
    log = spark.read.parquet(os.path.join(root, "raw", "ingestion_log"))
    assert log.count() == log.select("series_id").distinct().count()   # replay wrote no duplicate log rows


def fx_specs():
    from tidemark.schemas import DEFAULT_SERIES
    return DEFAULT_SERIES


def test_run_layers_as_views_with_two_series(spark, workdir, econ_rows):
    from tidemark.schemas import DEFAULT_SERIES

    specs = [s for s in DEFAULT_SERIES if s.series_id in ("UNRATE", "CPIAUCSL")]
    land = os.path.join(workdir, "two-series")
    write_payloads(land, [r for r in econ_rows if r.series_id in ("UNRATE", "CPIAUCSL")])
    root = os.path.join(workdir, "views-wh")
    cfg = RunConfig(root=root, landing_obs=land, specs=specs, start=fx.SPINE_START, load_start="1990-01-01",
                    as_of=fx.AS_OF, thresholds=catalog.FIX_T, now=NOW1, run_id="v-1", views=True)
    out = run_layers(spark, cfg, ["load", "staging", "intermediate", "marts"])
    dash = out["marts"]
    assert dash.count() > 0 and len(dash.columns) == 27
    assert dash.filter("gdp IS NOT NULL OR treasury_spread_10y2y IS NOT NULL").count() == 0
    assert spark.catalog.tableExists("staging__observations")        # the view layout
    assert not os.path.exists(os.path.join(root, "staging"))          # nothing written for views
