"""The stored load: latest file wins, typed partitions, quarantine, isolation, entity keys, single parsing."""

import json
import os
import time

import pytest

from tidemark.operators import load
from tidemark.plans.layers import RunConfig, run_layers
from tidemark.schemas import SeriesSpec
from tidemark.sources import landing, tables
from tidemark.streaming import landing_stream as ls

NOW = "2024-03-01 00:00:00"


def land(folder, name, observations=None, age=0, **document):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        json.dump(document if observations is None else {"observations": [
            dict(zip(("date", "value", "region"), o)) for o in observations], **document}, f)
    os.utime(path, (time.time() - age,) * 2)


def specs(*ids):
    return [SeriesSpec(i, f"c_{k}") for k, i in enumerate(ids)]


def config(workdir, ids, **kw):
    return RunConfig(root=os.path.join(workdir, "wh"), landing_obs=os.path.join(workdir, "obs"), specs=specs(*ids),
                     now=NOW, run_id=kw.pop("run_id", "run-1"), **kw)


def stored(spark, cfg):
    rows = tables.read_observations(spark, os.path.join(cfg.root, "raw", "observations"), cfg.keys).collect()
    return sorted((*(r[k] for k in cfg.keys), r.series_id, str(r.observation_date), r.value) for r in rows)


def log(spark, cfg, run_id="run-1"):
    rows = tables.read_log(spark, os.path.join(cfg.root, "raw", "ingestion_log")).filter(f"run_id = '{run_id}'").collect()
    return {r.series_id: r for r in rows}


def test_latest_file_wins_also_downwards(spark, workdir):
    cfg = config(workdir, ["A"])
    land(cfg.landing_obs, "A.json", [("2024-01-01", "9.0"), ("2024-02-01", "bad")], age=100)
    land(cfg.landing_obs, "A__rev1.json", [("2024-01-01", "4.0"), ("2024-02-01", "5")], age=50)
    run_layers(spark, cfg, ["load"])
    assert stored(spark, cfg) == [("A", "2024-01-01", 4.0), ("A", "2024-02-01", 5.0)]
    assert log(spark, cfg)["A"].records_fetched == 4


def test_ids_that_look_like_numbers_and_dotted_ids(spark, workdir):
    cfg = config(workdir, ["001", "002", "SP.POP.TOTL", "SP.DYN", "x.own"])
    for i in ("001", "002", "SP.POP.TOTL", "SP.DYN"):
        land(cfg.landing_obs, f"{i}.json", [("2024-01-01", "1"), ("2023-12-01", "2")])
    land(cfg.landing_obs, "anything.json", [("2024-01-01", "7")], series_id="x.own")
    run_layers(spark, cfg, ["load"])
    first = stored(spark, cfg)
    assert {r[0] for r in first} == {"001", "002", "SP.POP.TOTL", "SP.DYN", "x.own"} and len(first) == 9
    cfg.run_id = "7"
    run_layers(spark, cfg, ["load"])
    assert stored(spark, cfg) == first and len(log(spark, cfg, "7")) == 5
    folders = [d for _, dirs, _ in os.walk(os.path.join(cfg.root, "raw", "observations")) for d in dirs if d.startswith("_p_series_id=")]
    assert len(set(folders)) == 5


def test_null_value_and_bad_metadata_fail_their_series_only(spark, workdir):
    cfg = config(workdir, ["A", "B", "C"], landing_meta=os.path.join(workdir, "meta"))
    for i, v in (("A", "1"), ("B", None), ("C", "3")):
        land(cfg.landing_obs, f"{i}.json", [("2024-01-01", v)])
        land(cfg.landing_meta, f"{i}.json", seriess=[{"id": i, "title": i, "last_updated": "soon" if i == "C" else "2024-02-02 07:44:02-06"}])
    with pytest.raises(load.LoadFailed, match="2 series failed: B, C"):
        run_layers(spark, cfg, ["load"])
    got = log(spark, cfg)
    assert {k: r.status for k, r in got.items()} == {"A": "SUCCESS", "B": "FAILED", "C": "FAILED"}
    assert [got[i].records_fetched for i in "ABC"] == [1, 0, 0]
    assert "no value" in got["B"].error_message and "last_updated" in got["C"].error_message
    assert stored(spark, cfg) == [("A", "2024-01-01", 1.0), ("C", "2024-01-01", 3.0)]
    meta = tables.read_current(spark, cfg.root, "raw", "series_metadata").collect()
    assert [(m.series_id, str(m.last_updated)) for m in meta] == [("A", "2024-02-02 07:44:02")]


def test_all_failed_series_are_counted(spark):
    rows = spark.createDataFrame([(f"S{i:03d}", "FAILED") for i in range(150)] + [("ok", "SUCCESS")], "series_id string, status string")
    with pytest.raises(load.LoadFailed, match="^150 series failed: S000, .* and 130 more"):
        load.raise_if_failed(rows)


def test_stream_keeps_failed_rows_and_loads_them_later(spark, workdir):
    folder, root, ckpt = (os.path.join(workdir, d) for d in ("obs", "wh", "ckpt"))
    options = dict(specs=specs("A", "B"), now=NOW)
    land(folder, "A.json", [("2024-01-01", "1"), ("2024-02-01", "bad")], age=100)
    land(folder, "B.json", [("2024-01-01", "2")], age=100)
    with pytest.raises(load.LoadFailed, match="1 series failed: A"):
        ls.run_incremental_load(spark, folder, root, ckpt, **options)
    cfg = RunConfig(root=root)
    assert stored(spark, cfg) == [("B", "2024-01-01", 2.0)] and ls.read_quarantine(spark, root).count() == 2
    with pytest.raises(load.LoadFailed):   # nothing new, still waiting
        ls.run_incremental_load(spark, folder, root, ckpt, **options)
    land(folder, "A__2.json", [("2024-02-01", "5"), ("2024-03-01", "6")], age=50)
    ls.run_incremental_load(spark, folder, root, ckpt, **options)
    assert stored(spark, cfg) == [("A", "2024-01-01", 1.0), ("A", "2024-02-01", 5.0), ("A", "2024-03-01", 6.0), ("B", "2024-01-01", 2.0)]
    assert ls.read_quarantine(spark, root).count() == 0
    # a new checkpoint starts its numbers at 0 again; the audit rows of the first runs stay
    before = tables.read_log(spark, os.path.join(root, "raw", "ingestion_log")).count()
    ls.run_incremental_load(spark, folder, root, os.path.join(workdir, "ckpt2"), **options)
    assert tables.read_log(spark, os.path.join(root, "raw", "ingestion_log")).count() == before + 2


def test_entity_keys_from_landing_to_tests(spark, workdir):
    ids = [("UNRATE", "unemployment_rate"), ("CPIAUCSL", "cpi_index")]
    months = [f"{y}-{m:02d}-01" for y in (2022, 2023) for m in range(1, 13)]
    cfg = RunConfig(root=os.path.join(workdir, "wh"), landing_obs=os.path.join(workdir, "obs"), now=NOW, run_id="r",
                    specs=[SeriesSpec(i, c) for i, c in ids], keys=["region"], start="2022-01-01", as_of="2023-12-31")
    for i, _ in ids:
        land(cfg.landing_obs, f"{i}.json", [(m, str(3 + k % 2), r) for r in ("east", "west") for k, m in enumerate(months)])
    # a large series may come line by line
    with open(os.path.join(cfg.landing_obs, "UNRATE__more.jsonl"), "w") as f:
        f.writelines(json.dumps({"date": m, "value": "4", "region": "north"}) + "\n" for m in months)
    out = run_layers(spark, cfg)
    assert out["marts"].groupBy("region").count().collect().__len__() == 3
    assert out["marts"].count() == 72 and out["tests"].filter("n_failed > 0 and severity = 'error'").count() == 0
    assert len(stored(spark, cfg)) == 24 * 5
    with pytest.raises(load.LoadFailed):
        land(cfg.landing_obs, "CPIAUCSL.json", [("2024-01-01", "1", None)])
        run_layers(spark, cfg, ["load"])


def test_row_reconciliation_per_entity(spark):
    from tidemark.operators import quality

    staged = spark.createDataFrame([("e", "UNRATE", m) for m in range(12)] + [("w", "UNRATE", m) for m in range(12)],
                                   "entity string, series_id string, observation_date int")
    wide = spark.createDataFrame([("e", m) for m in range(12)] + [("w", m) for m in range(5)] + [("x", 1)], "entity string, observation_month int")
    got = {r.entity: (r.staging_months, r.pivoted_rows, r.failed) for r in quality.staging_reconcile(staged, wide, keys=["entity"]).collect()}
    assert got == {"e": (12, 12, False), "w": (12, 5, True), "x": (0, 1, True)}


def test_old_versions_go(spark, workdir):
    cfg = config(workdir, ["A"])
    path = os.path.join(cfg.root, "raw", "observations")
    for v in ("1", "2", "3"):
        batch = spark.createDataFrame([("A", "2024-01-01", float(v), "u")], "series_id string, d string, value double, source_url string").selectExpr(
            "series_id", "date(d) as observation_date", "value", "source_url")
        assert tables.upsert_table(spark, path, batch, now=NOW) == 1
        tables.publish(batch, cfg.root, "marts", "t")
    assert stored(spark, cfg) == [("A", "2024-01-01", 3.0)]
    versions = [d for d in os.listdir(os.path.join(cfg.root, "marts", "t")) if d.startswith("v=")]
    assert len(versions) == 2 and tables.read_current(spark, cfg.root, "marts", "t").first().value == 3.0


def test_payloads_are_parsed_once(spark, workdir):
    land(workdir, "A.json", [("2024-01-01", "1")])
    rows, malformed = landing.read_observation_landing(spark, workdir)
    batch, entries = load.run_load(rows, load.series_dim(spark, specs("A")), malformed=malformed, now=NOW, materialise=True)
    for df in (batch, entries):
        p = df._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in p and "Generate" not in p, p


def test_log_reads_its_rows_once(spark):
    from tidemark.plans import catalog

    p = catalog.queries()["load_log"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert p.count("events.parquet") <= 2


def test_cluster_without_shared_folder_is_refused():
    from types import SimpleNamespace

    from tidemark.session import ensure_checkpoint_dir

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(cluster)


def test_recent_runs_break_ties_by_run_and_series(spark):
    from tidemark.operators import serving

    rows = [(f"r{i % 2}", f"s{i}", "2024-01-01") for i in range(30)]
    df = spark.createDataFrame(rows, "run_id string, series_id string, started_at string")
    want = [r[1] for r in sorted(rows, key=lambda r: (r[0], r[1]), reverse=True)][:5]
    assert [r.series_id for r in serving.recent_runs(df, 5).collect()] == want
