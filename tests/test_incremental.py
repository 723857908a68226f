"""The incremental panel: equal to a full recompute after any batch, reading only what the batch touches."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import align, load, marts, metrics
from tidemark.plans.incremental import Panel, run_incremental
from tidemark.plans.layers import RunConfig, run_layers
from tidemark.schemas import Thresholds, observations_contract
from tidemark.sources import tables
from tidemark.sources.snapshots import Conflict

START, AS_OF, T = "2000-01-01", "2004-12-31", Thresholds(sahm_rule=0.5, high_inflation=2.0, low_sentiment=60, fed_tightening=0.1)
MONTHLY = ("UNRATE", "CPIAUCSL", "FEDFUNDS", "UMCSENT")


def frame(spark, rows, keys=("entity",)):
    names = ", ".join(f"{k} string" for k in keys)
    return spark.createDataFrame(rows, f"{names + ', ' if names else ''}series_id string, d string, value double").withColumn(
        "observation_date", F.to_date("d")).drop("d")


def some_rows(rng, entities, months, share, retract=0.0):
    out = []
    for e in entities:
        for y, m in months:
            for s in MONTHLY:
                if rng.random() < share:
                    out.append((e, s, f"{y}-{m:02d}-01", None if rng.random() < retract else round(rng.uniform(1, 100), 1)))
            if rng.random() < share:
                out.append((e, "T10Y2Y", f"{y}-{m:02d}-{rng.choice([3, 17, 28])}", round(rng.uniform(-2, 2), 2)))
            if m % 3 == 1 and rng.random() < share:
                out.append((e, "GDP", f"{y}-{m:02d}-01", None if rng.random() < retract else round(rng.uniform(50, 90), 1)))
    return out


def full(spark, state, keys=("entity",), as_of=AS_OF):
    rows = [(*k, v) for k, v in state.items() if v is not None]
    wide = align.monthly_wide(frame(spark, rows, keys), start=START, as_of=as_of, keys=list(keys))
    return marts.economic_dashboard(metrics.derived_metrics(wide, list(keys)), T, list(keys))


def content(df, columns=None):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=repr)


def same_summary(got, want):
    """Equal rows; means may differ by one in the last digit (a sum of sums rounds a tie another way)."""
    a, b = content(got, want.columns), content(want)
    mean = [c.endswith("_avg") for c in want.columns]
    return len(a) == len(b) and all(x == y or m and None not in (x, y) and abs(x - y) < 0.0101
                                    for p, q in zip(a, b) for x, y, m in zip(p, q, mean))


MONTHS = [(y, m) for y in range(1999, 2006) for m in range(1, 13)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_equal_a_full_recompute(spark, workdir, seed):
    rng = random.Random(seed)
    panel = Panel(spark, os.path.join(workdir, "p"), ["entity"], thresholds=T, start=START, buckets=3)
    state = {}
    first = some_rows(rng, "abcde", MONTHS, 0.6)
    batches = [first, some_rows(rng, "bq", MONTHS[40:44], 0.9, 0.3), some_rows(rng, "ad", MONTHS[:3] + MONTHS[-2:], 0.7, 0.5),
               [("c", "GDP", "2001-04-01", None), ("c", "GDP", "2001-07-01", None)], [(*r[:3], None) for r in first if r[0] == "e"]]
    for b in batches:
        state |= {r[:3]: r[3] for r in b}
        assert panel.load(frame(spark, b), AS_OF, "2024-01-01") == len({r[:3] for r in b})
        want = full(spark, state)
        assert content(panel.dashboard(), want.columns) == content(want)
    version = panel.months.version()
    assert panel.load(frame(spark, batches[1]), AS_OF, "2024-01-01") > 0     # a replay of an old batch is a new load
    state |= {r[:3]: r[3] for r in batches[1]}
    want = full(spark, state)
    assert content(panel.dashboard(), want.columns) == content(want) and panel.months.version() == version + 1
    assert same_summary(panel.summary(), marts.indicator_summary(want, ["entity"]))


def test_only_touched_partitions_are_read_and_written(spark, workdir):
    rng = random.Random(5)
    panel = Panel(spark, os.path.join(workdir, "p"), ["entity"], thresholds=T, start=START, buckets=16)
    entities = [f"e{i}" for i in range(40)]
    panel.load(frame(spark, some_rows(rng, entities, MONTHS[12:30], 0.8)), AS_OF, "2024-01-01")
    before = {r.bucket: r._folder for r in panel.months.manifest().collect()}
    batch = frame(spark, [("e7", "UNRATE", "2001-03-01", 5.0)])
    from tidemark.operators import incremental as inc

    touched = panel.months.values(batch)
    rows = inc.updated(panel.months.read(touched), panel.observations.read(touched), batch, start=START, as_of=AS_OF, t=T, keys=["entity"])
    bucket = touched.first().bucket
    opened = {f.split("/data/")[1].split("/")[1] for f in rows.inputFiles()}
    assert opened == {f"_p_bucket={bucket}"} and len(before) > 8
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "Python" not in plan
    panel.load(batch, AS_OF, "2024-01-01")
    after = {r.bucket: r._folder for r in panel.months.manifest().collect()}
    assert {b for b in after if after[b] != before[b]} == {bucket}


def test_load_stopped_between_its_commits_is_made_good(spark, workdir, monkeypatch):
    rng = random.Random(6)
    rows = some_rows(rng, "abcdef", MONTHS[12:40], 0.8)
    state = {r[:3]: r[3] for r in rows}
    panel = Panel(spark, os.path.join(workdir, "p"), ["entity"], thresholds=T, start=START, buckets=4)
    panel.load(frame(spark, rows), AS_OF, "2024-01-01")
    lost, later = [("a", "UNRATE", "2001-02-01", 77.0)], [("d", "UNRATE", "2001-05-01", 66.0)]
    with monkeypatch.context() as m:
        m.setattr(Panel, "refresh", lambda *a: (_ for _ in ()).throw(RuntimeError("executor of the driver lost")))
        with pytest.raises(RuntimeError, match="lost"):
            panel.load(frame(spark, lost), AS_OF, "2024-01-01")
    assert content(panel.dashboard()) == content(full(spark, state), panel.dashboard().columns)  # readers: the version before
    panel.load(frame(spark, later), AS_OF, "2024-01-01")
    state |= {r[:3]: r[3] for r in lost + later}
    assert content(panel.dashboard()) == content(full(spark, state), panel.dashboard().columns)


def test_later_as_of_unmasks_months_and_other_writers_are_refused(spark, workdir):
    rng = random.Random(7)
    rows = some_rows(rng, "abc", MONTHS[24:], 0.9)
    state = {r[:3]: r[3] for r in rows}
    panel = Panel(spark, os.path.join(workdir, "p"), ["entity"], thresholds=T, start=START, buckets=4)
    panel.load(frame(spark, rows), "2003-06-15", "2024-01-01")
    assert content(panel.dashboard()) == content(full(spark, state, as_of="2003-06-15"), panel.dashboard().columns)
    panel.load(frame(spark, [("a", "UNRATE", "2001-02-01", 7.0)]), "2004-02-01", "2024-01-01")
    state["a", "UNRATE", "2001-02-01"] = 7.0
    assert content(panel.dashboard()) == content(full(spark, state, as_of="2004-02-01"), panel.dashboard().columns)
    with pytest.raises(Conflict):
        panel.months.replace(panel.months.read(), None, panel.months.version() - 1)


def test_no_keys_and_empty_batches(spark, workdir):
    rng = random.Random(8)
    rows = [r[1:] for r in some_rows(rng, "a", MONTHS[12:60], 0.8)]
    state = {r[:2]: r[2] for r in rows}
    panel = Panel(spark, os.path.join(workdir, "p"), thresholds=T, start=START)
    assert panel.load(frame(spark, [], ()), AS_OF) == 0 and panel.months.version() is None
    panel.load(frame(spark, rows, ()), AS_OF, "2024-01-01")
    more = [("GDP", "2002-01-01", 1.5), ("UNRATE", "2001-09-01", None)]
    state |= {r[:2]: r[2] for r in more}
    panel.load(frame(spark, more, ()), AS_OF, "2024-01-01")
    assert content(panel.dashboard()) == content(full(spark, state, ()), panel.dashboard().columns)
    version = panel.months.version()
    assert panel.load(frame(spark, [], ()), AS_OF) == 0
    assert content(panel.dashboard()) == content(full(spark, state, ()), panel.dashboard().columns) and panel.months.version() == version + 1


def test_states_merge_to_the_summary_and_counts(spark):
    """Whatever is missing: latest months in January, gaps, NULL unemployment, entities without a predecessor."""
    from tidemark.operators import quality, serving, states

    rng = random.Random(11)
    rows = some_rows(rng, "abcdefgh", MONTHS, 0.5)
    rows += [("j", s, f"{y}-01-01", 3.0) for s in MONTHLY for y in (2001, 2002)] + [("k", s, d, 4.0) for s in MONTHLY for d in ("2001-12-01", "2002-01-01")]
    rows += [("l", "UMCSENT", "2001-05-01", 1.0), ("m", "UNRATE", "2001-05-03", 1.0), ("m", "UNRATE", "2001-05-07", 2.0), ("n", "T10Y2Y", "2001-05-07", 2.0)]
    obs = frame(spark, rows)
    state = {r[:3]: r[3] for r in rows}
    dash = full(spark, state)
    per = states.summary_states(dash, ["entity"])
    want = marts.indicator_summary(dash, ["entity"])
    assert same_summary(states.summary_of(per, ["entity"]), want) and any(r.entity == "k" for r in want.collect())
    want = serving.observation_counts(dash, keys=["entity"])
    assert content(states.counts_of(per, ["entity"]), want.columns) == content(want)
    values = align.monthly_values(obs, keys=["entity"], dates_of="UNRATE")
    wide = align.monthly_wide(obs, start=START, as_of=AS_OF, keys=["entity"])
    want = quality.staging_reconcile(obs, wide, keys=["entity"])
    assert content(states.reconcile(values, align.DATES, "_n_monthly", keys=["entity"]), want.columns) == content(want)
    one = obs.where("entity = 'a'").drop("entity")
    values, wide = align.monthly_values(one, dates_of="UNRATE"), align.monthly_wide(one, start=START, as_of=AS_OF)
    assert content(states.reconcile(values, align.DATES, "_n_monthly")) == content(quality.staging_reconcile(one, wide))


def test_states_of_a_load_that_stopped_are_made_good(spark, workdir, monkeypatch):
    rng = random.Random(12)
    rows = some_rows(rng, "abc", MONTHS[12:40], 0.9)
    state = {r[:3]: r[3] for r in rows}
    panel = Panel(spark, os.path.join(workdir, "p"), ["entity"], thresholds=T, start=START, buckets=4)
    panel.load(frame(spark, rows), AS_OF, "2024-01-01")
    version = panel.states.version()
    for r, fails in ((("a", "UNRATE", "2001-02-01", 77.0), True), (("b", "UNRATE", "2002-02-01", 66.0), False)):
        state[r[:3]] = r[3]
        with monkeypatch.context() as m:
            if fails:
                m.setattr(Panel, "_refresh_states", lambda *a: None)
            panel.load(frame(spark, [r]), AS_OF, "2024-01-01")
        want = marts.indicator_summary(full(spark, state), ["entity"])
        assert same_summary(panel.summary(), want)
    assert panel.states.version() == version + 1 and panel.states.note(version + 1) == str(panel.months.version())


def payloads(folder, rows):
    os.makedirs(folder, exist_ok=True)
    by = {}
    for e, s, d, v in rows:
        by.setdefault(s, []).append({"date": d, "value": "." if v is None else str(v), "entity": e})
    for s, obs in by.items():
        with open(os.path.join(folder, f"{s}.json"), "w") as f:
            json.dump({"observations": obs}, f)


def test_incremental_run_equals_the_layered_run(spark, workdir):
    rng = random.Random(9)
    first = some_rows(rng, "ab", MONTHS[12:40], 0.9)
    second = some_rows(rng, "a", MONTHS[36:42], 0.9, 0.2)
    cfg = {}
    for root in ("inc", "full"):
        cfg[root] = RunConfig(root=os.path.join(workdir, root), keys=["entity"], start=START, as_of=AS_OF, thresholds=T,
                              now="2024-01-01 00:00:00", run_id="run-1")
    for n, rows in enumerate((first, second)):
        payloads(os.path.join(workdir, f"land{n}"), rows)
        for c in cfg.values():
            c.landing_obs, c.run_id = os.path.join(workdir, f"land{n}"), f"run-{n}"
        panel = run_incremental(spark, cfg["inc"])
        run_layers(spark, cfg["full"], ["load", "staging", "intermediate", "marts"])
        want = tables.read_current(spark, cfg["full"].root, "marts", "economic_dashboard")
        assert content(panel.dashboard(), want.columns) == content(want) and want.count() > 0
        summary = [tables.read_current(spark, c.root, "marts", "indicator_summary") for c in cfg.values()]
        assert same_summary(*summary)
    raw = tables.read_observations(spark, os.path.join(cfg["inc"].root, "raw", "observations"), ["entity"])
    assert raw.columns == [f.name for f in observations_contract(["entity"]).fields]
    payloads(os.path.join(workdir, "land2"), [("a", "UNRATE", "2001-01-01", "bad")])
    cfg["inc"].landing_obs, cfg["inc"].run_id = os.path.join(workdir, "land2"), "run-2"
    with pytest.raises(load.LoadFailed):
        run_incremental(spark, cfg["inc"])


def test_late_months_leave_earlier_years_of_the_observations(spark, workdir):
    rng = random.Random(13)
    rows = some_rows(rng, "abcdef", MONTHS[12:60], 0.8)
    state = {r[:3]: r[3] for r in rows}
    panel = Panel(spark, os.path.join(workdir, "p"), ["entity"], thresholds=T, start=START, buckets=2)
    assert panel.load(frame(spark, rows), AS_OF, "2024-01-01") == len(state)
    before = {(r.bucket, r.year): (r._folder, r._rows) for r in panel.observations.manifest().collect()}
    assert sum(n for _, n in before.values()) == len(state) and len({y for _, y in before}) == 4
    late = [(e, "UNRATE", "2003-11-01", 5.0 + i) for i, e in enumerate("abcdef")]
    state |= {r[:3]: r[3] for r in late}
    panel.load(frame(spark, late), AS_OF, "2024-01-02")
    after = {(r.bucket, r.year): (r._folder, r._rows) for r in panel.observations.manifest().collect()}
    assert {y for (b, y) in after if after[b, y] != before.get((b, y))} == {2003}
    assert content(panel.dashboard()) == content(full(spark, state), panel.dashboard().columns)


def test_observations_stored_in_buckets_alone_stay_so(spark, workdir):
    from tidemark.sources.snapshots import SnapshotTable

    rng = random.Random(14)
    rows, late = some_rows(rng, "abc", MONTHS[12:40], 0.8), [("b", "UNRATE", "2002-11-01", 5.0), ("b", "GDP", "2001-04-01", None)]
    state = {r[:3]: r[3] for r in rows + late}
    path, contract = os.path.join(workdir, "p", "observations"), observations_contract(["entity"])
    stored = SnapshotTable(spark, path, contract, {"bucket": "pmod(xxhash64(`entity`), 4)"})
    stored.replace(frame(spark, rows).selectExpr("entity", "series_id", "observation_date", "value", "cast(null as timestamp_ntz) ingested_at",
                                                 "cast(null as string) source_url"))
    panel = Panel(spark, os.path.join(workdir, "p"), ["entity"], thresholds=T, start=START, buckets=4)
    assert panel.load(frame(spark, late), AS_OF, "2024-01-01") == 2
    assert panel.observations.read().count() == len(state) and "year" not in panel.observations.parts
    assert content(panel.dashboard()) == content(full(spark, state), panel.dashboard().columns)


def test_repeated_months_are_not_committed(spark, workdir):
    """The uniqueness check reads two columns of what was written; the wide rows are not shuffled for it."""
    from tidemark.plans.layers import mart_audit
    from tidemark.sources.snapshots import AuditFailed

    rng = random.Random(15)
    panel = Panel(spark, os.path.join(workdir, "p"), ["entity"], thresholds=T, start=START, buckets=2)
    panel.load(frame(spark, some_rows(rng, "ab", MONTHS[12:20], 0.9)), AS_OF, "2024-01-01")
    rows, version = panel.months.read(), panel.months.version()
    with pytest.raises(AuditFailed, match="not unique: 1"):
        panel.months.replace(rows.unionByName(rows.limit(1)), None, version, "", mart_audit(["entity"]))
    assert panel.months.version() == version
    plan = mart_audit(["entity"]).on(rows, unique=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_greatest_number_of_a_key_is_picked_without_a_sort(spark):
    rows = [("a", "X", "2001-01-01", v) for v in (None, 1.0, float("nan"), -5.0)] + [("a", "X", "2001-02-01", None), (None, None, None, 2.0), (None, None, None, 3.0)]
    batch, key = frame(spark, rows), ["entity", "series_id", "observation_date"]
    got = load.dedup_batch(batch, key)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.columns == batch.columns and "Sort" not in plan and "Window" not in plan
    want = load.dedup_batch(batch, key, [F.col("value").desc_nulls_last()])
    assert list(map(repr, content(got))) == list(map(repr, content(want))) and got.count() == 3   # NaN is the greatest, and no equal of itself


def test_supplier_series_of_one_shuffle(spark, workdir):
    """Days, months and quarters per supplier: plain sums; lines are shuffled once, those of other suppliers not at all."""
    from datetime import datetime

    from tidemark.sources import fixtures as fx

    rng = random.Random(16)
    day = lambda: rng.choice([None] + [datetime(2001, m, d) for m in (1, 2, 5) for d in (1, 9, 30 if m > 2 else 28)])
    money = lambda: rng.choice([None, round(rng.uniform(0, 900), 2)])
    orders = [(i, rng.choice("FO"), money(), day()) for i in range(20)]
    lines = [(rng.randrange(22), rng.choice([None, 10, 11, 20]), money(), money(), money(), money(), day()) for _ in range(200)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(
        os.path.join(workdir, "orders.parquet"))
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                          "l_shipdate timestamp_ntz").write.parquet(os.path.join(workdir, "lineitem.parquet"))
    li = spark.read.parquet(os.path.join(workdir, "lineitem.parquet"))
    cents = lambda c: F.sum(F.rint(c * 100).cast("bigint")).cast("double")
    n, c = F.count(F.lit(1)).cast("double"), F.col
    want = []
    for sid, at, v in (("T10Y2Y", F.to_date("l_shipdate"), cents(c("l_tax") - c("l_discount")) / n),
                       ("CPIAUCSL", F.trunc("l_shipdate", "MM"), cents(c("l_extendedprice")) / n / F.lit(100)),
                       ("FEDFUNDS", F.trunc("l_shipdate", "MM"), cents(c("l_discount")) / n),
                       ("UMCSENT", F.trunc("l_shipdate", "MM"), F.sum(c("l_quantity").cast("bigint")).cast("double") / n)):
        want += content(li.groupBy(c("l_suppkey").alias("entity"), at.alias("observation_date")).agg(v.alias("value")).select(
            "entity", F.lit(sid).alias("series_id"), "observation_date", "value"))
    obs = fx.econ_observations(spark, workdir, "supplier")
    assert content(obs.where(c("series_id").isin(*fx.LINEITEM_SERIES))) == sorted(want, key=repr)
    assert obs._jdf.queryExecution().executedPlan().toString().count("Expand") == 1       # quarters of orders alone
    some = fx.econ_observations(spark, workdir, "supplier", of=c("entity") % 10 == 0)
    assert content(some) == content(obs.where(c("entity") % 10 == 0)) and some.count() > 0
    assert some._jdf.queryExecution().optimizedPlan().toString().count("% 10") >= 2
