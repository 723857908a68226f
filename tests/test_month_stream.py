"""The event-time month stream: restarts, late and revised rows give what one batch load of all files gives."""

import json
import os
import random
import time

from pyspark.sql import functions as F

from tidemark.operators import load
from tidemark.operators.dedup import latest_per_key
from tidemark.plans.incremental import Panel
from tidemark.schemas import SeriesSpec
from tidemark.sources import landing, tables
from tidemark.streaming import landing_stream as ls
from tidemark.streaming.month_stream import good_rows, run_month_stream

from .test_incremental import AS_OF, MONTHS, START, T, content, same_summary, some_rows


def land(folder, name, rows, age, lines=False):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    obs = [{"entity": e, "date": d, "value": "." if v is None else str(v)} for e, _, d, v in rows]
    with open(path, "w") as f:
        if lines:
            f.write("\n".join(json.dumps(o) for o in obs))
        else:
            json.dump({"observations": obs}, f)
    os.utime(path, (time.time() - age,) * 2)


def batch_panel(spark, folder, root):
    panel = Panel(spark, root, ["entity"], thresholds=T, start=START, buckets=4)
    rows = landing.read_observation_landing(spark, folder, ["entity"])[0]
    from tidemark.functions.columns import parse_value

    last = latest_per_key(rows, ["entity", "series_id", "observation_date"], [F.col(c).desc() for c in landing.FILE_ORDER])
    panel.load(last.withColumn("value", parse_value("raw_value")), AS_OF, "2024-01-01")
    return panel


def test_restarts_late_and_revised_rows_equal_the_batch(spark, workdir):
    rng = random.Random(21)
    folder, ckpt = os.path.join(workdir, "land"), os.path.join(workdir, "ckpt")
    panel = Panel(spark, os.path.join(workdir, "stream"), ["entity"], thresholds=T, start=START, buckets=4)

    def drop(tag, rows, age):
        for n, s in enumerate(sorted({r[1] for r in rows})):
            land(folder, f"{s}__{tag}.json{'l' if n % 2 else ''}", [r for r in rows if r[1] == s], age, n % 2)

    drop("1", some_rows(rng, "abc", MONTHS[12:30], 0.9), 5000)
    land(folder, "UNRATE__bad.json", [("a", "UNRATE", "2000-02-01", "n/a"), ("a", "UNRATE", "soon", 1.0)], 5000)
    q = run_month_stream(panel, folder, ckpt, AS_OF)
    # a restart: newer months, revisions in reach of the watermark, and late rows far behind it
    drop("2", some_rows(rng, "ab", MONTHS[28:44], 0.9, 0.2), 4000)
    drop("3", some_rows(rng, "bd", MONTHS[13:16], 0.9, 0.3), 3000)
    q = run_month_stream(panel, folder, ckpt, AS_OF)
    drop("4", some_rows(rng, "c", MONTHS[42:46], 0.9) + some_rows(rng, "a", MONTHS[14:15], 1.0), 2000)
    q = run_month_stream(panel, folder, ckpt, AS_OF)
    dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    kept = q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert dropped > 0                                  # the late rule was needed
    assert kept < panel.observations.read().count() / 2  # state of closed months is gone
    version = panel.observations.version()
    run_month_stream(panel, folder, ckpt, AS_OF)        # nothing new
    bad = [os.path.join(folder, "UNRATE__bad.json")]
    for path in bad:
        os.remove(path)                                 # the batch form has no rule for rows that do not parse
    want = batch_panel(spark, folder, os.path.join(workdir, "batch"))
    assert content(panel.dashboard()) == content(want.dashboard(), panel.dashboard().columns) and want.dashboard().count() > 0
    assert same_summary(panel.summary(), want.summary())
    assert panel.observations.version() >= version


def test_plan_of_the_stream_is_stateful_and_has_no_python(spark, workdir):
    land(workdir, "UNRATE.json", [("a", "UNRATE", "2001-02-01", 1.0)], 10)
    from tidemark.streaming.month_stream import latest_values

    rows = latest_values(good_rows(ls.observation_stream(spark, workdir, keys=["entity"]), ["entity"]), ["entity"])
    plan = rows._jdf.queryExecution().logical().toString()
    assert rows.isStreaming and "EventTimeWatermark" in plan and "Python" not in plan


def test_line_delimited_files_reach_the_load_stream(spark, workdir):
    folder, root, ckpt = (os.path.join(workdir, d) for d in ("obs", "wh", "ckpt"))
    specs = [SeriesSpec(i, f"c_{k}") for k, i in enumerate(("A", "B", "C"))]
    os.makedirs(folder)
    with open(os.path.join(folder, "A__1.jsonl"), "w") as f:
        f.write("\n".join(json.dumps({"date": f"2024-01-{d:02d}", "value": str(d)}) for d in range(1, 29)))
        f.write("\n" + json.dumps({"date": "2024-02-01", "value": "5", "series_id": "B"}))
    with open(os.path.join(folder, "C.json"), "w") as f:
        json.dump({"observations": [{"date": "2024-01-01", "value": "7"}]}, f)
    ls.run_incremental_load(spark, folder, root, ckpt, specs=specs, now="2024-03-01 00:00:00")
    raw = tables.read_observations(spark, os.path.join(root, "raw", "observations"))
    assert {r[0]: r[1] for r in raw.groupBy("series_id").count().collect()} == {"A": 28, "B": 1, "C": 1}
    with open(os.path.join(folder, "A__2.jsonl"), "w") as f:
        f.write(json.dumps({"date": "2024-01-05", "value": "bad"}))
    try:
        ls.run_incremental_load(spark, folder, root, ckpt, specs=specs, now="2024-03-01 00:00:00")
        raise AssertionError("a bad line fails its series")
    except load.LoadFailed as e:
        assert "A" in str(e)
    log = tables.read_log(spark, os.path.join(root, "raw", "ingestion_log"))
    assert {(r.series_id, r.status) for r in log.collect()} >= {("A", "SUCCESS"), ("A", "FAILED"), ("B", "SUCCESS"), ("C", "SUCCESS")}
