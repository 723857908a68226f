"""Stored tables: audits inside the writing job, files skipped by month ranges, contracts of several versions."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import Watch
from tidemark.plans.layers import mart_audit
from tidemark.schemas import MONTH
from tidemark.sources import tables
from tidemark.sources.snapshots import AuditFailed, ContractError, SnapshotTable


def mart(spark, rows):
    return spark.createDataFrame(rows, "entity string, m string, recession_risk_level string, x double").select(
        "entity", F.to_date("m").alias(MONTH), "recession_risk_level", "x")


def months(n, entities="abcdefgh", first=1990):
    return [(e, f"{first + i // 12}-{i % 12 + 1:02d}-01", "LOW", float(i)) for i in range(n) for e in entities]


def jobs(spark, fn):
    """How many jobs ``fn`` runs."""
    sc = spark.sparkContext
    group = f"jobs-{os.urandom(4).hex()}"
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_audits_add_no_job(spark, workdir):
    df = mart(spark, months(30)).repartition(4)
    plain = jobs(spark, lambda: tables.publish(df, workdir, "marts", "plain"))
    watched = jobs(spark, lambda: tables.publish(df, workdir, "marts", "watched", audit=Watch([("x", "not_null", "x")])))
    assert watched == plain
    table = lambda n: SnapshotTable(spark, os.path.join(workdir, n), df.schema, {"entity": "entity"})
    assert jobs(spark, lambda: table("a").replace(df)) == jobs(
        spark, lambda: table("b").replace(df, audit=Watch([("x", "not_null", "x")])))


@pytest.mark.parametrize("bad, message", [
    (("a", "1990-02-01", "LOW", 1.0), "entity, observation_month not unique: 1"), (("z", None, "LOW", 1.0), "month_not_null: 1"),
    (("z", "1990-02-01", "SOME", 1.0), "risk_level_accepted: 1")])
def test_audits_find_what_fails_and_keep_the_version_back(spark, workdir, bad, message):
    good = mart(spark, months(5))
    tables.publish(good, workdir, "marts", "t", audit=mart_audit(["entity"]), cluster_by=[MONTH, "entity"])
    with pytest.raises(AuditFailed, match=message):
        tables.publish(mart(spark, months(5) + [bad]), workdir, "marts", "t", audit=mart_audit(["entity"]), cluster_by=[MONTH, "entity"])
    assert tables.read_current(spark, workdir, "marts", "t").count() == 40
    table = SnapshotTable(spark, os.path.join(workdir, "s"), good.schema, {"entity": "entity"})
    with pytest.raises(AuditFailed, match=message):
        table.replace(mart(spark, months(5) + [bad]), audit=mart_audit(["entity"]))
    assert table.version() is None


def test_audits_add_no_shuffle(spark):
    """After metric windows by entity, or a range partitioning by month and entity, equal rows lie together."""
    from pyspark.sql import Window

    df = mart(spark, months(5)).withColumn("y", F.lag("x").over(Window.partitionBy("entity").orderBy(MONTH)))
    n = lambda d: d._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert n(mart_audit(["entity"]).on(df)) == n(df) == 1
    ranged = mart(spark, months(5)).repartitionByRange(MONTH, "entity")
    assert n(mart_audit(["entity"]).on(ranged)) == n(ranged) == 1


def test_audits_of_empty_tables_pass(spark, workdir):
    empty = mart(spark, []).where("x > 1")
    tables.publish(empty, workdir, "marts", "t", audit=mart_audit(["entity"]), cluster_by=[MONTH])
    assert tables.read_mart(spark, workdir, "t", lo="1990-01-01").count() == 0
    tables.publish(mart(spark, months(2)).where("x > 100"), workdir, "marts", "u", audit=mart_audit([]))
    assert tables.read_mart(spark, workdir, "u").count() == 0


def test_month_ranges_open_only_their_files(spark, workdir):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.publish(mart(spark, months(240) + [("n", None, "LOW", 1.0)]), workdir, "marts", "t", cluster_by=[MONTH, "entity"], lookups=["entity"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = tables.read_mart(spark, workdir, "t")
    assert len(whole.inputFiles()) >= 6 and whole.count() == 240 * 8 + 1
    some = tables.read_mart(spark, workdir, "t", lo="1995-03-01", hi="1995-08-01")
    assert len(some.inputFiles()) <= 2
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.where(
        "observation_month between timestamp_ntz '1995-03-01' and timestamp_ntz '1995-08-01'").collect()))
    assert tables.read_mart(spark, workdir, "t", lo="2030-01-01").count() == 0
    late = tables.read_mart(spark, workdir, "t", lo="2009-01-01", sort=True)
    assert len(late.inputFiles()) < len(whole.inputFiles()) and late.count() == 12 * 8
    tables.publish(mart(spark, months(24)), workdir, "marts", "plain")            # without ranges: a filter
    assert tables.read_mart(spark, workdir, "plain", hi="1990-03-01").count() == 24


def schema(*fields):
    return T.StructType([T.StructField(n, t, null) for n, t, null in fields])


def test_two_contracts_read_as_one(spark, workdir):
    one = schema(("k", T.StringType(), False), ("v", T.IntegerType(), True), ("old", T.StringType(), True))
    two = schema(("k", T.StringType(), False), ("v", T.LongType(), True), ("unit", T.StringType(), False), ("note", T.StringType(), True))
    three = schema(("k", T.StringType(), False), ("v", T.DoubleType(), True), ("unit", T.StringType(), False))
    path, part, defaults = os.path.join(workdir, "t"), {"k": "k"}, {"unit": "concat('u-', k)"}
    SnapshotTable(spark, path, one, part).replace(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", None, "z")], one))
    t2 = SnapshotTable(spark, path, two, part, [one], defaults)
    assert sorted(map(tuple, t2.read().collect()), key=repr) == [("a", 1, "u-a", None), ("b", 2, "u-b", None), ("c", None, "u-c", None)]
    new = spark.createDataFrame([("b", 1 << 40, "kg", "n")], two)
    t2.replace(new, t2.values(new), 1)
    assert {r.k: r._contract for r in t2.manifest().collect()} == {"a": 0, "b": 1, "c": 0}
    with pytest.raises(ContractError, match="does not widen"):
        SnapshotTable(spark, path, schema(("k", T.StringType(), False), ("v", T.FloatType(), True)), part, [one, two], defaults)
    with pytest.raises(ContractError, match="NOT NULL"):
        SnapshotTable(spark, path, two, part, [one])
    with pytest.raises(ContractError, match="does not widen"):
        SnapshotTable(spark, path, three, part, [one, two], defaults)   # whole numbers of 64 bits do not fit a double
    four = schema(("k", T.StringType(), False), ("v", T.LongType(), True), ("unit", T.StringType(), False))
    t4 = SnapshotTable(spark, path, four, part, [one, two], defaults)
    bad = spark.createDataFrame([("d", 5, "much too long")], four)
    t4.replace(bad, t4.values(bad), 2)
    ok, broken = t4.read_checked({"unit": 4})
    assert sorted(map(tuple, ok.collect()), key=repr) == [("a", 1, "u-a"), ("b", 1 << 40, "kg"), ("c", None, "u-c")]
    assert [tuple(r) for r in broken.collect()] == [("d", 5, "much too long")]


def bucket_rows(rng, n, entities=40):
    return [(f"e{rng.randrange(entities)}", rng.randrange(30), rng.random() if rng.random() < 0.9 else None)
            for _ in range(n)]


def test_merges_into_buckets_do_not_shuffle_the_stored_side(spark, workdir):
    import random

    from tidemark.operators.load import upsert
    from tidemark.sources.bucketed import BucketedTable

    rng, s = random.Random(4), schema(("k", T.StringType(), False), ("d", T.IntegerType(), False), ("v", T.DoubleType(), True))
    table = BucketedTable(spark, os.path.join(workdir, "b"), s, ["k", "d"], 16)
    state = spark.createDataFrame(list({r[:2]: r for r in bucket_rows(rng, 900)}.values()), s)
    table.write(state)
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(table.read()) == key(state)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in (200, 0, 50):
            batch = spark.createDataFrame(bucket_rows(rng, n, 60), s)
            want = key(upsert(table.read(), batch, ["k", "d"], stamp=None))
            merged = table.merged(batch, stamp=None)
            plan = merged._jdf.queryExecution().executedPlan().toString()
            side = plan[plan.index("SortMergeJoin"):].split("\n")
            scan = next(i for i, x in enumerate(side) if "FileScan parquet" in x)
            assert "Bucketed: true" in side[scan] and not any("Exchange" in x for x in side[:scan]), plan
            files = {f.split("/")[-1] for f in table.read().inputFiles()}
            table.upsert(batch)
            assert key(table.read()) == want and len(files) <= 16
        latest = table.read()
        from tidemark.operators.dedup import latest_per_key

        plan = latest_per_key(latest, ["k", "d"], [F.col("v").desc()])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, plan
        with pytest.raises(Exception, match="k is NULL"):
            table.merged(spark.createDataFrame([(None, 1, 2.0)], "k string, d int, v double"), stamp=None).collect()
        with pytest.raises(ValueError, match="NOT NULL"):
            BucketedTable(spark, "x", schema(("k", T.StringType(), True)), ["k"], 4)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
