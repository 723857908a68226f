"""Physical-plan properties that matter at scale."""

import os

from pyspark.sql import functions as F

from tidemark.operators import align, dedup
from tidemark.plans import catalog
from tidemark.sources import fixtures as fx

from .conftest import SF_SMOKE


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_panel_path_has_no_single_partition_exchange(spark):
    p = plan(catalog.queries()["panel_economic_dashboard"](spark, SF_SMOKE))
    assert "SinglePartition" not in p
    assert "hashpartitioning(entity" in p


def test_dedup_limits_rows_before_the_shuffle(spark, workdir):
    raw = fx.revised_observations(spark, SF_SMOKE)
    p = plan(dedup.stage_observations(raw, [F.col("event_id").desc()]))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_series_filter_reaches_the_scan(spark, workdir):
    path = os.path.join(workdir, "obs")
    fx.econ_observations(spark, SF_SMOKE).write.parquet(path)
    wide = align.monthly_wide(spark.read.parquet(path), start=fx.SPINE_START, as_of=fx.AS_OF)
    p = plan(wide)
    assert "PushedFilters: [In(series_id" in p or "PushedFilters: [IsNotNull(series_id), In(series_id" in p


def test_one_scan_per_source_table(spark):
    p = plan(catalog.queries()["economic_dashboard"](spark, SF_SMOKE))
    assert p.count("lineitem.parquet") == 1 and p.count("orders.parquet") == 1
    # coarse grains are added up from the fine one: Expand stands over the first aggregate, not over the scan
    lines = [x for x in p.split("\n") if "Expand" in x or "lineitem.parquet" in x or "HashAggregate" in x]
    at = next(i for i, x in enumerate(lines) if "Expand" in x)
    assert "HashAggregate" in lines[at + 1]


def test_single_series_read_one_table(spark):
    for key, used, unused in (("gdp_forward_fill", "orders", "lineitem"), ("month_end_daily", "lineitem", "orders")):
        p = plan(catalog.queries()[key](spark, SF_SMOKE))
        assert f"{used}.parquet" in p and f"{unused}.parquet" not in p


def test_summary_adds_no_exchange(spark):
    d = plan(catalog.queries()["panel_economic_dashboard"](spark, SF_SMOKE))
    s = plan(catalog.queries()["panel_indicator_summary"](spark, SF_SMOKE))
    assert s.count("Exchange") == d.count("Exchange")


def test_shuffle_sizing_respects_user_setting(spark, workdir):
    from tidemark.session import size_shuffles

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    prev = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        n = size_shuffles(spark, ["/root/testdata/sf0.01"], target_bytes=1024 * 1024)
        assert n is not None and n >= spark.sparkContext.defaultParallelism
        assert size_shuffles(spark, ["/root/testdata/sf0.01"]) is None   # already set: left alone
    finally:
        spark.conf.unset(key)
        if prev:
            spark.conf.set(key, prev)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin",          # cross joins / all pairs
             "BatchEvalPython", "ArrowEvalPython", "PythonUDF",       # Python in the hot path
             "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow")


def test_no_cross_join_and_no_python_in_any_registered_query(spark):
    bad = {}
    for key, fn in catalog.queries().items():
        p = plan(fn(spark, SF_SMOKE))
        hits = [f for f in FORBIDDEN if f in p]
        if hits:
            bad[key] = hits
    assert not bad, bad
