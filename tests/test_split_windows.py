"""Split windows and as-of joins against plain windows and plain loops, whatever the ranges."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.columns import lag_diff, rolling
from tidemark.operators.asof import asof_join
from tidemark.operators.split_windows import RANGE, RangeSplit
from tidemark.plans import catalog

from .conftest import SF_SMOKE, SF_SMALL


def content(df, columns=None):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=repr)


def frame(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), i % 37, i, rng.choice([None, None, rng.randint(-50, 50)])) for i in range(n)]
    return spark.createDataFrame(rows, "k string, t int, i int, v int")


COLUMNS = {"d1": lambda w: lag_diff("v", 1, w), "d12": lambda w: lag_diff("v", 12, w), "s5": lambda w: rolling("v", "sum", 5, w),
           "next2": lambda w: F.lead("v", 2).over(w), "low": lambda w: F.min("v").over(w.rowsBetween(-3, 2))}


@pytest.mark.parametrize("ranges", [1, 4, 60])
@pytest.mark.parametrize("keys", [["k"], []])
def test_windows_equal_unsplit_windows(spark, ranges, keys):
    df = frame(spark, ranges)
    w = Window.partitionBy(*keys).orderBy("t", "i")
    want = df.select("*", *[f(w).alias(n) for n, f in COLUMNS.items()])
    split = RangeSplit(df, keys, ["t", "i"], ranges)
    assert content(split.apply(COLUMNS, back=12, ahead=2), want.columns) == content(want)
    for backward, value in ((False, F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0))),
                            (True, F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)))):
        want = df.withColumn("v", value)
        assert content(split.fill(["v"], backward), want.columns) == content(want)


@pytest.mark.parametrize("ranges", [1, 5, 60])
def test_places_in_a_key(spark, ranges):
    df = frame(spark, 40 + ranges)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t", "i")) - 1)
    assert content(RangeSplit(df, ["k"], ["t", "i"], ranges).numbered("n")) == content(want)


def test_empty_frames_and_all_null_keys(spark):
    df = frame(spark, 1).limit(0)
    split = RangeSplit(df, ["k"], ["t", "i"], 5)
    assert split.apply(COLUMNS, 12, 2).collect() == [] and split.fill(["v"]).collect() == []
    df = frame(spark, 1).withColumn("k", F.lit(None).cast("string"))
    w = Window.partitionBy("k").orderBy("t", "i")
    assert content(RangeSplit(df, ["k"], ["t", "i"], 9).apply({"s": COLUMNS["s5"]}, 4)) == content(df.withColumn("s", COLUMNS["s5"](w)))


def test_no_task_holds_a_whole_hot_key(spark):
    """Each return flag has a third of all lines; no range, the unit of a window task, has a third of a flag."""
    from tidemark.sources import fixtures as fx

    lines = fx.hot_lines(spark, SF_SMALL)
    split = RangeSplit(lines, ["l_returnflag"], fx.HOT_ORDER, 24)
    per_key = {r[0]: r[1] for r in lines.groupBy("l_returnflag").count().collect()}
    largest = {r[0]: r[1] for r in split.rows.groupBy("l_returnflag", RANGE).count().groupBy("l_returnflag").agg(F.max("count")).collect()}
    assert min(per_key.values()) > 0.3 * lines.count() and all(largest[k] < per_key[k] / 3 for k in per_key)
    plan = split.apply({"low": lambda w: rolling("cents", "min", 12, w)}, 12)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    for line in (x for x in plan.splitlines() if "hashpartitioning(" in x):
        assert RANGE in line.split("hashpartitioning(")[1] or "_at" in line, line


def brute(left, right, direction, within, strict):
    out = []
    for i, k, t in left:
        ok = [] if k is None or t is None else [
            (abs(t - rt), rt > t, -tie, v) for rk, rt, tie, v in right if rk == k and rt is not None
            and (not strict or rt != t) and (within is None or abs(t - rt) <= within)
            and (direction == "nearest" or rt == t or (rt < t) == (direction == "backward"))]
        out.append((i, k, t, min(ok)[3] if ok else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("within, strict", [(None, False), (3, False), (4, True)])
def test_asof_equals_a_plain_search(spark, direction, within, strict):
    rng = random.Random(f"{direction}{within}{strict}")
    when = lambda: rng.choice([None] + list(range(60)))
    left = [(i, rng.choice(["hot"] * 5 + ["a", "empty", None]), when()) for i in range(120)]
    right = [(rng.choice(["hot", "hot", "a", None]), when(), tie, f"v{tie}") for tie in range(60)]
    l_df = spark.createDataFrame(left, "i int, k string, t int")
    r_df = spark.createDataFrame(right, "k string, rt int, tie int, v string")
    got = asof_join(l_df, r_df, ["k"], "t", "rt", {"v": "v"}, direction, None if within is None else F.lit(within), ["tie"], strict, ranges=7)
    assert content(got) == brute(left, right, direction, within, strict)
    with pytest.raises(ValueError):
        asof_join(l_df, r_df, ["k"], "t", "rt", {"v": "v"}, "sideways")


def test_queries_do_not_depend_on_the_ranges(spark):
    q = catalog.queries()
    before = {k: content(q[k](spark, SF_SMOKE)) for k in ("hot_rolling", "hot_forward_fill")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    try:
        assert {k: content(q[k](spark, SF_SMOKE)) for k in before} == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
