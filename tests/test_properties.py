"""Invariants on random inputs (hypothesis), checked against plain-Python references."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import align, dedup, load, signals
from tidemark.schemas import RISK_LEVELS

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

loads = st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 3),
                           st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)),
                           st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 10 ** 6)),
                 min_size=1, max_size=25, unique_by=lambda t: t[4])


def _raw(spark, rows):
    base = dt.datetime(2024, 1, 1)
    data = [(s, dt.date(2024, 1, 1) + dt.timedelta(days=d), v,
             None if t is None else base + dt.timedelta(hours=t), "u", lid) for s, d, v, t, lid in rows]
    return spark.createDataFrame(data, "series_id string, observation_date date, value double, "
                                       "ingested_at timestamp_ntz, source_url string, load_id long")


@SETTINGS
@given(rows=loads)
def test_dedup_matches_reference(spark, rows):
    out = dedup.stage_observations(_raw(spark, rows), [F.col("load_id").desc()]).collect()
    keys = [(r.series_id, r.observation_date) for r in out]
    assert len(keys) == len(set(keys))
    # reference: per key, NULL load time first, then newest, then highest load id; drop NULL values
    best = {}
    for s, d, v, t, lid in rows:
        rank = (t is None, -1 if t is None else t, lid)
        k = (s, d)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, v)
    expected = sorted((k[0], k[1], v) for k, (_, v) in best.items() if v is not None)
    got = sorted((r.series_id, (r.observation_date - dt.date(2024, 1, 1)).days, r.value) for r in out)
    assert got == expected


@SETTINGS
@given(rows=loads, batch_rows=loads)
def test_upsert_is_idempotent(spark, rows, batch_rows):
    target = dedup.latest_per_key(_raw(spark, rows), ["series_id", "observation_date"],
                                  [F.col("load_id").desc()]).drop("load_id")
    batch = _raw(spark, batch_rows).drop("load_id")
    once = load.upsert(target, batch, now="2024-02-01 00:00:00")
    twice = load.upsert(once, batch, now="2024-02-01 00:00:00")
    a, b = sorted(map(tuple, once.collect()), key=repr), sorted(map(tuple, twice.collect()), key=repr)
    assert a == b
    keys = [(r[0], r[1]) for r in a]
    assert len(keys) == len(set(keys))


months = st.lists(st.tuples(st.integers(0, 23), st.one_of(st.none(), st.floats(0, 100, allow_nan=False))),
                  min_size=1, max_size=20, unique_by=lambda t: t[0])


@SETTINGS
@given(gdp=months, unrate=st.sets(st.integers(0, 23), min_size=1))
def test_fill_never_changes_a_value(spark, gdp, unrate):
    m0 = dt.date(2020, 1, 1)

    def month(i):
        return dt.date(m0.year + (m0.month - 1 + i) // 12, (m0.month - 1 + i) % 12 + 1, 1)

    rows = [("GDP", month(i), v) for i, v in gdp if v is not None]
    rows += [("UNRATE", month(i), 1.0) for i in unrate]
    obs = spark.createDataFrame(rows, "series_id string, observation_date date, value double")
    wide = {r.observation_month: r.gdp for r in
            align.monthly_wide(obs, start="2020-01-01", as_of="2021-12-31").collect()}
    known = {month(i): v for i, v in gdp if v is not None}
    for m, g in wide.items():
        if m in known:
            assert g == known[m]
        else:
            prev = [known[k] for k in sorted(known) if k < m]
            assert g == (prev[-1] if prev else None)


@SETTINGS
@given(vals=st.lists(st.tuples(*[st.one_of(st.none(), st.floats(-10, 100, allow_nan=False))] * 6),
                     min_size=1, max_size=10))
def test_count_is_sum_of_flags_and_level_follows_count(spark, vals):
    cols = ["unemployment_rate_3m_avg", "unemployment_rate_12m_low", "treasury_spread_10y2y",
            "inflation_rate_yoy", "consumer_sentiment", "fed_funds_rate_yoy_change"]
    df = spark.createDataFrame([(dt.date(2020, 1, 1), *v) for v in vals],
                               "observation_month date, " + ", ".join(f"{c} double" for c in cols))
    for r in signals.with_signals(df).collect():
        flags = [r[c] for c in signals.SIGNAL_FLAGS]
        assert all(f in (0, 1) for f in flags)
        assert r.recession_signal_count == sum(flags)
        c = r.recession_signal_count
        assert r.recession_risk_level == RISK_LEVELS[min(c, 3)]
