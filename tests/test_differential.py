"""Random panels: the fused DataFrame plan vs the plain spine/join/window SQL in DuckDB.

Each example draws monthly series with gaps, quarterly values partly before the
spine, and several daily values per month, for two entities; the Spark chain
(monthly_wide -> derived_metrics -> economic_dashboard) must equal the
reference-style SQL cell by cell.
"""

import datetime as dt
import math

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import align, marts, metrics
from tidemark.plans import oracle as O
from tidemark.plans.catalog import FIX_T

START, AS_OF = "1996-01-01", "1997-12-31"
BASE = dt.date(1995, 10, 1)          # three months before the spine start
ROUNDED = {"inflation_rate_yoy", "inflation_rate_mom_annualized", "gdp_qoq_growth_rate", "sahm_rule_value"}


def month(i):
    return dt.date(BASE.year + (BASE.month - 1 + i) // 12, (BASE.month - 1 + i) % 12 + 1, 1)


@st.composite
def panel(draw):
    rows = []
    for e in ("e1", "e2"):
        for sid in ("UNRATE", "CPIAUCSL", "FEDFUNDS", "UMCSENT"):
            for m in draw(st.sets(st.integers(0, 29), min_size=1, max_size=30)):
                rows.append((e, sid, month(m), float(draw(st.integers(1, 60)))))
        for q in draw(st.sets(st.integers(0, 9), max_size=10)):
            rows.append((e, "GDP", month(3 * q), float(draw(st.integers(50, 150)))))
        for d in draw(st.sets(st.integers(0, 900), max_size=40)):
            rows.append((e, "T10Y2Y", BASE + dt.timedelta(days=d), draw(st.integers(-20, 20)) / 4))
    return rows


def _close(a, b, col):
    if a is None or b is None or (isinstance(b, float) and math.isnan(b)):
        return (a is None) and (b is None or (isinstance(b, float) and math.isnan(b)))
    if isinstance(a, float):
        return abs(a - b) <= (0.0100001 if col in ROUNDED else 1e-9 * max(1.0, abs(a)))
    return a == b


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=panel())
def test_dashboard_equals_reference_sql(spark, rows):
    obs = spark.createDataFrame(rows, "entity string, series_id string, observation_date date, value double")
    wide = align.monthly_wide(obs, start=START, as_of=AS_OF, keys=["entity"])
    dash = marts.economic_dashboard(metrics.derived_metrics(wide, ["entity"]), FIX_T, ["entity"])
    cols = dash.columns
    got = sorted((tuple(r) for r in dash.collect()), key=lambda t: (t[0], t[1]))

    con = duckdb.connect()
    con.register("obs_input", pd.DataFrame(rows, columns=["entity", "series_id", "observation_date", "value"]))
    sql = O.dash_ctes("custom", start=START, as_of=AS_OF, obs_cte=(
        "obs AS (SELECT entity, series_id, CAST(observation_date AS DATE) AS observation_date, value "
        "FROM obs_input)")) + f"\nSELECT {', '.join(cols)} FROM dash"
    want = sorted(con.sql(sql).fetchall(), key=lambda t: (t[0], t[1]))

    assert len(got) == len(want)
    for g, w in zip(got, want):
        for c, a, b in zip(cols, g, w):
            assert _close(a, b, c), (c, g[:2], a, b)
