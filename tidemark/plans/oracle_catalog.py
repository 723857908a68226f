"""Oracle SQL per registered key (DuckDB dialect; tables are pre-registered views)."""

from __future__ import annotations

from ..schemas import DEFAULT_SERIES, DEFAULT_START_DATE, WIDE_COLUMNS
from ..sources import fixtures as fx
from . import oracle as O
from .catalog import (FRESHNESS_NOW, META_BATCH_FROM, META_BATCH_BELOW, CONTRACT_URL_LENGTH, NOW, OVERVIEW_COLUMNS,
                      RANGE_FROM, RUN_ID)
from ..operators.load import SOURCE_URL_BASE
from ..operators.signals import SIGNAL_FLAGS, SIGNAL_MODEL_COLUMNS

_IDS = ", ".join(f"'{s.series_id}'" for s in DEFAULT_SERIES)
_ID_ROWS = ", ".join(f"('{s.series_id}')" for s in DEFAULT_SERIES)
_DIM = (f"dim AS (SELECT series_id FROM (VALUES {_ID_ROWS}) t(series_id)"
        " UNION SELECT DISTINCT event_type FROM events)")



def _two_contracts(where: str) -> str:
    new = ", ".join(f"'{x}'" for x in fx.CONTRACT_NEW_SERIES)
    return f"""
SELECT series_id, event_id, observation_date, value, unit FROM (
  SELECT event_type AS series_id, event_id, CAST(ts AS DATE) AS observation_date,
         CASE WHEN event_type IN ({new}) THEN value ELSE floor(value) END AS value,
         CASE WHEN event_type NOT IN ({new}) THEN 'count' WHEN event_id % 7 = 0 THEN 'far too long' ELSE 'points' END AS unit
  FROM events) WHERE {where.format(n=fx.CONTRACT_UNIT_LENGTH)}"""


_META = """
    m AS (SELECT o_orderpriority AS series_id, 'order ' || CAST(o_orderkey AS VARCHAR) AS title,
                 o_orderstatus AS frequency, CAST(NULL AS VARCHAR) AS units, CAST(NULL AS VARCHAR) AS seasonal_adj,
                 o_orderdate AS last_updated, o_orderdate AS ingested_at, o_orderkey
          FROM orders)"""

_LOG = f"""WITH {O.landing_text_cte()},
    {_DIM},
    per AS (SELECT series_id, count(*) AS n, count(*) FILTER (WHERE bad_row) AS nbad,
                   min(CASE WHEN observation_date IS NULL THEN '<bad date>'
                            WHEN length(series_id) > 20 THEN '<series id too long>'
                            ELSE coalesce(raw_value, '<no value>') END) FILTER (WHERE bad_row) AS bad_text
            FROM (SELECT *, (is_bad OR observation_date IS NULL OR length(series_id) > 20) AS bad_row FROM parsed)
            WHERE observation_date IS NULL OR observation_date >= DATE '{DEFAULT_START_DATE}' GROUP BY series_id),
    st AS (SELECT d.series_id, per.n, per.bad_text, coalesce(per.nbad, 0) > 0 AS failed
           FROM dim d LEFT JOIN per ON d.series_id = per.series_id),
    logq AS (
      SELECT '{RUN_ID}' AS run_id, series_id,
             CAST(CASE WHEN failed THEN 0 ELSE coalesce(n, 0) END AS INTEGER) AS records_fetched,
             CASE WHEN failed THEN 'FAILED' ELSE 'SUCCESS' END AS status,
             TIMESTAMP '{NOW}' AS started_at, TIMESTAMP '{NOW}' AS completed_at,
             CASE WHEN failed THEN substr('could not convert value to float: ''' || bad_text || '''', 1, 2000) END
               AS error_message
      FROM st)"""

_FAILED = f"""WITH {O.landing_text_cte()},
    failed AS (SELECT series_id FROM parsed
               WHERE observation_date IS NULL OR observation_date >= DATE '{DEFAULT_START_DATE}'
               GROUP BY series_id
               HAVING count(*) FILTER (WHERE is_bad OR observation_date IS NULL OR length(series_id) > 20) > 0)"""


def _k(entity):
    return "entity, " if entity else ""


def _on(entity, a, b):
    return f"{a}.entity = {b}.entity AND " if entity else ""


def _wide_q(select: str, entity=None) -> str:
    return O.wide_ctes(entity) + "\n" + select


def _metric_q(cols, entity=None) -> str:
    return (O.wide_ctes(entity) + O.metrics_cte(entity)
            + f"\nSELECT {_k(entity)}observation_month, {', '.join(cols)} FROM metrics")


def _signal_q(cols, entity=None) -> str:
    return (O.wide_ctes(entity) + O.metrics_cte(entity) + O.signals_cte()
            + f"\nSELECT {_k(entity)}observation_month, {', '.join(cols)} FROM signals")


def _dash_q(select: str, entity=None) -> str:
    return O.dash_ctes(entity) + "\n" + select


def _observation_counts(entity=None):
    cols = ", ".join(WIDE_COLUMNS)
    return _dash_q(f"""SELECT {_k(entity)}indicator, count(*) AS observation_count
FROM (UNPIVOT (SELECT {_k(entity)}observation_month, {cols} FROM dash) ON {cols} INTO NAME indicator VALUE value)
WHERE value IS NOT NULL GROUP BY ALL""", entity)


def _completeness(entity=None):
    cols = ["observation_month", *WIDE_COLUMNS]
    counts = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in cols)
    join = "JOIN mx ON d.entity = mx.entity" if entity else "CROSS JOIN mx"
    group = "GROUP BY entity" if entity else ""
    return (O.dash_ctes(entity) + f""",
    mx AS (SELECT {_k(entity)}max(observation_month) AS mx FROM dash {group}),
    recent AS (SELECT d.* FROM dash d {join} WHERE d.observation_month >= CAST(mx.mx - INTERVAL 24 MONTH AS DATE)),
    c AS (SELECT {_k(entity)}{counts} FROM recent {group})
SELECT * FROM (UNPIVOT c ON {', '.join(cols)} INTO NAME column_name VALUE missing_values)""")


def _latest_level(entity=None):
    group = "GROUP BY entity" if entity else ""
    return f""",
    lm AS (SELECT {_k(entity)}max(observation_month) FILTER (WHERE recession_risk_level IS NOT NULL) AS latest_month
           FROM dash {group}),
    lr AS (SELECT {'d.entity, ' if entity else ''}lm.latest_month, d.* EXCLUDE ({_k(entity)}observation_month)
           FROM lm JOIN dash d ON {_on(entity, 'd', 'lm')}d.observation_month = lm.latest_month)"""


def _current_risk(entity=None):
    return (O.dash_ctes(entity) + _latest_level(entity)
            + f"\nSELECT {_k(entity)}latest_month, recession_risk_level, recession_signal_count FROM lr")


_SIGNALS = (("Sahm Rule", "signal_sahm_rule", "sahm_rule_value"),
            ("Yield Curve", "signal_yield_curve_inverted", "treasury_spread_10y2y"),
            ("High Inflation", "signal_high_inflation", "inflation_rate_yoy"),
            ("Low Sentiment", "signal_low_sentiment", "consumer_sentiment"),
            ("Fed Tightening", "signal_fed_tightening", "fed_funds_rate_yoy_change"))


def _signal_status(entity=None):
    parts = [f"""SELECT {_k(entity)}latest_month, '{label}' AS signal, {f} AS flag,
       CASE WHEN {f} IS NULL THEN 'No Data' WHEN {f} = 1 THEN 'Active' ELSE 'Inactive' END AS status,
       CAST({v} AS DOUBLE) AS driving_value FROM lr""" for label, f, v in _SIGNALS]
    return O.dash_ctes(entity) + _latest_level(entity) + "\n" + "\nUNION ALL ".join(parts)


_KPI = (("Unemployment Rate", "unemployment"), ("Inflation (YoY)", "inflation"),
        ("Fed Funds Rate", "fed_funds"), ("Consumer Sentiment", "sentiment"))


def _kpi(entity=None):
    parts = [f"SELECT {_k(entity)}latest_month, '{label}' AS indicator, {p}_current AS current_value, "
             f"{p}_mom_change AS mom_change FROM summ" for label, p in _KPI]
    return f"WITH summ AS ({O.summary_sql(entity)})\n" + "\nUNION ALL ".join(parts)


def _month_bounds(entity=None):
    group = "GROUP BY entity" if entity else ""
    return _dash_q(f"SELECT {_k(entity)}min(observation_month) AS min_month, max(observation_month) AS max_month "
                   f"FROM dash {group}", entity)


_CHANGES = ("unemployment_rate_mom_change", "unemployment_rate_yoy_change", "fed_funds_rate_mom_change",
            "fed_funds_rate_yoy_change", "sentiment_mom_change")
_PCTS = ("inflation_rate_yoy", "inflation_rate_mom_annualized", "gdp_qoq_growth_rate")
_ROLLS = ("unemployment_rate_3m_avg", "unemployment_rate_12m_avg", "sentiment_3m_avg", "treasury_spread_3m_avg")


def _panelable(entity=None) -> dict[str, str]:
    k = _k(entity)
    return {
        "dq_row_reconcile": _wide_q(f"""
SELECT {k}staging_months, pivoted_rows, pivoted_rows - staging_months AS row_difference,
       pivoted_rows = 0 OR pivoted_rows > staging_months * 1.1 OR pivoted_rows < staging_months * 0.5 AS failed
FROM (SELECT {k}sum(a)::BIGINT AS staging_months, sum(b)::BIGINT AS pivoted_rows FROM (
        SELECT {k}count(DISTINCT observation_date) AS a, 0 AS b FROM obs WHERE series_id = 'UNRATE' GROUP BY ALL
        UNION ALL SELECT {k}0, count(*) FROM wide GROUP BY ALL) GROUP BY ALL)""", entity),
        "monthly_pivot": _wide_q(f"SELECT {k}observation_month, unemployment_rate, cpi_index, fed_funds_rate, consumer_sentiment "
                                 "FROM by_month", entity),
        "gdp_forward_fill": _wide_q(O.carried_gdp(entity), entity),
        "month_end_daily": _wide_q(
            f"SELECT {k}{O._month('observation_date')} AS observation_month, "
            "arg_max_null(value, observation_date) AS treasury_spread_10y2y "
            "FROM obs WHERE series_id = 'T10Y2Y' GROUP BY ALL", entity),
        "monthly_wide": _wide_q("SELECT * FROM wide", entity),
        "mom_yoy_changes": _metric_q(_CHANGES, entity),
        "pct_changes": _metric_q(_PCTS, entity),
        "rolling_avgs": _metric_q(_ROLLS, entity),
        "rolling_low": _metric_q(("unemployment_rate", "unemployment_rate_12m_low"), entity),
        "derived_metrics": O.wide_ctes(entity) + O.metrics_cte(entity) + "\nSELECT * FROM metrics",
        "recession_signals": _signal_q(SIGNAL_MODEL_COLUMNS, entity),
        "signal_flags": _signal_q(("sahm_rule_value", *SIGNAL_FLAGS), entity),
        "signal_count_level": _signal_q(("recession_signal_count", "recession_risk_level"), entity),
        "economic_dashboard": O.dashboard_sql(entity),
        "indicator_summary": O.summary_sql(entity),
        "observation_counts": _observation_counts(entity),
        "completeness_24m": _completeness(entity),
        "kpi_table": _kpi(entity),
        "current_risk": _current_risk(entity),
        "signal_status": _signal_status(entity),
        "month_bounds": _month_bounds(entity),
    }


def _dq_suite() -> str:
    levels = "('LOW', 'MODERATE', 'ELEVATED', 'HIGH')"
    tests = [
        ("observation_id_unique", "staging", "SELECT observation_id FROM staged WHERE observation_id IS NOT NULL "
                                             "GROUP BY observation_id HAVING count(*) > 1"),
        ("observation_id_not_null", "staging", "SELECT 1 FROM staged WHERE observation_id IS NULL"),
        ("series_id_accepted", "staging", f"SELECT 1 FROM staged WHERE series_id NOT IN ({_IDS})"),
        ("series_id_not_null", "staging", "SELECT 1 FROM staged WHERE series_id IS NULL"),
        ("observation_date_not_null", "staging", "SELECT 1 FROM staged WHERE observation_date IS NULL"),
        ("value_not_null", "staging", "SELECT 1 FROM staged WHERE value IS NULL"),
        ("wide_month_unique", "intermediate", "SELECT observation_month FROM wide "
                                              "GROUP BY observation_month HAVING count(*) > 1"),
        ("wide_month_not_null", "intermediate", "SELECT 1 FROM wide WHERE observation_month IS NULL"),
        ("changes_month_unique", "intermediate", "SELECT observation_month FROM metrics "
                                                 "GROUP BY observation_month HAVING count(*) > 1"),
        ("changes_month_not_null", "intermediate", "SELECT 1 FROM metrics WHERE observation_month IS NULL"),
        ("signals_month_not_null", "intermediate", "SELECT 1 FROM signals WHERE observation_month IS NULL"),
        ("dashboard_month_not_null", "marts", "SELECT 1 FROM dash WHERE observation_month IS NULL"),
        ("metadata_series_id_unique", "staging", "SELECT series_id FROM meta WHERE series_id IS NOT NULL "
                                                 "GROUP BY series_id HAVING count(*) > 1"),
        ("metadata_series_id_not_null", "staging", "SELECT 1 FROM meta WHERE series_id IS NULL"),
        ("metadata_title_not_null", "staging", "SELECT 1 FROM meta WHERE title IS NULL"),
        ("signals_month_unique", "intermediate", "SELECT observation_month FROM signals "
                                                 "GROUP BY observation_month HAVING count(*) > 1"),
        ("signals_level_accepted", "intermediate", f"SELECT 1 FROM signals WHERE recession_risk_level NOT IN {levels}"),
        ("sahm_rule_value_in_range", "intermediate", "SELECT 1 FROM signals WHERE sahm_rule_value IS NOT NULL "
                                                     "AND (sahm_rule_value < 0 OR sahm_rule_value > 10)"),
        ("staging_to_intermediate_row_count", "intermediate",
         "SELECT 1 FROM (SELECT (SELECT count(DISTINCT observation_date) FROM staged WHERE series_id = 'UNRATE') AS e, "
         "(SELECT count(*) FROM wide) AS a) WHERE a = 0 OR a > e * 1.1 OR a < e * 0.5"),
        ("dashboard_month_unique", "marts", "SELECT observation_month FROM dash "
                                            "GROUP BY observation_month HAVING count(*) > 1"),
        ("dashboard_level_accepted", "marts", f"SELECT 1 FROM dash WHERE recession_risk_level NOT IN {levels}"),
        ("summary_latest_not_null", "marts", "SELECT 1 FROM summ WHERE latest_month IS NULL"),
        ("summary_level_accepted", "marts", f"SELECT 1 FROM summ WHERE current_risk_level NOT IN {levels}"),
        ("observations_freshness", "raw",
         f"SELECT 1 FROM (SELECT (epoch_us(TIMESTAMP '{FRESHNESS_NOW}') - epoch_us(max(ingested_at))) / 3.6e9 AS h "
         "FROM raw) WHERE h IS NULL OR h > 48"),
    ]
    parts = [f"SELECT '{name}' AS test_name, '{layer}' AS layer, "
             f"'{'warn' if layer == 'raw' else 'error'}' AS severity, (SELECT count(*) FROM ({q})) AS n_failed"
             for name, layer, q in tests]
    staged = """,
    staged AS (SELECT md5(concat_ws('-', coalesce(CAST(series_id AS VARCHAR), '_null_'),
                                         coalesce(CAST(observation_date AS VARCHAR), '_null_'))) AS observation_id,
                      series_id, observation_date, value FROM obs WHERE value IS NOT NULL),
    summ AS (""" + O.summary_sql().replace("\n", "\n  ") + "),"
    meta = _META + """,
    meta AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ingested_at DESC, o_orderkey DESC) = 1),"""
    return (O.dash_ctes() + staged + meta + O.raw_revisions_cte() + "\n" + "\nUNION ALL ".join(parts))


def _contract(rev: str, keep: str) -> str:
    return f"""{rev}
SELECT series_id, observation_date, value, coalesce(ingested_at, TIMESTAMP '{NOW}') AS ingested_at, source_url
FROM raw WHERE {keep}"""


def ORACLE() -> dict[str, str]:
    rev = f"WITH {O.raw_revisions_cte()}"
    staged = f"WITH {O.staged_revisions_cte()}"
    split_rows = """
    r AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS observation_date, value, ts AS ingested_at,
                 'events/' || CAST(event_id AS VARCHAR) AS source_url, event_id FROM events)"""

    def pick(cond):
        return (f"(SELECT * EXCLUDE (rn, event_id) FROM (SELECT *, row_number() OVER (PARTITION BY series_id, "
                f"observation_date ORDER BY ingested_at DESC, event_id DESC) AS rn FROM r WHERE {cond}) WHERE rn = 1)")

    out = {
        "dedup_latest_observation": staged + "\nSELECT * FROM staged",
        "dedup_hot_keys": """WITH raw AS (
      SELECT l_returnflag AS series_id, CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE) AS observation_date,
             CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice END AS value, l_shipdate AS ingested_at,
             'lineitem/' || CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) AS source_url,
             l_orderkey, l_linenumber
      FROM lineitem)
SELECT md5(concat_ws('-', coalesce(CAST(series_id AS VARCHAR), '_null_'),
                          coalesce(CAST(observation_date AS VARCHAR), '_null_'))) AS observation_id,
       series_id, observation_date, value, ingested_at, source_url
FROM (SELECT *, row_number() OVER (PARTITION BY series_id, observation_date
                                    ORDER BY ingested_at DESC NULLS FIRST, l_orderkey DESC, l_linenumber DESC) AS rn
      FROM raw)
WHERE rn = 1 AND value IS NOT NULL""",
        "dedup_latest_metadata": f"""WITH {_META}
SELECT series_id, title AS series_title, frequency AS data_frequency, units AS measurement_units,
       seasonal_adj AS seasonal_adjustment, last_updated AS source_last_updated, ingested_at
FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ingested_at DESC NULLS FIRST, o_orderkey DESC) AS rn
      FROM m) WHERE rn = 1""",
        "clean_missing_marker": f"WITH {O.landing_text_cte()}\n"
                                "SELECT event_id, series_id, observation_date, raw_value, value, is_bad FROM parsed",
        "series_watermark": f"""{rev}, {_DIM},
    last AS (SELECT series_id, max(observation_date) AS l FROM raw GROUP BY series_id)
SELECT d.series_id, coalesce(last.l, DATE '{DEFAULT_START_DATE}') AS start_date
FROM dim d LEFT JOIN last ON d.series_id = last.series_id""",
        "upsert_result": f"""WITH {split_rows},
    tgt AS {pick(f"ingested_at < TIMESTAMP '{fx.REV_TARGET_BEFORE}'")},
    bat AS {pick(f"ingested_at >= TIMESTAMP '{fx.REV_BATCH_FROM}'")}
SELECT t.* FROM tgt t
WHERE NOT EXISTS (SELECT 1 FROM bat b WHERE b.series_id = t.series_id AND b.observation_date = t.observation_date)
UNION ALL
SELECT series_id, observation_date, value, TIMESTAMP '{NOW}' AS ingested_at, source_url FROM bat""",
        "upsert_recent_batch": f"""WITH {split_rows},
    tgt AS {pick(f"ingested_at < TIMESTAMP '{fx.REV_RECENT_TARGET_BEFORE}'")},
    bat AS {pick(f"ingested_at >= TIMESTAMP '{fx.REV_RECENT_BATCH_FROM}'")}
SELECT t.* FROM tgt t
WHERE NOT EXISTS (SELECT 1 FROM bat b WHERE b.series_id = t.series_id AND b.observation_date = t.observation_date)
UNION ALL
SELECT series_id, observation_date, value, TIMESTAMP '{NOW}' AS ingested_at, source_url FROM bat""",
        "replace_by_key_result": f"""WITH {_META},
    t AS (SELECT *, ingested_at >= TIMESTAMP '{META_BATCH_FROM}' AND series_id < '{META_BATCH_BELOW}' AS fresh FROM m)
SELECT * EXCLUDE (o_orderkey, fresh) FROM t WHERE NOT fresh AND series_id NOT IN (SELECT series_id FROM t WHERE fresh)
UNION ALL
SELECT * EXCLUDE (o_orderkey, fresh) FROM t WHERE fresh
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ingested_at DESC, o_orderkey DESC) = 1""",
        "merged_rows": f"""{rev}
SELECT count(DISTINCT (series_id, observation_date)) AS rows_merged FROM raw""",
        "contract_rows": _contract(rev, f"length(source_url) <= {CONTRACT_URL_LENGTH} AND length(series_id) <= 20"),
        "contract_violations": _contract(rev, f"length(source_url) > {CONTRACT_URL_LENGTH} OR length(series_id) > 20"),
        "landing_rows": f"""WITH {O.landing_text_cte()}
SELECT event_id, CASE WHEN event_id % 29 = 0 THEN 'own.' || series_id ELSE series_id END AS series_id, observation_date,
       CASE WHEN event_id % 23 <> 0 THEN raw_value END AS raw_value
FROM land WHERE event_id % 13 <> 0 AND event_id % 17 <> 0 AND event_id % 19 <> 0""",
        "landing_malformed": f"""WITH {O.landing_text_cte()}
SELECT event_id, series_id, CASE WHEN event_id % 17 = 0 THEN 400 END::INT AS error_code,
       CASE WHEN event_id % 17 = 0 THEN 'no series ' || series_id END AS error_message
FROM land WHERE event_id % 17 = 0 OR event_id % 19 = 0""",
        "load_batch": f"""{_FAILED}
SELECT series_id, observation_date, value, '{SOURCE_URL_BASE}' || series_id AS source_url
FROM parsed WHERE observation_date >= DATE '{DEFAULT_START_DATE}' AND series_id NOT IN (SELECT series_id FROM failed)""",
        "malformed_split": f"""{_FAILED}
SELECT event_id, series_id, observation_date, raw_value FROM land
WHERE series_id IN (SELECT series_id FROM failed)""",
        "load_log": _LOG + "\nSELECT * FROM logq",
        "run_summary": _LOG + """
SELECT count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded, count(*) FILTER (WHERE status = 'FAILED') AS failed,
       count(*) AS total FROM logq""",
        "raw_row_counts": """SELECT 'OBSERVATIONS' AS table_name, count(*) AS row_count FROM events
UNION ALL SELECT 'SERIES_METADATA', count(*) FROM orders
UNION ALL SELECT 'INGESTION_LOG', count(*) FROM events""",
        "month_spine": """SELECT entity, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS observation_month
FROM (SELECT o_orderpriority AS entity,
             min(CAST(date_trunc('month', o_orderdate) AS TIMESTAMP)) AS lo,
             max(CAST(date_trunc('month', o_orderdate) AS TIMESTAMP)) AS hi
      FROM orders GROUP BY o_orderpriority)""",
        "supplier_economic_dashboard": O.dashboard_sql("supplier"),
        "contract_upgrade_rows": _two_contracts("length(unit) <= {n}"),
        "contract_upgrade_violations": _two_contracts("length(unit) > {n}"),
        "dashboard_month_range": O.dash_ctes("supplier") + f"""
SELECT * REPLACE (CAST(observation_month AS TIMESTAMP) AS observation_month) FROM dash
WHERE observation_month BETWEEN DATE '{fx.SERVE_FROM}' AND DATE '{fx.SERVE_TO}'""",
        "incremental_dashboard": O.revised_dashboard_sql(),
        "summary_from_states": O.summary_sql("supplier", obs_cte=O.revised_panel_cte()),
        "reconcile_from_bitmaps": O.wide_ctes("supplier", obs_cte=O.revised_panel_cte()) + """
SELECT entity, staging_months, pivoted_rows, pivoted_rows - staging_months AS row_difference,
       pivoted_rows = 0 OR pivoted_rows > staging_months * 1.1 OR pivoted_rows < staging_months * 0.5 AS failed
FROM (SELECT entity, sum(a)::BIGINT AS staging_months, sum(b)::BIGINT AS pivoted_rows FROM (
        SELECT entity, count(DISTINCT observation_date) AS a, 0 AS b FROM obs WHERE series_id = 'UNRATE' GROUP BY ALL
        UNION ALL SELECT entity, 0, count(*) FROM wide GROUP BY ALL) GROUP BY ALL)""",
        "hot_rolling": f"""SELECT l_returnflag, l_orderkey, l_linenumber, l_shipdate, cents,
       cents - lag(cents, 1) OVER w AS change_1, cents - lag(cents, 12) OVER w AS change_12,
       avg(cents) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS avg_3,
       min(cents) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS low_12,
       {O.round2("(cents - lag(cents, 3) OVER w) / nullif(CAST(lag(cents, 3) OVER w AS DOUBLE), 0) * 100")} AS growth_3
FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
WINDOW w AS (PARTITION BY l_returnflag ORDER BY {", ".join(fx.HOT_ORDER)})""",
        "hot_forward_fill": f"""SELECT l_returnflag, l_orderkey, l_linenumber, l_shipdate, cents,
       last_value(CASE WHEN l_discount = 0 THEN cents END IGNORE NULLS) OVER (PARTITION BY l_returnflag ORDER BY {", ".join(fx.HOT_ORDER)}
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS full_price
FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)""",
        "asof_daily_quarterly": f"""WITH {O.econ_obs_cte("priority")},
    r AS (SELECT entity, observation_date AS reported, max(value + CASE WHEN quarter(observation_date) = {fx.ASOF_TWICE_QUARTER} THEN 1 ELSE 0 END) AS level
          FROM obs WHERE series_id = 'GDP' AND year(observation_date) <> {fx.ASOF_GAP_YEAR} GROUP BY ALL)
SELECT d.entity, d.observation_date, d.value, CASE WHEN near THEN reported END AS reported, CASE WHEN near THEN level END AS gdp
FROM (SELECT d.*, r.reported, r.level, d.observation_date - r.reported <= {fx.ASOF_DAYS} AS near
      FROM (SELECT * FROM obs WHERE series_id = 'T10Y2Y') d ASOF LEFT JOIN r ON d.entity = r.entity AND d.observation_date >= r.reported) d""",
        "asof_events": """WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'),
    r AS (SELECT user_id, ts AS at, max(event_id) AS purchase FROM events WHERE event_type = 'purchase' GROUP BY ALL),
    b AS (SELECT l.*, r.at AS b_at, r.purchase AS b FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.at),
    a AS (SELECT b.*, r.at AS a_at, r.purchase AS a FROM b ASOF LEFT JOIN r ON b.user_id = r.user_id AND b.ts <= r.at)
SELECT event_id, user_id, ts, b AS last_purchase, CASE WHEN a_at - ts <= INTERVAL 5 DAY THEN a END AS next_purchase,
       CASE WHEN b_at IS NOT NULL AND ts - b_at <= INTERVAL 2 DAY AND (a_at IS NULL OR ts - b_at <= a_at - ts) THEN b
            WHEN a_at IS NOT NULL AND a_at - ts <= INTERVAL 2 DAY THEN a END AS nearest_purchase
FROM a""",
        "dq_unique": f"""{rev}
SELECT series_id, observation_date, count(*) AS n_rows FROM raw
WHERE series_id IS NOT NULL AND observation_date IS NOT NULL
GROUP BY series_id, observation_date HAVING count(*) > 1""",
        "dq_not_null": f"{rev}\nSELECT series_id, observation_date, source_url FROM raw WHERE value IS NULL",
        "dq_accepted_values": f"""{staged}
SELECT series_id, count(*) AS n_rows FROM staged WHERE series_id NOT IN ({_IDS}) GROUP BY series_id""",
        "dq_range": O.wide_ctes() + O.metrics_cte() + O.signals_cte() + """
SELECT observation_month, sahm_rule_value FROM signals
WHERE sahm_rule_value IS NOT NULL AND (sahm_rule_value < 0 OR sahm_rule_value > 10)""",
        "dq_freshness": f"""{rev},
    f AS (SELECT max(ingested_at) AS max_loaded_at,
                 (epoch_us(TIMESTAMP '{FRESHNESS_NOW}') - epoch_us(max(ingested_at))) / 3.6e9 AS age_hours FROM raw)
SELECT *, CASE WHEN age_hours IS NULL THEN 'ERROR' WHEN age_hours > 96 THEN 'ERROR'
               WHEN age_hours > 48 THEN 'WARN' ELSE 'PASS' END AS status FROM f""",
        "dq_report": O.dash_ctes() + """,
    c AS (SELECT count(*) FILTER (WHERE observation_month IS NULL) AS month_not_null,
                 count(*) FILTER (WHERE coalesce(NOT (recession_risk_level IN ('LOW', 'MODERATE', 'ELEVATED', 'HIGH')), false)) AS risk_level_accepted,
                 count(*) FILTER (WHERE sahm_rule_value IS NOT NULL AND (sahm_rule_value < 0 OR sahm_rule_value > 10)) AS sahm_in_range,
                 count(*) FILTER (WHERE unemployment_rate IS NULL) AS unemployment_not_null
          FROM dash)
SELECT * FROM (UNPIVOT c ON month_not_null, risk_level_accepted, sahm_in_range, unemployment_not_null
               INTO NAME check_name VALUE n_failed)""",
        "recent_runs_top20": """SELECT CAST(user_id % 20 AS VARCHAR) AS run_id, event_type AS series_id,
       CAST(event_id % 7 AS INTEGER) AS records_fetched,
       CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       ts AS started_at, ts AS completed_at,
       CASE WHEN event_type = 'error' THEN 'load failed' END AS error_message, event_id
FROM events ORDER BY ts DESC, event_id DESC LIMIT 20""",
        "range_series": _dash_q(f"SELECT observation_month, {', '.join(OVERVIEW_COLUMNS)} FROM dash "
                                f"WHERE observation_month >= DATE '{RANGE_FROM}'"),
        "sahm_history": _dash_q(f"SELECT observation_month, sahm_rule_value FROM dash "
                                f"WHERE observation_month >= DATE '{RANGE_FROM}' AND sahm_rule_value IS NOT NULL"),
        "gdp_history": _dash_q(f"SELECT observation_month, gdp, gdp_qoq_growth_rate FROM dash "
                               f"WHERE observation_month >= DATE '{RANGE_FROM}' AND gdp_qoq_growth_rate IS NOT NULL"),
    }
    from ..operators.serving import CHART_DROP_NULL, CHART_SERIES
    from .catalog import CHARTS

    for c in CHARTS:
        cols = CHART_SERIES[c]
        nn = "".join(f" AND {x} IS NOT NULL" for x in CHART_DROP_NULL.get(c, ()))
        out[f"chart_{c}"] = _dash_q(f"SELECT observation_month, {', '.join(cols)} FROM dash "
                                    f"WHERE observation_month >= DATE '{RANGE_FROM}'{nn}")
    out["dq_suite"] = _dq_suite()
    out["upsert_colocated"] = out["upsert_result"]  # the same merge over another layout
    out.update(_panelable())
    out.update({f"panel_{k}": v for k, v in _panelable("priority").items()})
    return out
