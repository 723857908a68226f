"""Adapters from the driver's tables to the engine's input shapes.

Every value is an integer sum divided once, so Spark and DuckDB see identical
doubles. Each source table is scanned and shuffled once, by (entity, day) or
(entity, month); coarser grains are added up from those few rows. Only the
tables that feed the asked series are read.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import month_of

ENTITY = "entity"

# Fixed values of the FX-ECON fixture.
SPINE_START = "1996-01-01"
AS_OF = "2001-12-31"
FIXTURE_THRESHOLDS = dict(sahm_rule=4.0, high_inflation=2.0, low_sentiment=25.3, fed_tightening=0.1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one of the driver's read-only tables.

    The relation (file listing and footer schema) is resolved once per
    session and path, and kept on the session object, so a new session never
    sees another session's frames. Every query still plans its own scan with
    its own pruned columns and pushed filters.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    cache = spark.__dict__.setdefault("_tidemark_tables", {})
    if path not in cache:
        cache[path] = spark.read.parquet(path)
    return cache[path]


def _cents(c: Column) -> Column:
    """Amount in whole cents. The inputs carry at most two decimals, so x*100 is
    within 1e-6 of an integer and never on a .5 tie: rint is then exactly
    round-half-up, without the per-row BigDecimal of round()."""
    return F.rint(c * F.lit(100)).cast("bigint")


LINEITEM_SERIES = ("CPIAUCSL", "FEDFUNDS", "UMCSENT", "T10Y2Y")
ORDERS_SERIES = ("UNRATE", "GDP")


def _series(fine: DataFrame, keys, grains: dict[str, Column], rows: dict[str, dict[str, Column]]) -> DataFrame:
    """Long (keys, series_id, observation_date, value) rows of an aggregate by (keys, finest grain).

    ``grains``: name -> date expression over ``fine``; ``rows``: grain -> {series: value over its counts and sums}.
    Grains beyond the first asked for are added up from the few rows of ``fine`` by
    GROUPING SETS, so the table below is scanned and shuffled once for all of them."""
    sums = [c for c in fine.columns if c == "n" or c.startswith("s_")]
    used = [g for g in grains if rows.get(g)]
    x = fine.select(*keys, *[grains[g].alias(g) for g in used], *sums)
    added = [F.sum(c).alias(c) for c in sums]
    if len(used) > 1:
        x = x.groupingSets([[*keys, g] for g in used], *keys, *used).agg(*added, *[F.grouping(g).alias(f"_g_{g}") for g in used])
    else:
        x = x.groupBy(*keys, *used).agg(*added, *[F.lit(0).alias(f"_g_{g}") for g in used])
    one = None
    for g in used:
        items = F.array(*[F.struct(F.lit(sid).alias("series_id"), F.col(g).alias("observation_date"), v.alias("value"))
                          for sid, v in rows[g].items()])
        of_g = F.col(f"_g_{g}") == 0
        one = F.when(of_g, items) if one is None else one.when(of_g, items)
    return x.select(*keys, F.inline(one))


def _placed_series(fine: DataFrame, keys, grains: dict[str, Column], rows: dict[str, dict[str, Column]]) -> DataFrame:
    """``_series`` of two grains, finer first, of rows that lie together by (keys, coarser grain) already.

    The coarser sums come from a window over the finer rows and stand with the first of them: no second shuffle."""
    (lo, lo_at), (hi, hi_at) = grains.items()
    sums = [c for c in fine.columns if c == "n" or c.startswith("s_")]
    w = Window.partitionBy(*keys, hi).orderBy(lo)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def items(g: str) -> Column:
        return F.array(*[F.struct(F.lit(sid).alias("series_id"), F.col(g).alias("observation_date"), v.alias("value"))
                         for sid, v in rows[g].items()])

    x = fine.select(*keys, lo_at.alias(lo), hi_at.alias(hi), *sums)
    x = x.select("*", F.row_number().over(w).alias("_rank"), *[F.sum(c).over(whole).alias(f"_all_{c}") for c in sums])
    x = x.select(*keys, hi, "_rank", items(lo).alias("_fine"), *[F.col(f"_all_{c}").alias(c) for c in sums])
    return x.select(*keys, F.inline(F.when(F.col("_rank") == 1, F.concat("_fine", items(hi))).otherwise(F.col("_fine"))))


def econ_observations(spark: SparkSession, sf_dir: str, entity: str | None = None, series=None, of: Column | None = None) -> DataFrame:
    """Six long-format series (FX-ECON, or FX-PANEL with entity='priority',
    or FX-PANEL-L with entity='supplier', whose order series weigh each order by its lines).

    ``series``: only these ids (default: all); tables that feed none of them are not read.
    ``of``: a condition on the entity; lines of other suppliers are left out before they are shuffled.
    Columns: [entity,] series_id, observation_date DATE, value DOUBLE.
    """
    keys = [ENTITY] if entity else []
    wanted = [s for s in (*LINEITEM_SERIES, *ORDERS_SERIES) if series is None or s in series]
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    if entity == "priority":
        od = o.select("o_orderkey", F.col("o_orderpriority").alias(ENTITY))
        li = li.join(od, li.l_orderkey == od.o_orderkey).drop("o_orderkey")
        o = o.withColumn(ENTITY, F.col("o_orderpriority"))
    elif entity == "supplier":
        li = li.withColumn(ENTITY, F.col("l_suppkey"))
        li = li if of is None else li.where(of)
        lines = li.select("l_orderkey", ENTITY)
        o = o.join(lines, o.o_orderkey == lines.l_orderkey).drop("l_orderkey")
    elif entity is not None:
        raise ValueError(f"unknown entity {entity!r}")
    n, parts = F.col("n").cast("double"), []

    def asked(values: dict[str, Column]) -> dict[str, Column]:
        return {sid: v for sid, v in values.items() if sid in wanted}

    if any(s in wanted for s in LINEITEM_SERIES):
        rows = {"d": asked({"T10Y2Y": F.col("s_spread").cast("double") / n}),
                "m": asked({"CPIAUCSL": F.col("s_price").cast("double") / n / F.lit(100),
                            "FEDFUNDS": F.col("s_disc").cast("double") / n, "UMCSENT": F.col("s_qty").cast("double") / n})}
        amounts = {"s_price": _cents(F.col("l_extendedprice")), "s_disc": _cents(F.col("l_discount")),
                   "s_qty": F.col("l_quantity").cast("bigint"), "s_spread": _cents(F.col("l_tax") - F.col("l_discount"))}
        lines, grain = li.select(*keys, F.to_date("l_shipdate").alias("day"), *[v.alias(c) for c, v in amounts.items()]), ["day"]
        placed = entity == "supplier" and all(rows.values())
        if placed:  # a supplier has about a line a day: adding up before the shuffle saves nothing, so it is the only one
            lines, grain = lines.withColumn("month", month_of("day")).repartition(*keys, "month"), ["month", "day"]
        day = lines.groupBy(*keys, *grain).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in amounts])
        parts.append(_placed_series(day, keys, {"d": F.col("day"), "m": F.col("month")}, rows) if placed else
                     _series(day, keys, {"d": F.col("day"), "m": month_of("day")}, rows))
    if any(s in wanted for s in ORDERS_SERIES):
        month = o.groupBy(*keys, month_of("o_orderdate").alias("month")).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(F.col("o_orderstatus") == "F", F.lit(10000)).otherwise(F.lit(0)).cast("bigint")).alias("s_f"),
            F.sum(_cents(F.col("o_totalprice"))).alias("s_price"))
        parts.append(_series(month, keys, {"m": F.col("month"), "q": F.trunc("month", "quarter")}, {
            "m": asked({"UNRATE": F.col("s_f").cast("double") / n / F.lit(100)}),
            "q": asked({"GDP": F.col("s_price").cast("double") / F.lit(1e8)})}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def revised_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-REV: raw observations with reloads (several loads per key).

    Extra column ``event_id`` is the deterministic tie-break (DESC).
    """
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("series_id"),
        F.to_date("ts").alias("observation_date"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("ts")).alias("ingested_at"),
        F.concat(F.lit("events/"), F.col("event_id").cast("string")).alias("source_url"),
        "event_id")


REV_TARGET_BEFORE = "2024-01-16"   # target: loads with ts < this
REV_BATCH_FROM = "2024-01-15"      # batch: loads with ts >= this (one day overlaps)


REV_RECENT_TARGET_BEFORE = "2024-01-29"   # 10 % batch: the last three days of loads,
REV_RECENT_BATCH_FROM = "2024-01-28"      # one of them overlapping the target


def revision_split(spark: SparkSession, sf_dir: str, target_before: str = REV_TARGET_BEFORE,
                   batch_from: str = REV_BATCH_FROM) -> tuple[DataFrame, DataFrame]:
    """FX-REV split into an existing target and an incoming batch, each deduped
    to one row per key (latest ts, then event_id), ingested_at = ts."""
    from ..operators.dedup import latest_per_key

    e = table(spark, sf_dir, "events")
    rows = e.select(
        F.col("event_type").alias("series_id"), F.to_date("ts").alias("observation_date"),
        F.col("value"), F.col("ts").alias("ingested_at"),
        F.concat(F.lit("events/"), F.col("event_id").cast("string")).alias("source_url"),
        "event_id")
    order = [F.col("ingested_at").desc(), F.col("event_id").desc()]
    keys = ["series_id", "observation_date"]
    target = latest_per_key(rows.filter(F.col("ingested_at") < F.lit(target_before).cast("timestamp_ntz")), keys, order)
    batch = latest_per_key(rows.filter(F.col("ingested_at") >= F.lit(batch_from).cast("timestamp_ntz")), keys, order)
    return target.drop("event_id"), batch.drop("event_id")


def hot_key_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loads with hot keys, from lineitem: three series (return flags, each
    holding a third of all rows), one key per ship month, thousands of loads
    per key. A zero discount makes the load's value NULL (a retraction when it
    is the latest). Tie-break columns: l_orderkey, l_linenumber (DESC)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("series_id"),
        F.trunc(F.to_date("l_shipdate"), "MM").alias("observation_date"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice")).alias("value"),
        F.col("l_shipdate").alias("ingested_at"),
        F.concat_ws("/", F.lit("lineitem"), F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("source_url"),
        "l_orderkey", "l_linenumber")


def metadata_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-META: metadata reloads from orders; tie-break column ``o_orderkey`` (DESC)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("series_id"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_orderstatus").alias("frequency"),
        F.lit(None).cast("string").alias("units"),
        F.lit(None).cast("string").alias("seasonal_adj"),
        F.col("o_orderdate").alias("last_updated"),
        F.col("o_orderdate").alias("ingested_at"),
        "o_orderkey")


def landing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-TEXT: landed (series_id, observation_date, raw text value) rows."""
    e = table(spark, sf_dir, "events")
    raw = (F.when(F.col("event_id") % 10 == 0, F.lit("."))
            .when((F.col("event_type") == "error") & (F.col("event_id") % 37 == 0), F.lit("bad"))
            .otherwise(F.get_json_object("props", "$.k")))
    return e.select("event_id", F.col("event_type").alias("series_id"),
                    F.to_date("ts").alias("observation_date"), raw.alias("raw_value"))


def landing_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-TEXT as payload documents, one per event: event_id, series_id, payload.

    Every 13th document has no observations, every 17th lacks the key and states
    an error, every 19th is no JSON, every 23rd has a NULL value and every 29th
    names its series itself."""
    land = landing_text(spark, sf_dir)
    i, obs = F.col("event_id"), F.struct(
        F.date_format("observation_date", "yyyy-MM-dd").alias("date"),
        F.when(F.col("event_id") % 23 != 0, F.col("raw_value")).alias("value"))
    doc = F.to_json(F.struct(F.when(i % 29 == 0, F.concat(F.lit("own."), F.col("series_id"))).alias("series_id"),
                             F.when(i % 13 == 0, F.filter(F.array(obs), lambda x: F.lit(False))).otherwise(F.array(obs)).alias("observations")))
    error = F.to_json(F.struct(F.lit(400).alias("error_code"), F.concat(F.lit("no series "), F.col("series_id")).alias("error_message")))
    return land.select("event_id", "series_id", F.when(i % 17 == 0, error).when(i % 19 == 0, F.lit("<html>")).otherwise(doc).alias("payload"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-LOG: an ingestion log with many runs; tie-break column ``event_id``."""
    e = table(spark, sf_dir, "events")
    failed = F.col("event_type") == "error"
    return e.select(
        (F.col("user_id") % 20).cast("string").alias("run_id"),
        F.col("event_type").alias("series_id"),
        (F.col("event_id") % 7).cast("int").alias("records_fetched"),
        F.when(failed, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
        F.col("ts").alias("started_at"),
        F.col("ts").alias("completed_at"),
        F.when(failed, F.lit("load failed")).alias("error_message"),
        "event_id")


# Fixed values of the panel revision: every tenth supplier, late months and revised months.
PANEL_REVISED_EVERY, PANEL_LATE_FROM, PANEL_REVISED_FROM = 10, "2001-07-01", "2001-01-01"


def panel_revision(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """FX-PANEL-L split into a first load and a batch of every tenth supplier.

    The batch revises values from PANEL_REVISED_FROM on (times 1.5), brings the rows from
    PANEL_LATE_FROM on that the first load lacks, and retracts sentiment in March."""
    some = F.col(ENTITY) % PANEL_REVISED_EVERY == 0
    obs, of_some = econ_observations(spark, sf_dir, "supplier"), econ_observations(spark, sf_dir, "supplier", of=some)
    day = F.col("observation_date")
    first = obs.where(~(some & (day >= F.lit(PANEL_LATE_FROM).cast("date"))))
    gone = (F.col("series_id") == "UMCSENT") & (F.month(day) == 3)
    batch = of_some.where(some & (day >= F.lit(PANEL_REVISED_FROM).cast("date"))).withColumn(
        "value", F.when(~gone, F.col("value") * 1.5))
    text = F.col(ENTITY).cast("string")
    return first.withColumn(ENTITY, text), batch.withColumn(ENTITY, text)


HOT_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents", "l_quantity", "l_discount", "l_tax")


def hot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines keyed by return flag (each key a third of all rows), in the order HOT_ORDER; amounts in whole cents."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_returnflag", *[c for c in HOT_ORDER if c != "cents"], _cents(F.col("l_extendedprice")).alias("cents"))


# Fixed values of the as-of fixture: quarters that are missing, quarters with a second row, tolerance in days.
ASOF_GAP_YEAR, ASOF_TWICE_QUARTER, ASOF_DAYS = 1999, 2, 120


def quarterly_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GDP per entity (priority) as reports: entity, reported, revision, level; a year is missing, second quarters come twice."""
    gdp = econ_observations(spark, sf_dir, "priority", ["GDP"]).select(
        ENTITY, F.col("observation_date").alias("reported"), F.col("value").alias("level"))
    twice = F.explode(F.when(F.quarter("reported") == ASOF_TWICE_QUARTER, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (gdp.where(F.year("reported") != ASOF_GAP_YEAR).select("*", twice.alias("revision"))
            .withColumn("level", F.col("level") + F.col("revision")))


SERVE_FROM, SERVE_TO = "1998-03-01", "1998-08-01"   # months that the serving query asks for

# Fixed values of the contract fixture: series loaded anew under the later contract, its text limit.
CONTRACT_NEW_SERIES, CONTRACT_UNIT_LENGTH = ("click", "view"), 8


def contract_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events under two contracts: whole numbers without a unit, then (two series) numbers with one, some too long."""
    e = table(spark, sf_dir, "events")
    key = [F.col("event_type").alias("series_id"), F.col("event_id"), F.to_date("ts").alias("observation_date")]
    first = e.select(*key, F.floor("value").cast("int").alias("value"))
    unit = F.when(F.col("event_id") % 7 == 0, F.lit("far too long")).otherwise(F.lit("points"))
    second = e.where(F.col("event_type").isin(*CONTRACT_NEW_SERIES)).select(*key, F.col("value"), unit.alias("unit"))
    return first, second
