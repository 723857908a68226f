"""The month layers brought up to date for what a batch touches.

One stored row per (entity, month) holds the month's reported values (before the
forward fill) and, where a monthly series has data, the dashboard columns. A
batch of observations changes some (entity, month) cells, and through windows
later months of the same entities:

* ``change_set``: per entity and series the first month that the batch touches;
* cells: their values are aggregated again from the observations;
* halo: the 12 rows before an entity's first change, which lags and rolling
  frames reach back to (both are positional, so rows and not calendar months);
* carried state: a halo row's filled value is all that the forward fill needs of
  the months before it.

From the first change on, an entity's rows go through the same operators as in a
full run; all other rows are kept as they are.

SURVEY §2: S14, S19, M3-M6 (incremental form).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import month_of
from ..schemas import DEFAULT_SERIES, FFILL, MONTH, SeriesSpec, Thresholds
from . import align
from .marts import DASHBOARD_COLUMNS, economic_dashboard
from .metrics import derived_metrics

#: Rows that the longest lag (12) and rolling frame (12 with the current row) reach back.
HALO = 12
COUNT = "_n_monthly"
#: The monthly series whose dates the month rows are reconciled with.
RECONCILED = "UNRATE"


def reported(column: str) -> str:
    """Name of a series' value before the forward fill."""
    return f"_reported_{column}"


def change_set(batch: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per entity and series the first month that the batch touches: [keys,] series_id, since."""
    return batch.groupBy(*keys, "series_id").agg(F.min(month_of("observation_date")).alias("since"))


def month_values(obs: DataFrame, specs: Sequence[SeriesSpec] = DEFAULT_SERIES, keys: Sequence[str] = ()) -> DataFrame:
    """Reported values per (entity, month) of the observations that are not retracted, and the dates of RECONCILED."""
    return align.monthly_values(obs.where("value is not null"), specs, keys, RECONCILED).withColumnsRenamed(
        {s.column: reported(s.column) for s in specs})


def with_dashboard(values: DataFrame, specs: Sequence[SeriesSpec], start, as_of, t: Thresholds,
                   keys: Sequence[str] = (), fresh: str | None = None) -> DataFrame:
    """``values`` with the dashboard columns (NULL in months without a monthly series).

    ``fresh``: a boolean column; rows without it (a halo) take part in the windows
    and are left out of the result."""
    own = [c for c in values.columns if c != MONTH]
    filled = align.fill_forward(values.withColumns({s.column: F.col(reported(s.column)) for s in specs}),
                                [s.column for s in specs if s.align == FFILL], keys, start, as_of)
    known = economic_dashboard(derived_metrics(filled.where(F.col(COUNT) > 0), keys), t, own)
    out = known.unionByName(filled.where(F.col(COUNT) == 0).select(*own, MONTH), allowMissingColumns=True)
    return out if fresh is None else out.where(fresh).drop(fresh)


def updated(stored: DataFrame, obs: DataFrame, batch: DataFrame, specs: Sequence[SeriesSpec] = DEFAULT_SERIES,
            start=None, as_of=None, t: Thresholds = Thresholds(), keys: Sequence[str] = ()) -> DataFrame:
    """The month rows ``stored`` after ``batch``; ``obs``: the observations with the batch merged.

    Both may be restricted to the partitions that the batch touches: every entity
    in them is complete, and entities without a change come back as they are.
    ``batch`` needs the keys, series_id and observation_date."""
    if not keys:  # one series set: a constant entity, so that nothing below has two forms
        one = {_ONE: F.lit(0)}
        return updated(stored.withColumns(one), obs.withColumns(one), batch.withColumns(one), specs, start, as_of, t, [_ONE]).drop(_ONE)
    keys, m = list(keys), F.col(MONTH)
    mine = batch.where(F.col("series_id").isin([s.series_id for s in specs]))
    cells = mine.select(*keys, month_of("observation_date").alias(MONTH)).distinct()
    since = change_set(mine, keys).groupBy(*keys).agg(F.min("since").alias(_SINCE))
    columns = [*keys, MONTH, *[reported(s.column) for s in specs], COUNT, align.DATES]

    again = month_values(obs.withColumn(MONTH, month_of("observation_date")).join(cells, [*keys, MONTH], "left_semi").drop(MONTH),
                         specs, keys).select(*columns)
    filled = [s.column for s in specs if s.align == FFILL]
    rows = stored.select(*columns, *filled).join(since, keys)
    earlier, backwards = m < F.col(_SINCE), Window.partitionBy(*keys).orderBy(m.desc())
    rank = F.sum(F.when(earlier & (F.col(COUNT) > 0), 1).otherwise(0)).over(backwards)
    near = rows.withColumn("_rank", rank).where(~earlier | (F.col("_rank") <= HALO))
    # a halo row's filled value is the state that the fill has reached there
    near = near.withColumns({reported(c): F.when(earlier & (F.col(COUNT) > 0), F.col(c)).otherwise(F.col(reported(c))) for c in filled})
    near = near.select(*columns, (~earlier).alias(_FRESH)).join(cells, [*keys, MONTH], "left_anti")
    changed = with_dashboard(near.unionByName(again.withColumn(_FRESH, F.lit(True))), specs, start, as_of, t, keys, _FRESH)
    kept = stored.join(since, keys, "left").where(F.col(_SINCE).isNull() | (m < F.col(_SINCE))).drop(_SINCE)
    return kept.unionByName(changed)


_ONE, _SINCE, _FRESH = "_all", "_since", "_fresh"
