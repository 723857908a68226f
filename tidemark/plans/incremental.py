"""A stored panel that a load brings up to date: raw observations, and one table of month rows.

Both are snapshot tables, the month rows in buckets of entities, the observations in
buckets and years: a batch of late months leaves the years before as they are. A load merges its
batch into the touched partitions of the observations (one commit), then recomputes the
touched entities' months from their first change on (``operators.incremental``)
and replaces the touched buckets of the month rows (one commit, audited first).
Partitions without a change are neither read nor written. ``run_incremental`` is
the layered run in this form: its cost is that of the batch, not of the history.

The commit of the month rows notes the version of the observations that they
were made from. A load that finds another one (a load stopped between the two
commits) first recomputes the buckets whose folders differ between the two
versions, or all if the older one is gone. A later ``as_of`` adds the entities
that have months after the old one to the change.

A third table holds the states per entity and year from which the summary is merged
(``operators.states``); its commit notes the version of the month rows.

SURVEY §2: S14, S16, S19, M3-M7, D5.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import incremental as inc
from ..operators import align, load, marts, states
from ..schemas import DEFAULT_SERIES, DEFAULT_START_DATE, MONTH, SeriesSpec, Thresholds, observations_contract
from ..session import cut_lineage
from ..sources import tables
from ..sources.snapshots import FOLDER, ROWS, SnapshotTable
from .layers import RunConfig, load_batch, mart_audit

BUCKETS = 64


@dataclass
class Panel:
    spark: SparkSession
    root: str
    keys: Sequence[str] = ()
    specs: Sequence[SeriesSpec] = DEFAULT_SERIES
    thresholds: Thresholds = Thresholds()
    start: str = DEFAULT_START_DATE
    buckets: int = BUCKETS          # at 100 TB: so many that a bucket fits a few tasks; fixed for a stored panel
    observations: SnapshotTable | None = None   # the layered run's raw table; default: one in buckets of its own

    def __post_init__(self):
        names = ", ".join(f"`{k}`" for k in self.keys)
        part = {"bucket": f"pmod(xxhash64({names}), {self.buckets})" if self.keys else "0"}
        if self.observations is None:
            self.observations = self._own_observations(part)
        self.months = SnapshotTable(self.spark, os.path.join(self.root, "months"), self._month_schema(), part)
        self.states = SnapshotTable(self.spark, os.path.join(self.root, "states"), self._states(
            self.spark.createDataFrame([], self.months.schema)).schema, part)

    def _own_observations(self, part: dict[str, str]) -> SnapshotTable:
        """In buckets and years; a table that was stored in buckets alone stays so."""
        path, contract = os.path.join(self.root, "observations"), observations_contract(self.keys)
        by_bucket = SnapshotTable(self.spark, path, contract, part)
        old = by_bucket.version()
        if old is not None and "year" not in by_bucket.manifest_columns(old):
            return by_bucket
        return SnapshotTable(self.spark, path, contract, part | {"year": "year(observation_date)"})

    def _month_schema(self) -> T.StructType:
        empty = self.spark.createDataFrame([], observations_contract(self.keys))
        return self._full(empty, "2000-01-01").schema

    def _full(self, obs: DataFrame, as_of) -> DataFrame:
        return inc.with_dashboard(inc.month_values(obs, self.specs, self.keys), self.specs, self.start, as_of, self.thresholds, self.keys)

    # ------------------------------------------------------------ loading

    def load(self, batch: DataFrame, as_of: str, now=None) -> int:
        """Merge ``batch`` ([keys,] series_id, observation_date, value) and bring the month rows up to date.

        Returns the rows merged. The same batch again changes nothing."""
        row_key = [*self.keys, "series_id", "observation_date"]
        contract = observations_contract(self.keys)
        base = self.observations.version()
        fresh = load.dedup_batch(batch, row_key).select(
            *[F.col(f.name).cast(f.dataType) if f.name in batch.columns else
              (load._ts(now) if f.name == "ingested_at" else F.lit(None).cast(f.dataType)).alias(f.name) for f in contract.fields])
        if base is None:  # the first load: its rows are the table, written once
            written = self.observations.replace(fresh, keep_empty=False)
            n = written.agg(F.coalesce(F.sum(ROWS), F.lit(0))).first()[0]
            self.refresh(self.observations.read(), as_of, base)
            return n
        fresh = cut_lineage(fresh)
        n = fresh.count()
        if n:
            touched = self.observations.values(fresh)
            self.observations.replace(load.upsert(self.observations.read(touched, base), fresh, row_key, now), touched, base)
        self.refresh(fresh, as_of, base)
        return n

    def refresh(self, batch: DataFrame, as_of: str, before: int | None) -> None:
        """Month rows after ``batch``, which made the last version of the observations from version ``before``."""
        base, version = self.months.version(), self.observations.version()
        if version is None:
            return
        note = json.loads(self.months.note(base)) if base is not None else None
        marks = json.dumps({"observations": version, "start": str(self.start), "as_of": str(as_of)})
        if note is None or note["start"] != str(self.start) or str(as_of) < note["as_of"]:
            self.months.replace(self._full(self.observations.read(version=version), as_of), None, base, marks,
                                mart_audit(list(self.keys)))
            self._refresh_states(None)
            return
        change = batch.select(*self.keys, "series_id", "observation_date")
        if note["observations"] not in (before, version):  # a load ended between its two commits
            change = change.unionByName(self._differing(note["observations"], version))
        if str(as_of) > note["as_of"]:
            late = (self.months.read(version=base).where((F.col(MONTH) > F.lit(note["as_of"]).cast("date")))
                    .select(*self.keys, F.lit(self.specs[0].series_id).alias("series_id"), F.col(MONTH).alias("observation_date")))
            change = change.unionByName(late)
        change = cut_lineage(change)
        touched = cut_lineage(self.months.values(change))
        rows = inc.updated(self.months.read(touched, base), self._cells(change, touched, version), change, self.specs,
                           self.start, as_of, self.thresholds, self.keys)
        self.months.replace(rows, touched, base, marks, mart_audit(list(self.keys)))
        self._refresh_states(touched, base)

    def _states(self, months: DataFrame) -> DataFrame:
        return states.summary_states(months.where(F.col(inc.COUNT) > 0), self.keys)

    def _refresh_states(self, touched: DataFrame | None, before: int | None = None) -> None:
        """States of the touched buckets, or of all if they were not those of the month rows ``before``."""
        base, version = self.states.version(), self.months.version()
        if base is None or self.states.note(base) != str(before):
            touched = None
        self.states.replace(self._states(self.months.read(touched, version)), touched, base, str(version))

    def _cells(self, change: DataFrame, touched: DataFrame, version: int) -> DataFrame:
        """Observations of all series in the months of ``change``: of its buckets, or of its years."""
        if set(self.observations.parts) == set(touched.columns):
            return self.observations.read(touched, version)
        ids = F.array(*[F.lit(s.series_id) for s in self.specs])
        return self.observations.read(self.observations.values(change.withColumn("series_id", F.explode(ids))), version)

    def _differing(self, old: int, new: int) -> DataFrame:
        """Keys of all observations in buckets that differ between two versions."""
        now = self.observations.manifest(new)
        if old in self.observations.versions():
            now = now.join(self.observations.manifest(old).select(FOLDER), FOLDER, "left_anti")
        rows = self.observations.read(now.select(*self.observations.parts), new)
        return rows.select(*self.keys, "series_id", "observation_date")

    # ------------------------------------------------------------ reading

    def dashboard(self, version: int | None = None) -> DataFrame:
        """The dashboard mart: months with a monthly series."""
        return self.months.read(version=version).where(F.col(inc.COUNT) > 0).select(*self.keys, MONTH, *marts.DASHBOARD_COLUMNS)

    def current_states(self) -> DataFrame:
        """States per (entity, year) of the last version of the month rows (made anew if a load stopped before them)."""
        base, version = self.states.version(), self.months.version()
        if base is not None and self.states.note(base) == str(version):
            return self.states.read(version=base)
        return self._states(self.months.read(version=version))

    def summary(self) -> DataFrame:
        """The indicator summary, from one state a year."""
        return states.summary_of(self.current_states(), self.keys)

    def reconciliation(self) -> DataFrame:
        """Distinct dates of the reconciled series against month rows, per entity, in one pass over two columns."""
        return states.reconcile(self.months.read(), align.DATES, inc.COUNT, keys=self.keys)


def run_incremental(spark: SparkSession, cfg: RunConfig) -> Panel:
    """Load the landed payloads and bring the dashboard and the summary up to date.

    As ``run_layers``, but at the cost of the batch: raw observations are merged, only
    touched entities' months are recomputed, audited and published, the summary is
    one aggregate over the dashboard. Raises after loading if a series failed."""
    raw = tables.observations_table(spark, tables.layer_path(cfg.root, "raw", "observations"), cfg.keys)
    panel = Panel(spark, os.path.join(cfg.root, "marts", "panel"), cfg.keys, cfg.specs, cfg.thresholds, cfg.start, observations=raw)
    before = raw.version()
    log, batch = load_batch(spark, cfg)
    panel.refresh(batch, cfg.as_of or dt.date.today().isoformat(), before)
    if panel.months.version() is not None:
        tables.publish(panel.summary(), cfg.root, "marts", "indicator_summary")
    load.raise_if_failed(log)
    return panel
