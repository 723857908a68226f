"""Tables with snapshots: partitions are replaced together, readers see one version.

::

    <path>/_commits/00000000000000000007   names one manifest, and a note; creating this file is the commit
    <path>/_manifests/<id>/                Parquet: partition values, folder, rows
    <path>/data/<id>/<part>=<value>/...    Parquet files with all columns of the table

A reader takes the last commit and reads the folders of its manifest, so it
sees all partitions of one version however many a load replaces. A writer
writes the touched partitions to a folder of its own and a manifest that has
them beside the untouched rows of the version it started from. The commit
renames a small file to the next number, which the file system refuses if that
number exists: of two loads that start from one version the second fails with
``Conflict`` and leaves nothing that a reader sees. A crash at any time leaves
folders that no manifest names (``vacuum`` removes them), never a partial table.

A table may have been written under earlier contracts (``history``): a manifest tells
the contract of each folder, and a read brings older folders up to the current one,
with defaults for added columns and widened types, beside the newer ones. Nothing is
rewritten; a partition takes the current contract when a load replaces it.

Partitions are expressions over the table's columns, so a table has exactly the
columns of its contract. Readers that touch few partitions open only these
folders: the manifest is filtered, not the data. The driver holds the folder
names that a read opens, one a partition.

SURVEY §2: S7, S9, S14, S16.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Versions kept beside the current one, for readers that opened them.
KEPT_VERSIONS = 1
FOLDER, ROWS, CONTRACT = "_folder", "_rows", "_contract"


class Conflict(RuntimeError):
    """Another writer committed after this one had read the table; nothing of this write is visible."""


class AuditFailed(RuntimeError):
    """A written table failed its audit and was not published."""


class ContractError(ValueError):
    """A contract that rows of an earlier one cannot be brought up to."""


#: Types that hold all values of another.
_WIDER = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"),
          ("int", "bigint"), ("int", "double"), ("smallint", "double"), ("tinyint", "double"), ("float", "double"),
          ("date", "timestamp_ntz"), ("int", "string"), ("bigint", "string"), ("date", "string")}


def _widens(old: T.DataType, new: T.DataType) -> bool:
    if old == new or (old.simpleString(), new.simpleString()) in _WIDER:
        return True
    return (isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType) and new.scale >= old.scale
            and new.precision - new.scale >= old.precision - old.scale)


def check_upgrade(old: T.StructType, new: T.StructType, defaults: dict[str, str]) -> None:
    """Raise unless every row of ``old`` has a place in ``new``: types widen, added NOT NULL columns have a default."""
    before = {f.name: f for f in old.fields}
    for f in new.fields:
        if f.name not in before:
            if not f.nullable and f.name not in defaults:
                raise ContractError(f"column {f.name} is new and NOT NULL, without a default for earlier rows")
        elif not _widens(before[f.name].dataType, f.dataType):
            raise ContractError(f"column {f.name}: {before[f.name].dataType.simpleString()} does not widen to {f.dataType.simpleString()}")


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, parts: dict[str, str],
                 history: Sequence[T.StructType] = (), defaults: dict[str, str] | None = None):
        """``parts``: partition name -> SQL expression over the table's columns.

        ``history``: earlier contracts, oldest first; ``defaults``: column -> SQL expression
        for rows that were written before the column was there (without one: NULL)."""
        self.spark, self.path, self.schema, self.parts = spark, path, schema, parts
        self.contracts, self.defaults = [*history, schema], defaults or {}
        for old, new in zip(self.contracts, self.contracts[1:]):
            check_upgrade(old, new, self.defaults)

    # ------------------------------------------------------------ files

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._fs(os.path.join(self.path, folder))
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self) -> list[int]:
        return [int(n) for n in self._names("_commits") if n.isdigit()]

    def version(self) -> int | None:
        """The last committed version; None before the first."""
        return max(self.versions(), default=None)

    def _read_commit(self, version: int) -> str:
        fs, p = self._fs(os.path.join(self.path, "_commits", f"{version:020d}"))
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _manifest_name(self, version: int) -> str:
        return self._read_commit(version).split("\n", 1)[0]

    def note(self, version: int) -> str:
        """What the writer of a version has put down beside it."""
        return self._read_commit(version).split("\n", 1)[1]

    def _commit(self, manifest: str, version: int, note: str = "") -> None:
        jvm = self.spark._jvm
        fs, fresh = self._fs(os.path.join(self.path, "_commits", f"_fresh-{uuid.uuid4().hex}"))
        out = fs.create(fresh, False)
        out.write(bytearray(f"{manifest}\n{note}".encode()))
        out.close()
        target = jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, "_commits", f"{version:020d}"))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fs.makeQualified(fresh), fs.makeQualified(target), options)
        except Py4JJavaError as e:
            fs.delete(fresh, False)
            if fs.exists(target):
                raise Conflict(f"{self.path}: version {version} was committed by another load") from e
            raise

    # ------------------------------------------------------------ reading

    def _part_schema(self) -> T.StructType:
        empty = self.spark.createDataFrame([], self.schema)
        return empty.select(*[F.expr(e).alias(n) for n, e in self.parts.items()]).schema

    def manifest(self, version: int | None = None) -> DataFrame:
        """Partition values, _folder (below the table's path), _rows and _contract of a version (default: the last)."""
        version = self.version() if version is None else version
        fields = [*self._part_schema().fields, T.StructField(FOLDER, T.StringType()), T.StructField(ROWS, T.LongType()),
                  T.StructField(CONTRACT, T.IntegerType())]
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
        if version is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(os.path.join(self.path, "_manifests", self._manifest_name(version)))

    def manifest_columns(self, version: int) -> list[str]:
        """The columns that a version's manifest was written with."""
        return self.spark.read.parquet(os.path.join(self.path, "_manifests", self._manifest_name(version))).columns

    def read(self, touched: DataFrame | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version (default: the last); ``touched``: only of these values of all or some of the partitions' parts."""
        m = self.manifest(version)
        if touched is not None:
            m = self._of(m, touched, "left_semi")
        out = None
        found = [(r[1] or 0, os.path.join(self.path, r[0])) for r in m.select(FOLDER, CONTRACT).collect()]  # one a partition
        for n, contract in enumerate(self.contracts):
            folders = sorted(f for c, f in found if c == n)
            if folders:
                df = self._upgraded(self.spark.read.schema(contract).option("recursiveFileLookup", True).parquet(*folders), contract)
                out = df if out is None else out.unionByName(df)
        return self.spark.createDataFrame([], self.schema) if out is None else out

    def _upgraded(self, df: DataFrame, contract: T.StructType) -> DataFrame:
        """Rows of an earlier contract under the current one."""
        if contract == self.schema:
            return df
        names = {f.name for f in contract.fields}
        return df.select(*[(F.col(f.name) if f.name in names else F.expr(self.defaults.get(f.name, "NULL"))).cast(f.dataType).alias(f.name)
                           for f in self.schema.fields])

    def read_checked(self, max_lengths: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
        """The last version's rows that keep the current contract, and those that break it (NULLs, over-long texts)."""
        from .tables import conform

        return conform(self.read(), self.schema, None, max_lengths)

    def values(self, df: DataFrame) -> DataFrame:
        """The distinct partition values of ``df``'s rows."""
        return df.select(*[F.expr(e).alias(n) for n, e in self.parts.items()]).distinct()

    def _of(self, manifest: DataFrame, touched: DataFrame, how: str) -> DataFrame:
        named = [n for n in self.parts if n in touched.columns]
        t = touched.select(*[F.col(n).alias(f"_t_{n}") for n in named])
        same = [F.col(n).eqNullSafe(F.col(f"_t_{n}")) for n in named]
        return manifest.join(t, same, how)

    # ------------------------------------------------------------ writing

    def replace(self, rows: DataFrame, touched: DataFrame | None = None, base: int | None = None, note: str = "",
                audit=None, keep_empty: bool = True) -> DataFrame:
        """Commit a version in which the ``touched`` partitions (default: all) hold ``rows``; returns what was written.

        ``base``: the version that ``rows`` were made from (None: there was none).
        Rows outside the touched partitions are an error of the caller. A partition
        that has no rows any more goes. ``audit``: a ``quality.Watch``, collected by the job
        that writes; any failure keeps the version from being committed. ``keep_empty``: whether
        a version is committed if nothing was written. Raises ``Conflict`` if ``base`` is no longer the last."""
        name = uuid.uuid4().hex
        data = os.path.join("data", name)
        marks = {f"_p_{n}": F.expr(e) for n, e in self.parts.items()}
        full = os.path.join(self.path, data)
        out = rows.select(*[f.name for f in self.schema.fields])
        out = (audit.on(out, unique=False) if audit is not None else out).withColumns(marks)
        # rebalance: a hot partition is split over tasks, small ones share one
        out.hint("rebalance", *marks).write.partitionBy(*marks).parquet(full)
        values = [T.StructField(f"_p_{f.name}", f.dataType) for f in self._part_schema().fields]
        stored = self.spark.read.schema(T.StructType([*self.schema.fields, *values])).parquet(full)
        failures = audit.failures(stored) if audit is not None else []
        if failures:
            raise AuditFailed(f"{self.path}: version not committed: " + "; ".join(failures))
        # rows are counted by file, so that names are taken apart once a file and not once a row
        files = (stored.select(*[F.col(f"_p_{n}").alias(n) for n in self.parts], F.col("_metadata.file_path").alias("_file"))
                 .groupBy(*self.parts, "_file").agg(F.count(F.lit(1)).alias(ROWS)))
        folder = F.concat(F.lit(data), F.regexp_extract("_file", f"/{name}(/.*)/[^/]*$", 1))
        written = (files.withColumn(FOLDER, F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))))
                   .groupBy(*self.parts, FOLDER).agg(F.sum(ROWS).alias(ROWS), F.lit(len(self.contracts) - 1).alias(CONTRACT)))
        kept = self.manifest(base) if base is not None else self.manifest(None).limit(0)
        kept = kept.limit(0) if touched is None else self._of(kept, touched, "left_anti")
        both = os.path.join(self.path, "_manifests", name)
        kept.select(written.columns).unionByName(written).write.parquet(both)
        new = self.spark.read.schema(self.manifest(None).schema).parquet(both).where(F.col(FOLDER).startswith(data))
        if not keep_empty and new.isEmpty():
            return new
        self._fs(self.path)[0].mkdirs(self._fs(os.path.join(self.path, "_commits"))[1])
        if self.version() != base:
            raise Conflict(f"{self.path}: version {self.version()} was committed after version {base} was read")
        self._commit(name, 1 if base is None else base + 1, note)
        self._drop_old()
        return new

    def _drop_old(self) -> None:
        """Remove versions beyond the kept ones, and the folders that only they name."""
        old = self.versions()[:-1 - KEPT_VERSIONS]
        if not old:
            return
        kept = None
        for v in self.versions()[-1 - KEPT_VERSIONS:]:
            m = self.manifest(v).select(FOLDER)
            kept = m if kept is None else kept.unionByName(m)
        for v in old:
            gone = self.manifest(v).select(FOLDER).join(kept, FOLDER, "left_anti")
            for r in gone.toLocalIterator():  # the partitions that a later load replaced
                fs, p = self._fs(os.path.join(self.path, r[0]))
                fs.delete(p, True)
            for f in (os.path.join("_manifests", self._manifest_name(v)), os.path.join("_commits", f"{v:020d}")):
                fs, p = self._fs(os.path.join(self.path, f))
                fs.delete(p, True)

    def vacuum(self, older_than_s: float = 24 * 3600.0) -> int:
        """Remove data and manifests of loads that never committed; returns how many.

        Only what is older than any load can be: a running load's folders are not named yet."""
        named = {self._manifest_name(v) for v in self.versions()}
        used = set()
        for v in self.versions():
            used |= {r[0].split("/")[1] for r in self.manifest(v).select(FOLDER).toLocalIterator()}
        n = 0
        for folder, keep in (("data", used), ("_manifests", named)):
            for name in self._names(folder):
                fs, p = self._fs(os.path.join(self.path, folder, name))
                if name not in keep and fs.getFileStatus(p).getModificationTime() / 1000 <= time.time() - older_than_s:
                    n += bool(fs.delete(p, True))
        return n
