"""Data-quality checks. Each returns the violating rows (a test passes on 0 rows),
and ``check_report`` folds many row-level checks on one table into one pass.

SURVEY §2: D1-D11, A5, A6, A12, J6, P15, P16.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def unique(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Keys that occur more than once (NULL keys ignored); partial+final aggregate."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    nonnull = F.lit(True)
    for c in cols:
        nonnull = nonnull & F.col(c).isNotNull()
    return (df.filter(nonnull).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is outside the list (NULL passes, as with NOT IN)."""
    return df.filter(~F.col(col).isin(list(values)))


def in_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows with a non-NULL value below ``lo`` or above ``hi``."""
    c = F.col(col)
    return df.filter(c.isNotNull() & ((c < F.lit(lo)) | (c > F.lit(hi))))


def row_ratio(expected: DataFrame, actual: DataFrame, lo: float = 0.5, hi: float = 1.1,
              keys: Sequence[str] = ()) -> DataFrame:
    """Compare two counts (per ``keys``): (keys, expected, actual, row_difference, failed).

    The two counts are brought together by a union and one aggregate, not by a
    join; a key that one side lacks counts 0 there. Fails when actual is 0,
    above hi x expected or below lo x.
    """
    e_name, a_name = ([c for c in df.columns if c not in keys][0] for df in (expected, actual))
    both = (expected.select(*keys, F.lit(0).alias("_side"), F.col(e_name).cast("long").alias("_v"))
            .unionByName(actual.select(*keys, F.lit(1).alias("_side"), F.col(a_name).cast("long").alias("_v"))))
    one = both.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(F.col("_side") == 0, F.col("_v"))), F.lit(0).cast("long")).alias(e_name),
        F.coalesce(F.max(F.when(F.col("_side") == 1, F.col("_v"))), F.lit(0).cast("long")).alias(a_name))
    return row_ratio_of(one, e_name, a_name, lo, hi, keys)


def row_ratio_of(counts: DataFrame, expected: str, actual: str, lo: float = 0.5, hi: float = 1.1,
                 keys: Sequence[str] = ()) -> DataFrame:
    """``row_ratio`` of two counts that stand side by side already."""
    e, a = F.col(expected), F.col(actual)
    failed = (a == 0) | (a > e * F.lit(hi)) | (a < e * F.lit(lo))
    return counts.select(*keys, e, a, (a - e).alias("row_difference"), failed.alias("failed"))


def staging_reconcile(staged: DataFrame, wide: DataFrame, series_id: str = "UNRATE",
                      lo: float = 0.5, hi: float = 1.1, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct observation dates of one monthly series vs wide rows, per entity."""
    s = (staged.filter(F.col("series_id") == series_id).groupBy(*keys)
               .agg(F.countDistinct("observation_date").alias("staging_months")))
    i = wide.groupBy(*keys).agg(F.count(F.lit(1)).alias("pivoted_rows"))
    return row_ratio(s, i, lo, hi, keys)


def freshness(df: DataFrame, col: str, now, warn_hours: float = 48, error_hours: float = 96) -> DataFrame:
    """Age of the newest load: PASS / WARN (> warn) / ERROR (> error) in one row."""
    if isinstance(now, (dt.datetime, str)):
        now = F.lit(str(now)).cast("timestamp_ntz")
    last = F.max(_c(col))
    # wall-clock difference of two TIMESTAMP_NTZ values: independent of the session time zone
    age = F.timestamp_diff("MICROSECOND", last, now) / F.lit(3.6e9)
    out = df.agg(last.alias("max_loaded_at"), age.alias("age_hours"))
    a = F.col("age_hours")
    return out.withColumn("status", F.when(a.isNull(), F.lit("ERROR"))
                                     .when(a > F.lit(error_hours), F.lit("ERROR"))
                                     .when(a > F.lit(warn_hours), F.lit("WARN"))
                                     .otherwise(F.lit("PASS")))


def _check_counts(checks: Sequence[tuple]) -> list[Column]:
    """One count of failing rows per check."""
    preds = []
    for name, kind, col, *args in checks:
        c = F.col(col)
        if kind == "not_null":
            p = c.isNull()
        elif kind == "accepted_values":
            p = ~c.isin(list(args[0]))
        elif kind == "in_range":
            p = c.isNotNull() & ((c < F.lit(args[0])) | (c > F.lit(args[1])))
        else:
            raise ValueError(f"unknown check kind {kind!r}")
        preds.append(F.count_if(F.coalesce(p, F.lit(False))).alias(name))
    return preds


class Watch:
    """Checks of a table that the job which writes it collects on its way: no second pass over what was written.

    ``checks`` as in ``check_report``; ``unique``: columns that no two rows share. Its window
    needs equal rows in one partition, as the metric windows or a range partitioning by
    these columns have them, so it adds no shuffle there. Where the rows come otherwise, ``on``
    leaves it out and ``failures`` looks it up in these columns of what was written. The numbers tell failing from not:
    a stage that runs again after a lost executor adds its rows twice, a zero stays a zero.
    """

    def __init__(self, checks: Sequence[tuple] = (), unique: Sequence[str] = ()):
        self.checks, self.unique, self._seen = list(checks), list(unique), None

    def on(self, df: DataFrame, unique: bool = True) -> DataFrame:
        """``df`` with the checks attached (``unique``: that of equal rows too); the first action over it fills them in."""
        self._seen = Observation(f"watch-{uuid.uuid4().hex}")
        counts = [F.count(F.lit(1)).alias("_rows"), *_check_counts(self.checks)]
        if not (self.unique and unique):
            return df.observe(self._seen, *counts)
        again = F.row_number().over(Window.partitionBy(*self.unique).orderBy(*self.unique)) > 1
        counts.append(F.count_if("_again").alias("_repeated"))
        return df.withColumn("_again", again).observe(self._seen, *counts).drop("_again")

    def failures(self, written: DataFrame | None = None) -> list[str]:
        """What failed, once the job that writes the rows has run; ``written``: its rows, if ``on`` left out the equal ones."""
        found = {}
        if self.unique and written is not None:
            n, found["_repeated"] = written.groupBy(*self.unique).agg(F.count(F.lit(1)).alias("n")).agg(
                F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()
            if n == 0:  # a plan without rows may lose its observation; no row, no failure
                return []
        seen = dict(self._seen.get) | found
        repeated = [f"{', '.join(self.unique)} not unique: {seen['_repeated']}"] if self.unique and seen["_repeated"] else []
        return repeated + [f"{c[0]}: {seen[c[0]]}" for c in self.checks if seen[c[0]]]


def check_report(df: DataFrame, checks: Sequence[tuple]) -> DataFrame:
    """Many row-level checks over one table in a single aggregate.

    ``checks``: tuples (name, kind, column, *args) with kind in
    ``not_null``, ``accepted_values`` (values), ``in_range`` (lo, hi).
    Output: one row per check (check_name, n_failed).
    """
    wide = df.agg(*_check_counts(checks))
    names = [c[0] for c in checks]
    return wide.unpivot([], names, "check_name", "n_failed")


def write_failures(violations: DataFrame, root: str, test_name: str) -> str:
    """Store failing rows for inspection under ``<root>/dq_failures/<test>``."""
    import os

    path = os.path.join(root, "dq_failures", test_name)
    violations.write.mode("overwrite").parquet(path)
    return path


@dataclass(frozen=True)
class Unique:
    """Suite test: no value of ``cols`` occurs twice (NULL keys ignored)."""
    cols: list[str]


def suite(checks) -> DataFrame:
    """Run many tests as one job: one row per test (test_name, layer, severity, n_failed).

    ``checks``: tuples ``(test_name, layer, severity, table, test)`` where the
    test is a predicate of failing rows or ``Unique(cols)``, or ``(test_name,
    layer, severity, violations)`` for tests with a frame of their own. All
    tests of one table are one pass over it: a table with a uniqueness test is
    grouped by its key, counting each predicate on the way, and the groups are
    then added up. Pass materialised tables; the suite reads each once (twice,
    if it has uniqueness tests on different keys).
    """
    parts, by_table = [], {}
    for check in checks:
        name, layer, severity, df, *test = check
        if test:
            by_table.setdefault(id(df), (df, []))[1].append((name, layer, severity, test[0]))
        else:
            parts.append(df.agg(F.count(F.lit(1)).alias("n_failed")).select(
                F.lit(name).alias("test_name"), F.lit(layer).alias("layer"),
                F.lit(severity).alias("severity"), "n_failed"))
    for df, tests in by_table.values():
        rules = [t for t in tests if not isinstance(t[3], Unique)]
        keyed: dict[tuple, list] = {}
        for t in tests:
            if isinstance(t[3], Unique):
                keyed.setdefault(tuple(t[3].cols), []).append(t)
        for i, (cols, uniques) in enumerate(list(keyed.items()) or [(None, [])]):
            own = rules if i == 0 else []
            counts = [F.count_if(F.coalesce(t[3], F.lit(False))).alias(f"_t{j}") for j, t in enumerate(own)]
            if cols is None:
                one = df.agg(*counts)
            else:
                known = F.lit(True)
                for c in cols:
                    known = known & F.col(c).isNotNull()
                groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"), *counts)
                one = groups.agg(*[F.coalesce(F.sum(f"_t{j}"), F.lit(0)).alias(f"_t{j}") for j in range(len(own))],
                                 F.count_if(known & (F.col("_n") > 1)).alias("_u"))
            rows = F.array(*[F.struct(F.lit(n).alias("test_name"), F.lit(l).alias("layer"), F.lit(s).alias("severity"),
                                      F.col(c).cast("long").alias("n_failed"))
                             for (n, l, s, _), c in [(t, f"_t{j}") for j, t in enumerate(own)] + [(t, "_u") for t in uniques]])
            parts.append(one.select(F.inline(rows)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def violations_of(check) -> DataFrame:
    """The failing rows of a suite check."""
    name, layer, severity, df, *test = check
    if not test:
        return df
    if isinstance(test[0], Unique):
        return unique(df, test[0].cols)
    return df.filter(F.coalesce(test[0], F.lit(False)))


def null_rows(col: str) -> Column:
    return F.col(col).isNull()


def outside(col: str, values) -> Column:
    return ~F.col(col).isin(list(values))


def out_of_range(col: str, lo, hi) -> Column:
    c = F.col(col)
    return c.isNotNull() & ((c < F.lit(lo)) | (c > F.lit(hi)))


def freshness_violations(df: DataFrame, col: str, now, warn_hours: float = 48,
                         error_hours: float = 96) -> DataFrame:
    """The freshness result as a test: one row when the newest load is older than the warn age."""
    return freshness(df, col, now, warn_hours, error_hours).filter(F.col("status") != "PASS")
