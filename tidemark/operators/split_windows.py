"""Windows over hot keys: an ordered key is cut into ranges, and no task holds a whole key.

A window keyed by an entity puts all of its rows into one task. Here the rows are
range-partitioned by (keys, order) and written once, sorted, with the number of
their range and a row number that ascends over all ranges. Windows run per (keys,
range), and what crosses a boundary is handed over:

* ``apply``: frames and lags that reach a fixed number of rows back or ahead get
  these rows of the neighbouring ranges as a halo. The halo is found by position in
  the key, so it also crosses ranges that are shorter than the reach;
* ``numbered``: a row's place in its key is its place in the range after the rows before;
* ``fill``: the last known value of every range is scanned over the key's ranges
  (a prefix scan over one row a range) and seeds the next one.

Only keys that are cut take part in the hand-over: a key that lies in several
ranges is the first or last key of each, so at most two rows a range describe them
all. These few rows are the only thing that is broadcast, behind a size check.

Edge cases: NULL keys are a key of their own, NULLs in the order come first, rows
that are equal in keys and order keep an arbitrary but fixed order; an empty frame
stays empty. Ranges need not be even, and results do not depend on them.

SURVEY §2: W4-W8, J8.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import broadcast_if_small

RANGE, ROW, HALO, _ALL = "_range", "_row", "_halo", "_all"


class RangeSplit:
    """``df`` cut into ranges of (keys, order), written once to the shared folder."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None):
        """``ranges``: how many at most; by default as Spark sizes a shuffle."""
        self.keys, self.columns = list(keys) or [_ALL], df.columns
        if not keys:
            df = df.withColumn(_ALL, F.lit(0))
        by = [*self.keys, *order]
        dealt = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
        self.rows = cut_lineage(dealt.sortWithinPartitions(*by).withColumns(
            {RANGE: F.spark_partition_id(), ROW: F.monotonically_increasing_id()}))

    def _spans(self, aggregates: Sequence[Column] = ()) -> DataFrame:
        """One row for every (key, range) of the keys that lie in several ranges.

        keys, _range, _n (rows), _last (greatest row number), _first (rows of the key before the range)."""
        key = F.struct(*[F.col(k) for k in self.keys], F.lit(0).alias("_"))
        ends = (self.rows.groupBy(RANGE).agg(F.min_by(key, ROW).alias("a"), F.max_by(key, ROW).alias("b"))
                .select(F.explode(F.array("a", "b")).alias("k")).distinct().select(*[F.col(f"k.{k}").alias(f"_k_{k}") for k in self.keys]))
        cut = self.rows.join(broadcast_if_small(cut_lineage(ends)), self._here(), "left_semi")
        per = cut.groupBy(*self.keys, RANGE).agg(F.count(F.lit(1)).alias("_n"), F.max(ROW).alias("_last"), *aggregates)
        whole = Window.partitionBy(*self.keys)
        earlier = whole.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        return cut_lineage(per.withColumns({"_ranges": F.count(F.lit(1)).over(whole),
                                            "_first": F.coalesce(F.sum("_n").over(earlier), F.lit(0))})
                           .where("_ranges > 1").drop("_ranges"))

    def _here(self) -> Column:
        """The key is that of a row of ranges (whose key columns start with ``_k_``)."""
        cond = None
        for k in self.keys:
            same = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
            cond = same if cond is None else cond & same
        return cond

    def _window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, RANGE).orderBy(ROW)

    def apply(self, columns: dict[str, Callable[[WindowSpec], Column]], back: int = 0, ahead: int = 0) -> DataFrame:
        """The rows with window columns; each is built from a window spec (by key, in order).

        ``back`` and ``ahead``: how many rows before and after a row the widest of them reaches."""
        rows, names = self.rows.withColumn(HALO, F.lit(False)), self.rows.columns
        if back or ahead:
            spans = broadcast_if_small(self._spans())
            s = spans.select(*[F.col(k).alias(f"_k_{k}") for k in self.keys], F.col(RANGE).alias("_r"), "_n", "_last", "_first")
            here = self._here()
            from_end, from_start = F.col("_last") - F.col(ROW), F.col("_n") - 1 - (F.col("_last") - F.col(ROW))
            edge = (self.rows.join(s, here & (F.col(RANGE) == F.col("_r")))
                    .where((from_end < back) | (from_start < ahead))
                    .withColumn("_at", F.col("_first") + from_start).select(*names, "_at"))
            # positions in the key that a range needs from its neighbours
            lo, hi = F.greatest(F.col("_first") - back, F.lit(0)), F.col("_first") + F.col("_n")
            wanted = spans.select(*[F.col(k).alias(f"_k_{k}") for k in self.keys], F.col(RANGE).alias("_target"), F.explode(F.concat(
                F.when(F.col("_first") > lo, F.sequence(lo, F.col("_first") - 1)).otherwise(F.array().cast("array<bigint>")),
                F.sequence(hi, hi + ahead - 1) if ahead else F.array().cast("array<bigint>"))).alias("_need"))
            halo = (edge.join(wanted, here & (F.col("_at") == F.col("_need"))).withColumn(RANGE, F.col("_target"))
                    .select(*names).withColumn(HALO, F.lit(True)))
            rows = rows.unionByName(halo)
        w = self._window()
        return (rows.select(*self.columns, HALO, *[f(w).alias(n) for n, f in columns.items()])
                .where(~F.col(HALO)).drop(HALO))

    def numbered(self, name: str) -> DataFrame:
        """The rows with their place (from 0) among the rows of their key, in order."""
        spans = self._spans().select(*[F.col(k).alias(f"_k_{k}") for k in self.keys], F.col(RANGE).alias("_r"), "_first")
        inside = F.row_number().over(self._window()) - 1
        return (self.rows.withColumn("_in", inside)
                .join(broadcast_if_small(cut_lineage(spans)), self._here() & (F.col(RANGE) == F.col("_r")), "left")
                .select(*self.columns, (F.coalesce("_first", F.lit(0)) + F.col("_in")).alias(name)))

    def fill(self, columns: Sequence[str], backward: bool = False) -> DataFrame:
        """The rows with NULLs in ``columns`` replaced by the key's last known value (``backward``: the next one)."""
        known = {c: F.when(F.col(c).isNotNull(), F.col(ROW)) for c in columns}
        pick = F.min_by if backward else F.max_by
        spans = self._spans([pick(F.col(c), known[c]).alias(f"_v_{i}") for i, c in enumerate(columns)])
        of_key = Window.partitionBy(*self.keys).orderBy(F.col(RANGE).desc() if backward else F.col(RANGE)).rowsBetween(Window.unboundedPreceding, -1)
        carry = spans.select(*[F.col(k).alias(f"_k_{k}") for k in self.keys], F.col(RANGE).alias("_r"), *[
            F.last(f"_v_{i}", ignorenulls=True).over(of_key).alias(f"_c_{i}") for i in range(len(columns))])
        here = self._here() & (F.col(RANGE) == F.col("_r"))
        w = self._window()
        frame = w.rowsBetween(Window.currentRow, Window.unboundedFollowing) if backward else w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        inside = F.first if backward else F.last
        filled = self.rows.withColumns({c: inside(c, ignorenulls=True).over(frame) for c in columns})
        return filled.join(broadcast_if_small(cut_lineage(carry)), here, "left").select(*[
            F.coalesce(F.col(c), F.col(f"_c_{columns.index(c)}")).alias(c) if c in columns else F.col(c) for c in self.columns])
