"""Operator 10. Mixing sources to target weights by Pfair scheduling.

A source's rows, in a pseudo-random order fixed by their hashes, form blocks of
``block_rows``. Sources of equal weight form a group that takes turns; a group of k
sources of weight u has weight ``w = k * u``. With whole weights ``w`` of total ``W``,
the ``j``-th block of a group (from 0) is released at slot ``floor(j * W / w)`` and due
by slot ``ceil((j + 1) * W / w)``; each slot takes the released block with the
earliest deadline (ties: the group whose first source sorts first). On one
"processor" with shares that add up to one, earliest deadline first meets every
deadline, so after any number of slots each group has been given less than one
block more or less than its share. A group that has taken A blocks has given each
source between (A - k + 1) / k and (A + k - 1) / k of them, so the same holds for
each source. The schedule has period ``W`` and is repeated.

When a source has no blocks left, the sources that remain start a new schedule
with their own weights (a phase); rows are never dropped or repeated. The turns go
on where they were. They are taken in order of falling block counts, so the sources
that are left always are the first of that order, and the place of a block in
its group's turns follows from the distinct block counts alone (steps).

The driver sees one count per source, never documents. It makes no more slots of
a phase than its length or its period, each at the cost of a heap of the groups. Its
tables have a row for each source, for each distinct block count of a group, and for each
phase and group. They are broadcast only up to a stated size, and looked up by
ranges (bins), so that a row meets a few phases, not all.

Ranks within a source come from per-bucket counts, so a source with a third of
all rows is spread over its buckets; no task holds a source.

Edge cases: null sources form the source ``""``; sources without a weight get
the default weight; a weight that is no positive integer is refused; repeated rows keep their
multiplicity; rows with null ids are ordered by their text; an empty table gives
an empty result. Column names of the input cannot clash: helpers start with
``__mix_``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import accumulate, groupby, islice
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved

BLOCK_ROWS = 16
#: Rows that one hash bucket of a source holds on average: the unit that a task ranks.
BUCKET_ROWS = 4096
#: A table of at most so many rows is broadcast (some 40 bytes a row).
BROADCAST_ROWS = 100_000
#: A schedule of at most so many numbers is broadcast.
BROADCAST_NUMBERS = 2_000_000


def _source(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slots(weights: tuple[int, ...]) -> Iterator[int]:
    """The index that each slot goes to, without end: of the released blocks the one that is due first."""
    total = sum(weights)
    given = [0] * len(weights)
    ready = [(-(-total // w), i) for i, w in enumerate(weights)]  # (deadline, index)
    waiting: list[tuple[int, int]] = []  # (release, index)
    heapify(ready)
    t = 0
    while True:
        while waiting and waiting[0][0] <= t:
            i = heappop(waiting)[1]
            heappush(ready, (-(-(given[i] + 1) * total // weights[i]), i))
        i = heappop(ready)[1]
        yield i
        given[i] += 1
        heappush(waiting, (given[i] * total // weights[i], i))
        t += 1


def period(_spark: SparkSession, weights: tuple[int, ...]) -> list[int]:
    """One period of the schedule; it depends on the weights alone."""
    return list(islice(slots(weights), sum(weights)))


def _phase(weights: tuple[int, ...], need: list[int]) -> tuple[int, list[int], list[list[int]]]:
    """(slots, blocks used by each, offsets within a period of each) until the first has taken the blocks it needs."""
    total, offsets = sum(weights), [[] for _ in weights]
    repeats = all(n > w for n, w in zip(need, weights))
    for t, i in enumerate(islice(slots(weights), total)):
        offsets[i].append(t)
        if not repeats and len(offsets[i]) == need[i]:
            return t + 1, [len(o) for o in offsets], offsets
    length = 1 + min((n - 1) // w * total + o[(n - 1) % w] for n, w, o in zip(need, weights, offsets))
    rounds, rest = divmod(length, total)
    return length, [rounds * w + bisect_left(o, rest) for w, o in zip(weights, offsets)], offsets


def turns(sources: list[tuple[str, int, int]]) -> tuple[list[tuple], list[tuple], list[tuple[int, deque[int]]]]:
    """Groups of equal weight among ``sources`` (name, weight, blocks), in order of their first names.

    Members (name, group, rank in its turns); steps (group, lo, hi, k, base): block j, lo <= j < hi, of
    the member of rank r has place base + (j - lo) * k + r; for each group its weight per
    source and the places of its sources' last blocks, rising."""
    named: dict[int, list[tuple[int, str]]] = {}
    for name, weight, blocks in sorted(sources):
        if blocks > 0:
            named.setdefault(weight, []).append((-blocks, name))
    members, steps, ends = [], [], []
    for g, (weight, group) in enumerate(named.items()):
        group.sort()
        members += [(name, g, r) for r, (_, name) in enumerate(group)]
        lo, base, k, last = 0, 0, len(group), deque()
        for blocks, same in groupby(-n for n, _ in reversed(group)):
            steps.append((g, lo, blocks, k, base))
            base += (blocks - lo) * k
            gone = len(list(same))
            last.extend(range(base - gone, base))
            lo, k = blocks, k - gone
        ends.append((weight, last))
    return members, steps, ends


def phases(ends: list[tuple[int, deque[int]]]) -> Iterator[tuple[int, int, int, list[int], int, int]]:
    """(group, places used before the phase, places used in it, offsets, period, slots before the phase)."""
    at, first = [0] * len(ends), 0
    while live := [g for g, (_, last) in enumerate(ends) if last]:
        weights = [ends[g][0] * len(ends[g][1]) for g in live]
        common = gcd(*weights)
        weights = tuple(w // common for w in weights)
        length, used, offsets = _phase(weights, [ends[g][1][0] - at[g] + 1 for g in live])
        for g, n, o in zip(live, used, offsets):
            if n:
                yield g, at[g], n, o, sum(weights), first
            at[g] += n
            if at[g] > ends[g][1][0]:
                ends[g][1].popleft()
        first += length


def _binned(spark: SparkSession, rows: list[tuple], schema: str, lo: str, hi: str, spans: list[tuple[int, int]],
            numbers: list[int]) -> tuple[DataFrame, int]:
    """``rows``, that hold for [lo, hi) of their group, as a row for each bin they touch (__mix_bin), and the bins' width.

    Bins are as wide as a row holds for on average, so there are not many more than rows.
    The table is broadcast if it has few numbers (``numbers``: of each row)."""
    width = max(1, -(-sum(b - a for a, b in spans) // max(1, len(rows))))
    size = sum(n * ((b - 1) // width - a // width + 1) for n, (a, b) in zip(numbers, spans))
    out = spark.createDataFrame(rows, schema).withColumn(
        "__mix_bin", F.explode(F.expr(f"sequence({lo} div {width}, ({hi} - 1) div {width})")))
    return (F.broadcast(out) if size <= BROADCAST_NUMBERS else out), width


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A driver's table, broadcast only up to BROADCAST_ROWS."""
    out = spark.createDataFrame(rows, schema)
    return F.broadcast(out) if len(rows) <= BROADCAST_ROWS else out


def place(docs: DataFrame, weights: dict[str, int], default_weight: int = 1, source: str = "source",
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with __mix_source, __mix_block, __mix_slot and __mix_rank (place in the block).

    The mixed order is by (__mix_slot, __mix_rank); both are unique together."""
    spark = docs.sparkSession
    if any(not isinstance(w, int) or w < 1 for w in [*weights.values(), default_weight]):
        raise ValueError("weights are whole numbers from 1 on")
    key = F.xxhash64("doc_id")
    if "text" in docs.columns:
        key = F.when(F.col("doc_id").isNotNull(), key).otherwise(F.xxhash64("text"))
    keyed = docs.withColumns({"__mix_source": _source(source), "__mix_key": key})
    per_source = keyed.groupBy("__mix_source").count().collect()  # one row per source, which the weights name
    members, steps, ends = turns([(r[0], weights.get(r[0], default_weight), -(-r[1] // block_rows)) for r in per_source])
    buckets = {r[0]: max(1, -(-r[1] // BUCKET_ROWS)) for r in per_source}
    of_source = _small(spark, [(s, buckets[s], g, r) for s, g, r in members],
                       "__mix_source string, __mix_n long, __mix_group long, __mix_turn long")
    # buckets are ranges of the hash, in its order
    width = F.expr("cast(shiftrightunsigned(__mix_key, 32) * __mix_n div 4294967296 as long)")
    dealt = keyed.join(of_source, "__mix_source").withColumn("__mix_bucket", width).drop("__mix_n")
    counts = dealt.groupBy("__mix_source", "__mix_bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("__mix_source").orderBy("__mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = saved(counts.select("__mix_source", "__mix_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__mix_start")),
                   "mix-starts")
    order = [F.col("__mix_key"), *(F.col(c) for c in ("doc_id", "text") if c in docs.columns)]
    inside = F.row_number().over(Window.partitionBy("__mix_source", "__mix_bucket").orderBy(*order)) - 1
    small = starts.count() <= BROADCAST_ROWS
    ranked = (dealt.withColumn("__mix_in", inside)
              .join(F.broadcast(starts) if small else starts, ["__mix_source", "__mix_bucket"])
              .withColumn("__mix_at", F.col("__mix_start") + F.col("__mix_in"))
              .withColumn("__mix_block", F.expr(f"__mix_at div {block_rows}"))
              .withColumn("__mix_rank", F.col("__mix_at") % block_rows)
              .drop("__mix_key", "__mix_bucket", "__mix_in", "__mix_start", "__mix_at"))
    by_step, width = _binned(spark, steps, "__mix_group long, __mix_lo long, __mix_hi long, __mix_k long, __mix_base long",
                             "__mix_lo", "__mix_hi", [(lo, hi) for _, lo, hi, _, _ in steps], [6] * len(steps))
    turned = (_lookup(ranked, by_step, "__mix_block", width, "__mix_lo", "__mix_hi")
              .withColumn("__mix_place", F.expr("__mix_base + (__mix_block - __mix_lo) * __mix_k + __mix_turn")))
    plan = list(phases(ends))
    by_phase, width = _binned(
        spark, [(g, used, used + n, o, total, first) for g, used, n, o, total, first in plan],
        "__mix_group long, __mix_from long, __mix_to long, __mix_offsets array<long>, __mix_period long, __mix_first long",
        "__mix_from", "__mix_to", [(used, used + n) for _, used, n, *_ in plan], [6 + len(p[3]) for p in plan])
    slot = F.expr("__mix_first + (__mix_place - __mix_from) div size(__mix_offsets) * __mix_period"
                  " + __mix_offsets[int((__mix_place - __mix_from) % size(__mix_offsets))]")
    return _lookup(turned, by_phase, "__mix_place", width, "__mix_from", "__mix_to").select(
        *docs.columns, "__mix_source", "__mix_block", "__mix_rank", slot.alias("__mix_slot"))


def _lookup(rows: DataFrame, ranges: DataFrame, value: str, width: int, lo: str, hi: str) -> DataFrame:
    """The range [lo, hi) of its group that ``value`` lies in, joined by bin."""
    return (rows.withColumn("__mix_bin", F.expr(f"{value} div {width}")).join(ranges, ["__mix_group", "__mix_bin"])
            .where((F.col(value) >= F.col(lo)) & (F.col(value) < F.col(hi))).drop("__mix_bin"))


def mixed(docs: DataFrame, weights: dict[str, int], default_weight: int = 1, **options) -> DataFrame:
    """The rows of ``docs`` in the mixed order (a global sort), with the columns of ``docs``."""
    placed = place(docs, weights, default_weight, **options)
    return placed.orderBy("__mix_slot", "__mix_rank").select(*docs.columns)


def _part(name: str) -> tuple[list[int], str]:
    """Sort key of a part file: its task and file numbers, as numbers (names of over 99,999 tasks do not sort as text)."""
    found = re.match(r"part-(\d+).*?(?:-c(\d+))?\.", name)
    return [int(x or 0) for x in found.groups()] if found else [], name


def with_position(docs: DataFrame, column: str = "position") -> DataFrame:
    """``docs`` with the place (from 0) of each row in the order in which the table is stored.

    Spark reads the files of a table longest first, so the order that ``mixed``
    was written in is that of the part numbers and of the rows in a part, not that
    of a scan. The driver sees one count per file. A frame that is no stored
    table is written first and has the order of its partitions."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = saved(docs, "mix-positions")
    at = docs.select("*", F.col("_metadata.file_path").alias("__mix_file"), F.col("_metadata.file_name").alias("__mix_name"),
                     F.col("_metadata.row_index").alias("__mix_row"))
    files = sorted(at.groupBy("__mix_name", "__mix_file").count().collect(), key=lambda r: (_part(r[0]), r[1]))
    starts = _small(docs.sparkSession, [(r[1], n) for r, n in zip(files, accumulate((r[2] for r in files), initial=0))],
                    "__mix_file string, __mix_start long")
    return at.join(starts, "__mix_file").select(*docs.columns, (F.col("__mix_start") + F.col("__mix_row")).alias(column))
