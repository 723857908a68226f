"""As-of join: every left row with the nearest right row in time, of its entity.

Both sides become one frame ordered by time, right rows before left ones of the same
time; the right side's values are carried over the left rows that follow, with
the split fill (``split_windows``), so an entity with a third of all rows is
cut into ranges. No row is compared with more than its neighbours, and no pair of
times is enumerated.

Edge cases: left rows without a match, with a NULL time or a NULL key stay, with NULL
values; right rows with a NULL time or key match nothing. Of right rows with equal
key and time the greatest by ``tie`` (then by values) counts. A tolerance is inclusive.

SURVEY §2: J8 (general form), W4.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import latest_per_key
from .split_windows import RangeSplit

_T, _SIDE, _V = "_asof_t", "_asof_side", "_asof_v"


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, values: dict[str, str],
              direction: str = "backward", within: Column | None = None, tie: Sequence[str] = (), strict: bool = False,
              ranges: int | None = None) -> DataFrame:
    """``left`` with ``values`` (output name -> right column) of the matching right row.

    ``direction``: ``backward`` (the last right row not after the left one), ``forward``
    (the first not before it) or ``nearest`` (the closer of the two, the earlier if
    equally close). ``within``: greatest distance, as an interval, or a number for
    numeric times. ``strict``: rows of the same time do not match."""
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"unknown direction {direction!r}")
    by = list(by)
    known = F.col(right_on).isNotNull()
    for k in by:
        known = known & F.col(k).isNotNull()
    picked = latest_per_key(right.where(known), [*by, right_on],
                            [F.col(c).desc_nulls_last() for c in dict.fromkeys([*tie, *values.values()])])
    value = F.struct(F.col(right_on).alias("at"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(values.values())])
    out = list(left.columns)
    one = left.withColumns({_T: F.col(left_on), _SIDE: F.lit(1)})

    def matched(rows: DataFrame, side: int, backward_fill: bool) -> DataFrame:
        """``rows`` (left) with the carried right struct; ``side`` places equal right rows before (0) or after (2) them."""
        two = picked.select(*by, F.col(right_on).alias(_T), F.lit(side).alias(_SIDE), value.alias(_V))
        both = rows.unionByName(two, allowMissingColumns=True)
        return RangeSplit(both, by, [_T, _SIDE], ranges).fill([_V], backward=backward_fill).where(F.col(_SIDE) == 1)

    usable = F.col(_T).isNotNull()
    for k in by:
        usable = usable & F.col(k).isNotNull()

    def kept(v: Column, gap: Column) -> Column:
        ok = usable & v.isNotNull()
        return F.when(ok if within is None else ok & (gap <= within), v)

    now = F.col(_T)
    if direction == "backward":
        rows = matched(one, 2 if strict else 0, False)
        v = kept(F.col(_V), now - F.col(f"{_V}.at"))
    elif direction == "forward":
        rows = matched(one, 0 if strict else 2, True)
        v = kept(F.col(_V), F.col(f"{_V}.at") - now)
    else:
        rows = matched(one, 2 if strict else 0, False).withColumnRenamed(_V, f"{_V}_b")
        rows = matched(rows, 0 if strict else 2, True)
        b, a = kept(F.col(f"{_V}_b"), now - F.col(f"{_V}_b.at")), kept(F.col(_V), F.col(f"{_V}.at") - now)
        v = F.when(b.isNull(), a).when(a.isNull(), b).when(F.col(f"{_V}.at") - now < now - F.col(f"{_V}_b.at"), a).otherwise(b)
    return rows.withColumn(_V, v).select(*out, *[F.col(f"{_V}.v{i}").alias(n) for i, n in enumerate(values)])
