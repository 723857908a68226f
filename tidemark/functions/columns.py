"""Column expressions (all JVM-side, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

# Strict decimal number: optional sign, digits with optional fraction, optional
# exponent. Spark's cast also accepts forms such as '1d' or 'Infinity' that a
# plain float parse of the landing text would reject, so we guard it.
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
MISSING_MARKER = "."


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_of(col) -> Column:
    """First day of the month as DATE."""
    return F.trunc(_c(col), "MM")


def parse_value(col) -> Column:
    """Landing text to DOUBLE: the missing marker '.' is NULL, bad text is NULL."""
    c = _c(col)
    return (F.when(c == F.lit(MISSING_MARKER), F.lit(None).cast("double"))
             .when(c.rlike(_NUMBER), c.try_cast("double")))


def is_bad_value(col) -> Column:
    """True for text that is neither the missing marker nor a number; an absent (NULL) value is bad too."""
    c = _c(col)
    return c.isNull() | ((c != F.lit(MISSING_MARKER)) & ~c.rlike(_NUMBER))


def surrogate_key(*cols) -> Column:
    """md5 over the '-'-joined text of the columns, NULL spelled as a sentinel."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("_null_")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def time_window(keys, order: str = "observation_month") -> WindowSpec:
    """Row window per entity ordered by time (no keys: one global order)."""
    return Window.partitionBy(*keys).orderBy(F.col(order).asc())


def lag_diff(col, n: int, w: WindowSpec) -> Column:
    """Difference to the value n rows back (positional, not calendar)."""
    c = _c(col)
    return c - F.lag(c, n).over(w)


def pct_change(col, n: int, scale: float, w: WindowSpec, digits: int = 2) -> Column:
    """round((x - lag_n) / nullif(lag_n, 0) * scale, digits); zero base gives NULL."""
    c = _c(col)
    base = F.lag(c, n).over(w)
    return F.round((c - base) / F.nullif(base, F.lit(0.0)) * F.lit(scale), digits)


_ROLLING = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum}


def rolling(col, fn: str, n: int, w: WindowSpec) -> Column:
    """Aggregate over the current row and the n-1 rows before it (no minimum count)."""
    return _ROLLING[fn](_c(col)).over(w.rowsBetween(-(n - 1), Window.currentRow))


def flag(cond: Column) -> Column:
    """0/1 flag; an unknown (NULL) condition counts as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def status_label(col) -> Column:
    """Flag to status text: NULL first, then Active / Inactive."""
    c = _c(col)
    return (F.when(c.isNull(), F.lit("No Data"))
             .when(c == 1, F.lit("Active"))
             .otherwise(F.lit("Inactive")))


def truncate_text(col, n: int = 2000) -> Column:
    return F.substring(_c(col), 1, n)
