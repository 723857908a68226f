"""Join helpers: broadcast only a side whose size has been checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows above which a "small" side is not broadcast (shuffle join + AQE skew split instead).
# Meant for narrow per-series rows (a key and a few values, some 50 bytes); give ``max_rows``
# for wider ones. Results do not depend on it.
MAX_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows, so call it on frames that
    are cheap to produce (a configuration dim, a checkpointed per-series
    table). Above the bound the frame is returned as is and Spark plans a
    shuffle join, where AQE splits skewed partitions.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
