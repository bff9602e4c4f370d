"""Join helper: a broadcast hint only behind a proven bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most rows that are hinted.  Reference tables hold one row per name; at a
# kilobyte each this many stay within Spark's own 10 MB broadcast threshold.
MAX_HINTED_ROWS = 10_000


def broadcast_if_small(dim: DataFrame, known_rows: int | None = None,
                       max_rows: int = MAX_HINTED_ROWS) -> DataFrame:
    """``dim`` with a broadcast hint iff ``known_rows``, an upper bound that
    the caller holds, is at most ``max_rows``.

    Without a bound there is no hint and no job: Spark compares the side's
    size in bytes with ``spark.sql.autoBroadcastJoinThreshold`` from file
    statistics, and again from the measured shuffle output (AQE).  Either
    way only the join's type depends on the size, never its result.
    """
    return F.broadcast(dim) if known_rows is not None and known_rows <= max_rows else dim


__all__ = ["broadcast_if_small", "MAX_HINTED_ROWS"]
