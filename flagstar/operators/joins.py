"""Join helpers: a broadcast that is only taken behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension of a known size (in rows) that gets a broadcast hint.
DEFAULT_BROADCAST_ROWS = 500_000


def bounded_broadcast(
    df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, known_rows: int | None = None
) -> DataFrame:
    """``broadcast(df)`` where ``known_rows`` (a size known by construction, as
    of a generated calendar, or counted by the caller) is at most ``max_rows``;
    else ``df`` as it is.

    No job runs here: for tables whose size is not known,
    Spark's byte threshold and AQE decide from file and shuffle sizes.
    """
    if max_rows <= 0 or known_rows is None or known_rows > max_rows:
        return df
    return F.broadcast(df)
