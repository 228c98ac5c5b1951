"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lookup sides above this many rows are joined by shuffle instead of broadcast.
DEFAULT_BROADCAST_MAX_ROWS = 200_000


def fits(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, known_rows: int | None = None) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows.

    ``known_rows`` is an upper bound proven by construction (e.g. a calendar
    generated for a known date span); without one, a ``limit(max_rows + 1).count()``
    job decides, reading at most max_rows + 1 rows and returning one number.
    """
    if known_rows is not None:
        return known_rows <= max_rows
    return df.limit(max_rows + 1).count() <= max_rows


def sized_broadcast(
    df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, known_rows: int | None = None, decided: bool | None = None
) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` has at most ``max_rows`` rows, else ``df`` unchanged.

    ``decided`` passes a verdict already reached for a superset of ``df`` (a
    projection or distinct of a checked table is no larger). Beyond the bound
    the planner keeps a shuffle join (AQE can still demote it to broadcast from
    runtime statistics, and splits skewed partitions).
    """
    ok = decided if decided is not None else fits(df, max_rows, known_rows)
    return F.broadcast(df) if ok else df
