"""Deciding whether a side of a join may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# An entity row is a few hundred bytes, so this bounds a broadcast to some tens of MB.
BROADCAST_ROWS = 100_000


def is_small(basis: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether the frame has at most max_rows rows. Reads no more rows than that."""
    return basis.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(side: DataFrame, small: bool) -> DataFrame:
    """Hint only what was measured; otherwise leave the join to Catalyst and AQE, which
    splits skewed partitions of the large side."""
    return F.broadcast(side) if small else side


# A task that sorts so many narrow rows takes some 100 MB of memory.
ROWS_PER_TASK = 500_000


def tasks_for(rows: DataFrame) -> int:
    """How many tasks share the rows so that what one task holds does not grow with the table. The
    number of shuffle partitions in the session is fixed, and AQE only joins partitions."""
    busy = rows.sparkSession.sparkContext.defaultParallelism
    return max(busy, -(-rows.count() // ROWS_PER_TASK))
