"""Joining a per-group side table onto telemetry with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetsight.session import cut_lineage

# A per-group statistics row is ~200 bytes; 200k groups stay far below executor memory.
MAX_BROADCAST_ROWS = 200_000


def materialize_small(side: DataFrame) -> tuple[DataFrame, int]:
    """Checkpoint a small side table (reliably, in the shared folder) and return its row count."""
    side = cut_lineage(side)
    return side, side.count()


def join_side_table(
    big: DataFrame,
    side: DataFrame,
    on: list[str] | str,
    how: str = "left",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    side_rows: int | None = None,
) -> DataFrame:
    """Join ``side`` onto ``big``; broadcast only when its measured size is under the bound.

    ``side_rows`` is the known row count of an already materialised side (e.g. statistics
    prepared once at stream start). Without it no job runs here and the plan decides: AQE
    broadcasts a side that turns out small. Beyond the bound the join is an ordinary shuffle join
    and AQE's skew handling splits hot keys of the big side, so a group holding a third of all
    rows never lands in one task.
    """
    if side_rows is not None and side_rows <= max_broadcast_rows:
        side = F.broadcast(side)
    return big.join(side, on=on, how=how)
