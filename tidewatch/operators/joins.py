"""Join helpers that keep big record tables from being shuffled on skewed keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound on rows of a side we are willing to broadcast.  Topic-, source-
# and config-level tables sit far below it; anything above falls back to a
# shuffle join that AQE may still split when a key is skewed.
MAX_BROADCAST_ROWS = 200_000


def checked_broadcast(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``small`` only after proving it has at most ``max_rows`` rows.

    The side is checkpointed first (written to the shared checkpoint folder)
    so the size check and the join share one computation and the lineage of
    the big upstream aggregate is cut.  Above the bound the frame is returned
    un-hinted and the join becomes a shuffle join (with AQE skew handling).
    """
    small = small.checkpoint(eager=True)
    n = small.limit(max_rows + 1).count()
    if n <= max_rows:
        return F.broadcast(small)
    return small


def one_row(agg: DataFrame) -> DataFrame:
    """A global aggregate (no grouping keys) has exactly one row: safe to broadcast."""
    return F.broadcast(agg)
