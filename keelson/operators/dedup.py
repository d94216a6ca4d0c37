"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: str | Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the greatest ``order_by`` per key; ``tie_break`` (default: every other
    column) makes the survivor the same on every run.

    Spark limits each group to one row before the shuffle as well as after it, so a key that
    holds a third of the table sends one row per map task, not its whole group, to one reducer.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c not in order]
    newest_first = [F.col(c).desc_nulls_last() for c in [*order, *tie_break]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
