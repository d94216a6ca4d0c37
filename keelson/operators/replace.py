"""Delete and replace without a transactional table: the surviving rows are a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not true; rows where it is NULL stay."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


#: Up to so many values of the replace key are sent to every task.
FEW = 100_000


def replace_by(existing: DataFrame, incoming: DataFrame, by: str) -> DataFrame:
    """Rows of ``existing`` whose ``by`` value does not occur in ``incoming``, and all of
    ``incoming``. Repeating it changes nothing.

    The distinct values (file names) are counted first. Few of them go to every task, and ``existing`` stays where it
    is: dealt out by the value, all rows of a file would go to one task, as there are fewer files than tasks. More
    than ``FEW`` spread the rows themselves, and are joined by a shuffle."""
    arrived = incoming.select(by).distinct()
    if arrived.limit(FEW + 1).count() <= FEW:
        arrived = F.broadcast(arrived)
    return existing.join(arrived, by, "left_anti").select(existing.columns).unionByName(incoming)
