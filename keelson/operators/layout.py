"""Physical layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clustered(
    df: DataFrame, cluster_by: Sequence[str], spread_by: Sequence[str] = (), files: int | None = None
) -> DataFrame:
    """The same rows, range-partitioned and sorted so that each file covers a narrow range of
    ``cluster_by`` and readers skip the rest by min/max statistics.

    Equal values cannot be split by a range, so a value that holds a third of the rows would
    end up in one task; ``spread_by`` (a key) splits it.
    """
    columns = [*cluster_by, *spread_by]
    ranged = (
        df.repartitionByRange(*columns) if files is None else df.repartitionByRange(files, *columns)
    )
    return ranged.sortWithinPartitions(*columns)


#: Rows of the sample that borders are taken from, and bits a column's rank may have.
SAMPLE_ROWS = 50_000
RANK_BITS = 8


def borders(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS, rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """For each column up to 2^bits - 1 values that cut its rows into about equal shares, from a
    bounded sample. A value that holds several shares is a border once."""
    total = df.count()
    share = min(1.0, rows / max(1, total))
    sample = df.select(*columns).sample(share, seed=11).limit(2 * rows).toPandas()
    found = {}
    for name in columns:
        values = sample[name].dropna().sort_values(ignore_index=True)
        cuts = [values[len(values) * i >> bits] for i in range(1, 1 << bits)] if len(values) else []
        found[name] = sorted(set(cuts))
    return found


def rank_of(name: str, cuts: Sequence) -> Column:
    """How many of the sorted ``cuts`` are not above the value: a search by halves, as one
    expression. NULL ranks with the least values."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(name) >= F.lit(cuts[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(cuts))


def interleave(ranks: Sequence[Column], bits: Sequence[int]) -> Column:
    """One number from the bits of all ranks in turn, the highest bits first."""
    out, place = F.lit(0).cast("long"), 0
    turns = [(bits[i] - 1 - level, i) for level in range(max(bits, default=0)) for i in range(len(ranks)) if level < bits[i]]
    for bit, i in reversed(turns):
        one = F.shiftright(ranks[i], bit).bitwiseAND(F.lit(1)).cast("long")
        out = out.bitwiseOR(F.shiftleft(one, place))
        place += 1
    return out


def interleaved(
    df: DataFrame, cluster_by: Sequence[str], spread_by: Sequence[str] = (), files: int | None = None, bits: int = RANK_BITS
) -> DataFrame:
    """The same rows, laid out so that files cover a narrow range of every column of
    ``cluster_by``, not of the first alone: a filter on any one of them skips files.

    Each value is replaced by its rank among the column's quantiles, so skewed values and columns of any
    type weigh alike; the bits of the ranks are interleaved, and rows are range-partitioned by that number.
    Ranks with fewer steps give up their bits to the others. Which rows are sampled for the quantiles changes the
    files, never the rows. ``spread_by`` splits places that hold many rows, as in ``clustered``.
    """
    cuts = borders(df, cluster_by, bits)
    used = [max(1, len(cuts[name]).bit_length()) for name in cluster_by]
    order = "_order"
    ranked = df.withColumn(order, interleave([rank_of(name, cuts[name]) for name in cluster_by], used))
    keys = [order, *spread_by]
    ranged = ranked.repartitionByRange(*keys) if files is None else ranked.repartitionByRange(files, *keys)
    return ranged.sortWithinPartitions(order, *cluster_by, *spread_by).drop(order)
