"""Newest row and best k rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[Column | str]


def _newest_first(order: Order) -> list[Column]:
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]


def top_per_key(df: DataFrame, keys: Sequence[str], order: Order, k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each key. String entries of `order` sort descending.

    The rank filter becomes a group limit on the map side, so a hot key sends at most k rows per task
    through the shuffle. End `order` with a unique column to make ties stable.
    """
    window = Window.partitionBy(*keys).orderBy(*_newest_first(order))
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """The newest row of each key; a NULL in the leading order column loses against any value."""
    return top_per_key(df, keys, order, 1, rank="_newest").drop("_newest")


def latest_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Newest values per key as an aggregate; unlike a window it also runs on a stream."""
    newest = F.max_by(F.struct(*values), F.struct(*order)).alias("_v")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])
