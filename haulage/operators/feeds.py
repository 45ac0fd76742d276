"""One table from two feeds that tell of the same things."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOTH = "ambas"


def merged(first: DataFrame, second: DataFrame, key: str, columns: Sequence[str], names: tuple[str, str]) -> DataFrame:
    """(key, columns, fonte, presente): one row per key of either feed. Each feed has a key once; NULL keys are not merged, but kept.

    Where both have a key, the row of `first` counts whole (`fonte` names the feed it is from, `presente` the feeds that have it): values
    of two feeds are never mixed in one row.
    """
    one = first.select(F.col(key).alias("_k1"), F.struct(*columns).alias("_one"))
    two = second.select(F.col(key).alias("_k2"), F.struct(*columns).alias("_two"))
    joined = one.join(two, F.col("_k1") == F.col("_k2"), "full")
    chosen = F.coalesce("_one", "_two").alias("_row")
    present = F.when(F.col("_one").isNull(), names[1]).when(F.col("_two").isNull(), names[0]).otherwise(BOTH)
    source = F.when(F.col("_one").isNull(), names[1]).otherwise(names[0])
    picked = joined.select(F.coalesce("_k1", "_k2").alias(key), chosen, source.alias("fonte"), present.alias("presente"))
    return picked.select(key, *[F.col(f"_row.{c}").alias(c) for c in columns], "fonte", "presente")


def reconciled(first: DataFrame, second: DataFrame, key: str, columns: Sequence[str], names: tuple[str, str]) -> DataFrame:
    """(situacao, chaves): keys in one feed only, in both alike, and in both with other values; one pass over the joined feeds."""
    one = first.select(F.col(key).alias("_k1"), F.struct(*columns).alias("_one"))
    two = second.select(F.col(key).alias("_k2"), F.struct(*columns).alias("_two"))
    joined = one.join(two, F.col("_k1") == F.col("_k2"), "full")
    state = (
        F.when(F.col("_one").isNull(), f"só {names[1]}")
        .when(F.col("_two").isNull(), f"só {names[0]}")
        .when(F.col("_one").eqNullSafe(F.col("_two")), "iguais")
        .otherwise("divergentes")
    )
    return joined.groupBy(state.alias("situacao")).agg(F.count(F.lit(1)).alias("chaves"))
