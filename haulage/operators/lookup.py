"""Lookups joined to large tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of a lookup that still go to every executor.
BROADCAST_BYTES = 64 << 20
_FIXED = 16  # bytes that a value takes beside the characters of a text


def bounded(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether the measured size of `df` is at most `most` bytes. Rows and characters are summed in each task first, so one row per task
    is exchanged."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema if f.dataType.typeName() not in _PLAIN]
    width = sum(texts, F.lit(_FIXED * (len(df.columns) + 1)))
    return (df.agg(F.sum(width.cast("long"))).head()[0] or 0) <= most


def sized(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """`df`, marked for broadcast when its measured size is at most `most` bytes, else as it is.

    The size estimate of a lookup that is itself a join or an aggregate is far too high, and the large
    side would be shuffled by the lookup key, hot keys included. Beyond the limit the join is a shuffled one, whose hot
    keys are split at run time.
    """
    return F.broadcast(df) if bounded(df, most) else df


_PLAIN = {"boolean", "byte", "short", "integer", "long", "float", "double", "date", "timestamp", "timestamp_ntz"}
