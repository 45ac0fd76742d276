"""Estimated positions of a load along its way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.functions import columns as c
from haulage.operators.skew import ROWS_PER_TASK, number_within


def interpolated(events: DataFrame, ends: DataFrame, order: list[str], most: int = ROWS_PER_TASK) -> DataFrame:
    """Place event i of n of a load at (i-1)/(n-1) of the way; a single event stays at the origin.

    `ends` has id_carga and the coordinates of both ends (lat_origem, …). Events are numbered without
    collecting a load of over `most` events in one task, since one load may own a large share of them.
    """
    numbered = number_within(events.filter("id_carga IS NOT NULL"), ["id_carga"], order, "indice", "total", most)
    share = (F.col("indice") - 1).cast("double") / F.greatest(F.col("total") - 1, F.lit(1)).cast("double")
    return (
        numbered.join(ends, "id_carga", "left")
        .withColumn("fracao", share)
        .withColumn("lat_estimada", c.between("lat_origem", "lat_destino", "fracao"))
        .withColumn("long_estimada", c.between("long_origem", "long_destino", "fracao"))
    )
