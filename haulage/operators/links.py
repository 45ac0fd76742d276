"""Loads and the orders they carry, kept as a JSON list of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_load_links(loads: DataFrame, ids: str = "pedidos_json", extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per (id_carga, id_pedido). An unreadable or empty list gives no row."""
    listed = F.from_json(F.col(ids), "array<bigint>")
    return loads.select("id_carga", *extra, F.explode(listed).alias("id_pedido")).filter("id_pedido IS NOT NULL")


def id_list(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """The inverse: sorted ids of each key as JSON text. Only for keys that own few values by nature."""
    return df.groupBy(key).agg(F.to_json(F.sort_array(F.collect_list(value))).alias(out))
