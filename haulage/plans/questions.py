"""Standing questions over the views. 'Last days' count back from the newest order, not from today."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.functions import columns as c
from haulage.plans import gold, views
from haulage.sources.schemas import CLOSED, DELIVERED, STATUS_NAMES

CLOSED_NAMES = tuple(STATUS_NAMES[i - 1] for i in CLOSED)


def is_open(status_name: str = "status_atual"):
    return ~F.col(status_name).isin(*CLOSED_NAMES)


def _last_days(df: DataFrame, day: str, days: int) -> DataFrame:
    newest = df.agg(F.max(day)).scalar()
    return df.filter(F.col(day) > F.date_sub(newest, days))


def state_volume(mapped: DataFrame) -> DataFrame:
    return views.volume_by_state(mapped).select("uf_destino", "total_pedidos")


def routes_by_freight(route_volume: DataFrame, limit: int = 10) -> DataFrame:
    return (
        views.routes_named(route_volume)
        .orderBy(F.desc("valor_frete_total"), "rota", "uf_origem", "uf_destino")
        .limit(limit)
        .select("rota", "total_pedidos", "valor_frete_total")
    )


def delivery_rate(orders: DataFrame, status: DataFrame, days: int = 7) -> DataFrame:
    dated = orders.select("id_pedido", F.to_date("data_pedido").alias("data"))
    recent = _last_days(dated, "data", days).join(status.select("id_pedido", "id_status"), "id_pedido", "left")
    counted = recent.agg(
        F.count(F.lit(1)).alias("total_pedidos"), F.count_if(F.col("id_status") == DELIVERED).alias("entregues")
    )
    rate = c.round_half_up(c.percent("entregues", "total_pedidos"), 1)
    return counted.withColumn("taxa_entrega_pct", rate)


def best_rated(performance: DataFrame, limit: int = 10) -> DataFrame:
    return (
        performance.orderBy(F.desc("avaliacao_media"), F.desc("total_entregas"), "id_motorista")
        .limit(limit)
        .select("id_motorista", "nome_motorista", "avaliacao_media", "total_entregas")
    )


def pending_map(mapped: DataFrame) -> DataFrame:
    shown = mapped.filter(is_open() & F.col("lat_destino").isNotNull())
    return shown.select("id_pedido", "cidade_destino", "uf_destino", "lat_destino", "long_destino", "status_atual")


def mean_weight_by_route(orders: DataFrame) -> DataFrame:
    by = c.route_key("cidade_origem", "cidade_destino").alias("rota")
    return orders.groupBy(by).agg(c.exact_avg("peso_total_kg").alias("peso_medio_kg"))


def open_express(mapped: DataFrame) -> DataFrame:
    wanted = (F.col("prioridade") == "Expressa") & is_open()
    return mapped.agg(F.count_if(wanted).alias("pedidos_expressos_abertos"))


def mean_freight_by_state(mapped: DataFrame) -> DataFrame:
    return mapped.groupBy("uf_destino").agg(c.exact_avg("valor_frete").alias("frete_medio"))


def busiest_drivers(performance: DataFrame, limit: int = 5) -> DataFrame:
    return (
        performance.orderBy(F.desc("total_entregas"), "id_motorista")
        .limit(limit)
        .select("id_motorista", "nome_motorista", "total_entregas")
    )


def daily_last_week(daily: DataFrame, days: int = 7) -> DataFrame:
    return _last_days(daily, "data", days)
