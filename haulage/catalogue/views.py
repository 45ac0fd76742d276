"""The view layer and its standing questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.catalogue.shared import eavg, esum, half_up, oracle, plain
from haulage.catalogue.status import order_status
from haulage.plans import gold, questions, views
from haulage.sources import star_schema as star


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.delivery_map(
        star.silver_orders(spark, sf_dir), order_status(spark, sf_dir), star.customers(spark, sf_dir)
    )


def _performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.driver_performance(
        star.drivers(spark, sf_dir), star.loads(spark, sf_dir), star.silver_orders(spark, sf_dir)
    )


def delivery_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_mapped(spark, sf_dir))


def kpi_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        views.kpi_row(star.silver_orders(spark, sf_dir), order_status(spark, sf_dir), star.loads(spark, sf_dir))
    )


def daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(views.daily_volume(star.silver_orders(spark, sf_dir)))


def totals_of_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that came twice count once on the map, in the figures, by day and by route alike."""
    once = star.silver_orders(spark, sf_dir)
    twice = gold.one_per_order(once.unionByName(once))
    mapped = views.delivery_map(twice, order_status(spark, sf_dir), star.customers(spark, sf_dir))
    totals = {
        "mapa": mapped.agg(F.count(F.lit(1)).alias("pedidos")),
        "indicadores": views.kpi_row(twice, order_status(spark, sf_dir), star.loads(spark, sf_dir)).select(F.col("total_pedidos").alias("pedidos")),
        "dias": views.daily_volume(twice).agg(F.sum("total_pedidos").alias("pedidos")),
        "rotas": gold.route_volume(twice).agg(F.sum("total_pedidos").alias("pedidos")),
    }
    return plain(reduce(DataFrame.unionByName, [f.select(F.lit(name).alias("onde"), "pedidos") for name, f in totals.items()]))


def volume_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(views.volume_by_state(_mapped(spark, sf_dir)))


def driver_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_performance(spark, sf_dir))


def q_state_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(questions.state_volume(_mapped(spark, sf_dir)))


def q_top10_freight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(questions.routes_by_freight(gold.route_volume(star.silver_orders(spark, sf_dir))))


def q_delivery_rate_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(questions.delivery_rate(star.silver_orders(spark, sf_dir), order_status(spark, sf_dir)))


def q_best_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(questions.best_rated(_performance(spark, sf_dir)))


def q_pending_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(questions.pending_map(_mapped(spark, sf_dir)))


def q_avg_weight_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(questions.mean_weight_by_route(star.silver_orders(spark, sf_dir)))


def q_open_express(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(questions.open_express(_mapped(spark, sf_dir)))


def q_avg_freight_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(questions.mean_freight_by_state(_mapped(spark, sf_dir)))


def q_top5_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(questions.busiest_drivers(_performance(spark, sf_dir)))


def q_daily_last_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(questions.daily_last_week(views.daily_volume(star.silver_orders(spark, sf_dir))))


QUERIES = {
    f.__name__: f
    for f in (
        delivery_map, kpi_row, daily_volume, volume_by_state, driver_performance, q_state_volume, q_top10_freight,
        q_delivery_rate_7d, q_best_rated, q_pending_map, q_avg_weight_route, q_open_express, q_avg_freight_state,
        q_top5_drivers, q_daily_last_week, totals_of_replays,
    )
}

_OPEN = "(id_status IS NULL OR id_status NOT IN (12, 13, 14))"

ORACLE = {
    "totals_of_replays": oracle("SELECT onde, pedidos FROM (SELECT COUNT(*) AS pedidos FROM silver), UNNEST(['mapa', 'indicadores', 'dias', 'rotas']) AS t(onde)"),
    "delivery_map": oracle("SELECT * EXCLUDE (id_status) FROM mapa"),
    "kpi_row": oracle(
        f"""SELECT COUNT(DISTINCT id_pedido) AS total_pedidos,
        COUNT(DISTINCT CASE WHEN id_status = 12 THEN id_pedido END) AS total_entregas_realizadas,
        COUNT(DISTINCT CASE WHEN id_status = 9 THEN id_pedido END) AS total_em_transito,
        {half_up('(CAST(COUNT(DISTINCT CASE WHEN id_status = 12 THEN id_pedido END) AS DOUBLE) * 100 / COUNT(DISTINCT id_pedido))', 1)}
            AS taxa_entrega_pct,
        {half_up(esum('peso_total_kg'), 2)} AS peso_total_transportado,
        {half_up(esum('valor_frete'), 2)} AS valor_frete_total, {half_up(eavg('valor_frete'), 2)} AS frete_medio,
        (SELECT COUNT(DISTINCT placa) FROM cargas) AS total_caminhoes_ativos FROM mapa"""
    ),
    "daily_volume": oracle("SELECT * FROM diario"),
    "volume_by_state": oracle(
        f"SELECT uf_destino, COUNT(*) AS total_pedidos, {esum('peso_total_kg')} AS peso_total FROM mapa GROUP BY 1"
    ),
    "driver_performance": oracle("SELECT * FROM desempenho"),
    "q_state_volume": oracle("SELECT uf_destino, COUNT(*) AS total_pedidos FROM mapa GROUP BY 1"),
    "q_top10_freight": oracle(
        """SELECT cidade_origem || ' -> ' || cidade_destino AS rota, total_pedidos, valor_frete_total FROM rotas
        ORDER BY valor_frete_total DESC, rota, uf_origem, uf_destino LIMIT 10"""
    ),
    "q_delivery_rate_7d": oracle(
        f"""SELECT COUNT(*) AS total_pedidos, COUNT(*) FILTER (id_status = 12) AS entregues,
        {half_up('(CAST(COUNT(*) FILTER (id_status = 12) AS DOUBLE) * 100 / NULLIF(COUNT(*), 0))', 1)} AS taxa_entrega_pct
        FROM silver s LEFT JOIN pedido_status e ON s.id_pedido = e.id_pedido
        WHERE CAST(data_pedido AS DATE) > (SELECT CAST(MAX(data_pedido) AS DATE) - INTERVAL 7 DAY FROM silver)"""
    ),
    "q_best_rated": oracle(
        """SELECT id_motorista, nome_motorista, avaliacao_media, total_entregas FROM desempenho
        ORDER BY avaliacao_media DESC, total_entregas DESC, id_motorista LIMIT 10"""
    ),
    "q_pending_map": oracle(
        f"""SELECT id_pedido, cidade_destino, uf_destino, lat_destino, long_destino, status_atual FROM mapa
        WHERE {_OPEN} AND lat_destino IS NOT NULL"""
    ),
    "q_avg_weight_route": oracle(
        f"""SELECT cidade_origem || ' -> ' || cidade_destino AS rota, {eavg('peso_total_kg')} AS peso_medio_kg
        FROM silver GROUP BY 1"""
    ),
    "q_open_express": oracle(
        f"SELECT COUNT(*) AS pedidos_expressos_abertos FROM mapa WHERE prioridade = 'Expressa' AND {_OPEN}"
    ),
    "q_avg_freight_state": oracle(f"SELECT uf_destino, {eavg('valor_frete')} AS frete_medio FROM mapa GROUP BY 1"),
    "q_top5_drivers": oracle(
        """SELECT id_motorista, nome_motorista, total_entregas FROM desempenho
        ORDER BY total_entregas DESC, id_motorista LIMIT 5"""
    ),
    "q_daily_last_week": oracle(
        """SELECT * FROM diario WHERE CAST(data AS DATE) > (SELECT CAST(MAX(data) AS DATE) - INTERVAL 7 DAY FROM diario)"""
    ),
}
