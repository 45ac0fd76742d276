"""Status events: newest per load, truck and order; summary; estimated positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haulage.catalogue.shared import oracle, plain
from haulage.operators.latest import latest_fold
from haulage.operators.positions import interpolated
from haulage.plans import dispatch, gold, views
from haulage.sources import schemas
from haulage.sources import star_schema as star
from haulage.streaming import silver


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status events after the silver step."""
    raw = star.status_events(spark, sf_dir)
    return silver.status(raw, schemas.status_reference(spark), metrics=None)


def order_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.order_status(events(spark, sf_dir), star.load_lists(spark, sf_dir))


def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = gold.latest_status(events(spark, sf_dir))
    return plain(newest.select("id_carga", "id_status", "descricao_status", "timestamp", "latitude", "longitude"))


def latest_status_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["timestamp", "id_status", "latitude", "longitude"]
    values = ["id_status", "descricao_status", "timestamp", "latitude", "longitude"]
    return plain(latest_fold(events(spark, sf_dir), ["id_carga"], order, values))


def latest_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from haulage.functions.columns import or_no_status

    orders = star.silver_orders(spark, sf_dir).select("id_pedido")
    joined = orders.join(order_status(spark, sf_dir), "id_pedido", "left")
    return plain(joined.select("id_pedido", "id_carga", or_no_status("descricao_status").alias("status_atual"), "timestamp"))


def last_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dispatch.last_position(events(spark, sf_dir), star.loads(spark, sf_dir))
    return plain(found.select("id_caminhao", "id_carga", "id_status", "timestamp", "latitude", "longitude"))


def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(gold.status_summary(events(spark, sf_dir)).orderBy("ordem"))


def status_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(views.status_share(gold.status_summary(events(spark, sf_dir))))


def interpolated_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of every load, placed between the cities of its load."""
    centroids = views.city_centroids(star.customers(spark, sf_dir))
    ways = star.loads(spark, sf_dir).select("id_carga", "cidade_origem", "uf_origem", "cidade_destino", "uf_destino")
    ways = views.locate(ways, centroids, "cidade_origem", "uf_origem", "lat_origem", "long_origem")
    ways = views.locate(ways, centroids, "cidade_destino", "uf_destino", "lat_destino", "long_destino")
    ends = ways.select("id_carga", "lat_origem", "long_origem", "lat_destino", "long_destino")
    raw = star.status_events(spark, sf_dir).select("id_carga", "timestamp", "id_movimento")
    placed = interpolated(raw, ends, ["timestamp", "id_movimento"])
    return plain(placed.select("id_movimento", "id_carga", "indice", "total", "lat_estimada", "long_estimada"))


QUERIES = {
    f.__name__: f
    for f in (
        latest_status, latest_status_fold, latest_per_order, last_position, status_summary, status_share,
        interpolated_positions,
    )
}

_LATEST = oracle("SELECT id_carga, id_status, descricao_status, timestamp, latitude, longitude FROM ultimo_evento")

ORACLE = {
    "latest_status": _LATEST,
    "latest_status_fold": _LATEST,
    "latest_per_order": oracle(
        """SELECT s.id_pedido, e.id_carga, COALESCE(e.descricao_status, 'Sem Status') AS status_atual, e.timestamp
        FROM silver s LEFT JOIN pedido_status e ON s.id_pedido = e.id_pedido"""
    ),
    "last_position": oracle("SELECT id_caminhao, id_carga, id_status, timestamp, latitude, longitude FROM posicoes"),
    "status_summary": oracle("SELECT * FROM resumo_status"),
    "status_share": oracle(
        "SELECT descricao_status, CAST(SUM(total_cargas) AS BIGINT) AS total FROM resumo_status GROUP BY 1"
    ),
    "interpolated_positions": oracle(
        """SELECT id_movimento, id_carga, indice, total, olat + f * (dlat - olat) AS lat_estimada,
        olon + f * (dlon - olon) AS long_estimada FROM (SELECT e.*, o.latitude AS olat, o.longitude AS olon,
        d.latitude AS dlat, d.longitude AS dlon, CAST(indice - 1 AS DOUBLE) / GREATEST(total - 1, 1) AS f
        FROM (SELECT id_carga, id_movimento, ROW_NUMBER() OVER (PARTITION BY id_carga ORDER BY timestamp, id_movimento) AS indice,
              COUNT(*) OVER (PARTITION BY id_carga) AS total FROM eventos) e
        LEFT JOIN cargas w ON e.id_carga = w.id_carga
        LEFT JOIN centros o ON w.cidade_origem = o.cidade AND w.uf_origem = o.uf
        LEFT JOIN centros d ON w.cidade_destino = d.cidade AND w.uf_destino = d.uf)"""
    ),
}
