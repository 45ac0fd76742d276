"""Distances, empty trucks, pending orders and matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.catalogue.shared import half_up, km, oracle, plain
from haulage.catalogue.status import events, order_status
from haulage.functions.geo import haversine_rounded, register_haversine
from haulage.operators.distance import pairs_within
from haulage.plans import dispatch, views
from haulage.sources import star_schema as star

# Fixed parameters of the surprise order.
SURPRISE = {"weight_kg": 5000.0, "volume_m3": 12.0, "latitude": -22.9099, "longitude": -47.0626}


def _free(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dispatch.free_trucks(events(spark, sf_dir), star.loads(spark, sf_dir), star.trucks(spark, sf_dir))


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dispatch.pending_orders(
        star.silver_orders(spark, sf_dir), order_status(spark, sf_dir), star.customers(spark, sf_dir)
    )


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dispatch.last_position(events(spark, sf_dir), star.loads(spark, sf_dir))


def _recommended(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = dispatch.pickup_points(star.customers(spark, sf_dir))
    return dispatch.recommend(_pending(spark, sf_dir), _free(spark, sf_dir), points)


def _customer_depot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star.silver_orders(spark, sf_dir).select("id_pedido", "id_cliente", "cidade_origem", "uf_origem")
    people = star.customers(spark, sf_dir)
    placed = views.locate(orders, views.city_centroids(people), "cidade_origem", "uf_origem", "lat1", "lon1")
    homes = people.select("id_cliente", F.col("latitude").alias("lat2"), F.col("longitude").alias("lon2"))
    return placed.join(homes, "id_cliente", "left")


def haversine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance from the pick-up city to the customer, for every order."""
    pairs = _customer_depot(spark, sf_dir)
    return plain(pairs.select("id_pedido", haversine_rounded("lat1", "lon1", "lat2", "lon2").alias("distancia_km")))


def haversine_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the SQL function."""
    register_haversine(spark)
    rounded = F.expr("floor(haversine(lat1, lon1, lat2, lon2) * 1000D + 0.5D)").cast("double") / F.lit(1000.0)
    return plain(_customer_depot(spark, sf_dir).select("id_pedido", rounded.alias("distancia_km")))


def distance_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trucks and cities at most 200 km apart."""
    cities = views.city_centroids(star.customers(spark, sf_dir)).select(
        F.col("cidade_chave").alias("cidade"), F.col("latitude").alias("lat_c"), F.col("longitude").alias("lon_c")
    )
    seen = _positions(spark, sf_dir).select("id_caminhao", "latitude", "longitude")
    near = pairs_within(seen, cities, 200.0, ("latitude", "longitude"), ("lat_c", "lon_c"), ["id_caminhao"])
    return plain(near.select("id_caminhao", "cidade", "distancia_km"))


def free_trucks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_free(spark, sf_dir))


def pending_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_pending(spark, sf_dir))


def match_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(dispatch.saved_form(_recommended(spark, sf_dir)))


def rank_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(dispatch.matches_by_rank(_recommended(spark, sf_dir)))


def distance_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(dispatch.distance_histogram(_recommended(spark, sf_dir)))


def nearest5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        dispatch.nearest_for(
            star.trucks(spark, sf_dir), star.drivers(spark, sf_dir), _positions(spark, sf_dir), **SURPRISE
        )
    )


def fleet_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        dispatch.fleet_position(_positions(spark, sf_dir), star.trucks(spark, sf_dir), star.customers(spark, sf_dir))
    )


QUERIES = {
    f.__name__: f
    for f in (
        haversine_pairs, haversine_sql, distance_join, free_trucks, pending_orders, match_top3, rank_counts,
        distance_histogram, nearest5, fleet_position,
    )
}

_HAVERSINE = oracle(
    f"""SELECT s.id_pedido, {half_up(km('o.latitude', 'o.longitude', 'c.latitude', 'c.longitude'), 3)} AS distancia_km
    FROM silver s LEFT JOIN centros o ON s.cidade_origem = o.cidade AND s.uf_origem = o.uf
    LEFT JOIN clientes c ON s.id_cliente = c.id_cliente"""
)
_TO_TRUCK = km("p.latitude", "p.longitude", "CAST(-22.9099 AS DOUBLE)", "CAST(-47.0626 AS DOUBLE)")
_TO_CITY = km("p.latitude", "p.longitude", "c.latitude", "c.longitude")

ORACLE = {
    "haversine_pairs": _HAVERSINE,
    "haversine_sql": _HAVERSINE,
    "distance_join": oracle(
        f"""SELECT p.id_caminhao, c.cidade, {half_up(_TO_CITY, 3)} AS distancia_km
        FROM posicoes p CROSS JOIN centros c WHERE {_TO_CITY} <= 200"""
    ),
    "free_trucks": oracle("SELECT * FROM livres"),
    "pending_orders": oracle("SELECT * FROM pendentes"),
    "match_top3": oracle(
        """SELECT id_pedido, id_caminhao, placa, distancia_km, capacidade_toneladas, peso_total_kg, rank, cidade_atual,
        cidade_origem FROM combinados"""
    ),
    "rank_counts": oracle("SELECT rank, COUNT(*) AS total FROM combinados GROUP BY 1"),
    "distance_histogram": oracle(
        """SELECT faixa, COUNT(*) AS total, CAST(faixa - 1 AS DOUBLE) * 200 / 30 AS km_de FROM
        (SELECT CAST(LEAST(FLOOR(distancia_km * 30 / 200) + 1, 30) AS BIGINT) AS faixa FROM combinados) GROUP BY 1"""
    ),
    "nearest5": oracle(
        f"""SELECT t.id_caminhao, t.placa, t.tipo, t.capacidade_toneladas, t.volume_m3 AS capacidade_volume_m3,
        m.nome AS motorista, m.celular, p.latitude AS lat_caminhao, p.longitude AS lon_caminhao,
        {half_up(_TO_TRUCK, 3)} AS distancia_km FROM caminhoes t JOIN motoristas m ON t.id_caminhao = m.id_caminhao
        JOIN posicoes p ON p.id_caminhao = t.id_caminhao
        WHERE m.status = 'Ativo' AND t.capacidade_toneladas * 1000 >= 5000 AND t.volume_m3 >= 12
        ORDER BY distancia_km, t.id_caminhao LIMIT 5"""
    ),
    "fleet_position": oracle(
        f"""SELECT p.id_caminhao, p.latitude, p.longitude, {half_up(_TO_CITY, 3)} AS distancia_km,
        CASE WHEN p.id_status = 12 THEN t.capacidade_toneladas * CAST(1000 AS DOUBLE)
        ELSE GREATEST(t.capacidade_toneladas * CAST(1000 AS DOUBLE) - COALESCE(p.peso_carga_kg, 0), 0) END AS capacidade_livre
        FROM posicoes p JOIN caminhoes t ON p.id_caminhao = t.id_caminhao
        LEFT JOIN centros c ON p.cidade_destino = c.cidade AND p.uf_destino = c.uf"""
    ),
}
