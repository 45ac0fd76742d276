"""The view layer: map, KPIs, daily volume, drivers, top routes and the dashboard datasets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.functions import columns as c
from haulage.operators.latest import latest_per_key
from haulage.operators.lookup import sized
from haulage.operators.links import order_load_links
from haulage.plans import gold
from haulage.sources import tables
from haulage.sources.schemas import DELIVERED, ON_THE_ROAD

TOP_ROUTES = 20
#: How long readers may go on with an old generation of a view.
KEEP = dt.timedelta(days=1)


def city_centroids(customers: DataFrame) -> DataFrame:
    """One point per city and state: the mean of its customers' coordinates.

    There are far fewer cities than customers, so the result is broadcast once its size is checked.
    """
    return sized(
        customers.groupBy(c.place_key("cidade").alias("cidade_chave"), F.upper("uf").alias("uf_chave"))
        .agg(
            c.exact_avg("latitude", 6).alias("latitude"),
            c.exact_avg("longitude", 6).alias("longitude"),
        )
        .filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    )


def locate(df: DataFrame, centroids: DataFrame, city: str, state: str, lat: str, lon: str) -> DataFrame:
    """Add the coordinates of a city column; NULL for a city without customers."""
    place = centroids.select(
        F.col("cidade_chave").alias("_c"), F.col("uf_chave").alias("_u"), F.col("latitude").alias(lat), F.col("longitude").alias(lon)
    )
    on = (c.place_key(city) == F.col("_c")) & (F.upper(state) == F.col("_u"))
    return df.join(place, on, "left").drop("_c", "_u")


def order_status(events: DataFrame, loads: DataFrame) -> DataFrame:
    """Current status of each order that is on a load with events; one row per order.

    Events shrink to one row per load before they meet the order list, so a busy load stays one row.
    """
    newest = gold.latest_status(events)
    on_load = order_load_links(loads).join(newest, "id_carga", "inner")
    return latest_per_key(on_load, ["id_pedido"], [*gold.newest_event_order(events), "id_carga"])


def _with_status(orders: DataFrame, status: DataFrame) -> DataFrame:
    current = status.select("id_pedido", "id_status", "descricao_status")
    return orders.join(current, "id_pedido", "left")


def delivery_map(orders: DataFrame, status: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order with both coordinates and its current status."""
    centroids = city_centroids(customers)
    named = orders
    if "cidade_cliente" not in orders.columns:
        who = customers.select("id_cliente", F.col("cidade").alias("cidade_cliente"))
        named = named.join(sized(who), "id_cliente", "left")
    placed = locate(named, centroids, "cidade_origem", "uf_origem", "lat_origem", "long_origem")
    placed = locate(placed, centroids, "cidade_destino", "uf_destino", "lat_destino", "long_destino")
    return _with_status(placed, status).select(
        "id_pedido",
        "cidade_origem",
        "uf_origem",
        "lat_origem",
        "long_origem",
        "cidade_destino",
        "uf_destino",
        "lat_destino",
        "long_destino",
        "cidade_cliente",
        "peso_total_kg",
        "valor_frete",
        "tipo_frete",
        "prioridade",
        c.or_no_status("descricao_status").alias("status_atual"),
    )


def kpi_row(orders: DataFrame, status: DataFrame, loads: DataFrame) -> DataFrame:
    """One row of operational figures, at order grain; active trucks are those with any load."""
    known = _with_status(orders, status)
    return (
        known.agg(
            F.count("id_pedido").alias("total_pedidos"),
            F.count_if(F.col("id_status") == DELIVERED).alias("total_entregas_realizadas"),
            F.count_if(F.col("id_status") == ON_THE_ROAD).alias("total_em_transito"),
            c.exact_sum("peso_total_kg").alias("_kg"),
            c.exact_sum("valor_frete").alias("_frete"),
            c.exact_avg("valor_frete").alias("_medio"),
        )
        .withColumn("total_caminhoes_ativos", loads.agg(F.count_distinct("placa")).scalar())
        .select(
            "total_pedidos",
            "total_entregas_realizadas",
            "total_em_transito",
            c.round_half_up(c.percent("total_entregas_realizadas", "total_pedidos"), 1).alias("taxa_entrega_pct"),
            c.round_half_up("_kg", 2).alias("peso_total_transportado"),
            c.round_half_up("_frete", 2).alias("valor_frete_total"),
            c.round_half_up("_medio", 2).alias("frete_medio"),
            "total_caminhoes_ativos",
        )
    )


def daily_volume(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.to_date("data_pedido").alias("data")).agg(
        F.count(F.lit(1)).alias("total_pedidos"),
        c.round_half_up(c.exact_sum("peso_total_kg"), 2).alias("peso_total"),
        c.round_half_up(c.exact_sum("valor_frete"), 2).alias("valor_total"),
        F.count_if(F.col("prioridade") == "Expressa").alias("pedidos_expressos"),
        F.count_if(F.col("prioridade") == "Urgente").alias("pedidos_urgentes"),
    )


def driver_performance(drivers: DataFrame, loads: DataFrame, orders: DataFrame) -> DataFrame:
    """Per driver: orders carried, km, own rating, freight. Km are summed per load, before orders fan out."""
    km = loads.groupBy("id_caminhao").agg(F.sum(F.col("km_total").cast("bigint")).alias("_km"))
    carried = order_load_links(loads, extra=("id_caminhao",)).select("id_caminhao", "id_pedido").distinct()
    freight = (
        carried.join(orders.select("id_pedido", "valor_frete"), "id_pedido", "left")
        .groupBy("id_caminhao")
        .agg(F.count(F.lit(1)).alias("_n"), c.exact_sum("valor_frete").alias("_frete"))
    )
    people = drivers.select("id_motorista", "nome", "cnh_categoria", "avaliacao", "id_caminhao")
    joined = people.join(km, "id_caminhao", "inner").join(freight, "id_caminhao", "left")
    return joined.select(
        "id_motorista",
        F.col("nome").alias("nome_motorista"),
        F.col("cnh_categoria").alias("categoria_cnh"),
        F.coalesce("_n", F.lit(0)).alias("total_entregas"),
        F.col("_km").cast("double").alias("total_km"),
        c.round_half_up("avaliacao", 2).alias("avaliacao_media"),
        c.round_half_up("_frete", 2).alias("valor_frete_total"),
        c.round_half_up(c.safe_ratio("_km", "_n"), 1).alias("km_medio_por_entrega"),
    )


def routes_named(route_volume: DataFrame) -> DataFrame:
    """Route aggregate with its key and the freight earned per kilogram."""
    return route_volume.select(
        c.route_key("cidade_origem", "cidade_destino").alias("rota"),
        "uf_origem",
        "uf_destino",
        "total_pedidos",
        F.col("peso_total").alias("peso_total_kg"),
        "valor_frete_total",
        "frete_medio",
        c.safe_ratio("valor_frete_total", "peso_total").alias("ticket_medio_kg"),
    )


def top_routes(route_volume: DataFrame, limit: int = TOP_ROUTES) -> DataFrame:
    return (
        routes_named(route_volume)
        .orderBy(F.desc("total_pedidos"), "rota", "uf_origem", "uf_destino")
        .limit(limit)
        .drop("uf_origem", "uf_destino")
    )


def volume_by_state(mapped: DataFrame) -> DataFrame:
    return mapped.groupBy("uf_destino").agg(
        F.count(F.lit(1)).alias("total_pedidos"), c.exact_sum("peso_total_kg").alias("peso_total")
    )


def status_share(summary: DataFrame) -> DataFrame:
    """Loads per status name; the summary holds one row per status, so its counts are added up."""
    return summary.groupBy("descricao_status").agg(F.sum("total_cargas").alias("total"))


# ---- persistent views -----------------------------------------------------------------------------

COMMENTS = {
    "vw_mapa_entregas": (
        "Pedidos com os pontos de coleta e de entrega no mapa e a situação atual; uma linha por pedido.",
        {
            "id_pedido": "Número do pedido",
            "cidade_origem": "Cidade da coleta",
            "uf_origem": "Estado da coleta",
            "lat_origem": "Latitude média dos clientes da cidade de coleta",
            "long_origem": "Longitude média dos clientes da cidade de coleta",
            "cidade_destino": "Cidade da entrega",
            "uf_destino": "Estado da entrega",
            "lat_destino": "Latitude média dos clientes da cidade de entrega",
            "long_destino": "Longitude média dos clientes da cidade de entrega",
            "cidade_cliente": "Cidade do cadastro do cliente, que pode ser outra que a da entrega",
            "peso_total_kg": "Peso do pedido em kg",
            "valor_frete": "Frete do pedido em reais",
            "tipo_frete": "CIF: paga o remetente; FOB: paga o destinatário",
            "prioridade": "Normal, Expressa ou Urgente",
            "status_atual": "Nome do último status da carga do pedido, ou Sem Status",
        },
    ),
    "vw_kpis_operacionais": (
        "Indicadores gerais em uma única linha, contados por pedido.",
        {
            "total_pedidos": "Pedidos distintos",
            "total_entregas_realizadas": "Pedidos cujo último status é Entrega Realizada",
            "total_em_transito": "Pedidos cujo último status é Em Trânsito",
            "taxa_entrega_pct": "Entregues por cem pedidos",
            "peso_total_transportado": "Soma dos pesos em kg",
            "valor_frete_total": "Soma dos fretes em reais",
            "frete_medio": "Frete médio por pedido em reais",
            "total_caminhoes_ativos": "Placas distintas com ao menos uma carga",
        },
    ),
    "vw_volume_diario": (
        "Pedidos por dia, com peso, frete e contagem por prioridade.",
        {
            "data": "Dia do pedido",
            "total_pedidos": "Pedidos do dia",
            "peso_total": "Peso do dia em kg",
            "valor_total": "Frete do dia em reais",
            "pedidos_expressos": "Pedidos com prioridade Expressa",
            "pedidos_urgentes": "Pedidos com prioridade Urgente",
        },
    ),
    "vw_performance_motoristas": (
        "Resultado por motorista: entregas, quilômetros, avaliação e frete.",
        {
            "id_motorista": "Número do motorista",
            "nome_motorista": "Nome do motorista; nomes podem se repetir",
            "categoria_cnh": "Categoria da habilitação",
            "total_entregas": "Pedidos distintos levados pelo caminhão do motorista",
            "total_km": "Quilômetros somados por carga",
            "avaliacao_media": "Nota do motorista, de 1 a 5",
            "valor_frete_total": "Soma dos fretes dos pedidos levados em reais",
            "km_medio_por_entrega": "Quilômetros por pedido levado",
        },
    ),
    "vw_rotas_mais_frequentes": (
        "As vinte rotas com mais pedidos.",
        {
            "rota": "Cidade de origem e de destino, separadas por uma seta",
            "total_pedidos": "Pedidos da rota",
            "peso_total_kg": "Soma dos pesos da rota em kg",
            "valor_frete_total": "Soma dos fretes da rota em reais",
            "frete_medio": "Frete médio por pedido da rota em reais",
            "ticket_medio_kg": "Frete por kg da rota em reais",
        },
    ),
}


def publish(spark: SparkSession, frames: dict[str, DataFrame], layer: str = "gold", keep: dt.timedelta = KEEP) -> list[str]:
    """A new generation of each view: see `tables.publish`. An empty frame is not published; generations older than `keep` go.

    The view is cheap to read however often a dashboard asks; the joins behind it run once per refresh.
    Keys of `frames` are view names from COMMENTS.
    """
    names = []
    for view, frame in frames.items():
        comment, columns = COMMENTS[view]
        tables.publish(frame, f"{layer}.{view}", comment, columns, check=_has_rows)
        tables.expire(spark, f"{layer}.{view}", keep)
        names.append(f"{layer}.{view}")
    return names


def _has_rows(written: DataFrame) -> None:
    if written.isEmpty():
        raise ValueError("a view without rows is not published")
