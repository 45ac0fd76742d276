"""Orders, items, routes, fleet and weekly features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.catalogue.shared import BOX, FREIGHT, eavg, esum, half_up, oracle, plain
from haulage.functions import columns as c
from haulage.operators import nesting, rollup
from haulage.plans import demand, gold, views
from haulage.sources import landing, schemas
from haulage.sources import star_schema as star
from haulage.session import scratch, short_lived_shuffles
from haulage.streaming import silver
from haulage.streaming.deltas import bucket


def route_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(gold.route_volume(star.silver_orders(spark, sf_dir)))


def top_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(views.top_routes(gold.route_volume(star.silver_orders(spark, sf_dir))))


def route_ticket(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = views.routes_named(gold.route_volume(star.silver_orders(spark, sf_dir)))
    return plain(named.select("rota", "ticket_medio_kg"))


def fleet_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(gold.fleet_performance(star.loads(spark, sf_dir), star.trucks(spark, sf_dir)))


def order_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = silver.enrich_orders(star.orders(spark, sf_dir), star.customers(spark, sf_dir))
    return plain(
        joined.select(
            "id_pedido", "id_cliente", "razao_social", "cnpj", "uf_cliente", "cidade_cliente", "data_pedido",
            "peso_total_kg", "valor_frete", "tipo_frete", "prioridade", "ano", "mes", "dia",
        )
    )


def order_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id_pedido"), F.col("o_orderdate").alias("data_pedido")
    )
    dated = c.with_moment(orders, "data_pedido").withColumns(c.calendar_parts("data_pedido"))
    return plain(dated.withColumn("data", F.to_date("data_pedido")).drop("data_pedido"))


def load_order_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    from haulage.operators.links import order_load_links

    return plain(order_load_links(star.load_lists(spark, sf_dir)))


def city_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(views.city_centroids(star.customers(spark, sf_dir)))


def driver_truck_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = star.drivers(spark, sf_dir).filter(F.col("status") == "Ativo")
    fleet = star.trucks(spark, sf_dir).select("id_caminhao", "placa", "tipo", "capacidade_toneladas")
    joined = active.join(fleet, "id_caminhao", "inner")
    return plain(joined.select("id_motorista", "nome", "celular", "id_caminhao", "placa", "tipo", "capacidade_toneladas"))


#: Parts in which nested orders are exported at most, and orders of a part while there are fewer.
PARTS, ORDERS_PER_PART = 8, 300_000


def _parts(spark: SparkSession, sf_dir: str) -> list[tuple[int, int]]:
    """(number, parts) of each part of the orders. Shuffles and scratch files of an export are those of one part; the number of parts is
    a power of two and does not grow with the tables."""
    orders = star.table(spark, sf_dir, "orders").count()
    parts = min(PARTS, 1 << (max(1, -(-orders // ORDERS_PER_PART)) - 1).bit_length())
    return [(k, parts) for k in range(parts)]


def _short(spark: SparkSession, sf_dir: str) -> bool:
    """Whether no order has more lines than any list of a document may hold. An invoice is a group of lines of an order, so there are no
    more of these. It is asked once for all parts."""
    lines = star.table(spark, sf_dir, "lineitem").where("l_orderkey IS NOT NULL").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"))
    return lines.where(F.col("_n") > min(nesting.ITEMS_PER_INVOICE, nesting.INVOICES_PER_DOCUMENT)).isEmpty()


def _nested(spark: SparkSession, sf_dir: str, part: tuple[int, int] = (0, 1), short: bool = False) -> DataFrame:
    """Nested orders, or one part of them: the ids that fall into some of the buckets of the index of what has been ingested. `short`: see
    `_short`."""
    number, parts = part
    tables = [star.orders(spark, sf_dir), star.invoices(spark, sf_dir), star.items(spark, sf_dir, by_order=True)]
    if parts > 1:
        tables = [x.where(bucket(F.col("id_pedido"), parts) == number) for x in tables]
    return nesting.nest_orders(*tables, short=short)


def _flat_items(orders: DataFrame) -> DataFrame:
    flat = silver.items(orders, metrics=None)
    return plain(
        flat.select(
            "id_pedido", "id_nf", "id_item", "descricao", "ncm", "quantidade", "unidade", "valor_unitario",
            "valor_total_item", "peso_kg", "comprimento_cm", "largura_cm", "altura_cm",
        )
    )


def item_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_items(_nested(spark, sf_dir))


def nest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export nested JSON, read it back and flatten it: every line must return."""
    folder = scratch(spark, "export")
    with short_lived_shuffles(spark):
        short = _short(spark, sf_dir)
        for part in _parts(spark, sf_dir):
            landing.write_orders(_nested(spark, sf_dir, part, short), folder, mode="append")
    return _flat_items(landing.read_json(spark, folder, schemas.ORDER, layout="lines"))


def nested_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(nesting.document_totals(_nested(spark, sf_dir)))


def item_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rollup.order_totals(star.items(spark, sf_dir)))


def reconcile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["valor_mercadoria", "peso_total_kg"]
    return plain(rollup.reconcile(star.orders(spark, sf_dir), rollup.order_totals(star.items(spark, sf_dir)), columns))


def freight_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(star.orders(spark, sf_dir).select("id_pedido", "valor_frete"))


def volume_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = c.item_volume_m3("comprimento_cm", "largura_cm", "altura_cm", "quantidade")
    unit = F.col("comprimento_cm") * F.col("comprimento_cm") / F.lit(30.0)
    sized = star.items(spark, sf_dir).select(c.size_class(unit).alias("classe"), volume.alias("volume"))
    return plain(sized.groupBy("classe").agg(F.count(F.lit(1)).alias("total"), c.exact_sum("volume").alias("volume_m3")))


def licence_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    fleet = star.trucks(spark, sf_dir)
    return plain(fleet.select("id_caminhao", "tipo", c.licence_category("tipo").alias("cnh_categoria")))


def weekly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(demand.weekly_features(star.silver_orders(spark, sf_dir)))


def weekly_features_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(demand.weekly_features(star.silver_orders(spark, sf_dir), strict_reference=True))


def weekly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(demand.weekly_totals(demand.weekly_features(star.silver_orders(spark, sf_dir))))


def week_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star.table(spark, sf_dir, "orders")
    year = F.expr("extract(YEAROFWEEK FROM o_orderdate)")
    label = c.week_label(year, F.weekofyear("o_orderdate")).alias("ano_semana")
    return plain(orders.groupBy(label).agg(F.count(F.lit(1)).alias("total")))


def distinct_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    lines = star.table(spark, sf_dir, "lineitem")
    return plain(
        lines.groupBy("l_returnflag").agg(
            F.count_distinct("l_orderkey").alias("pedidos"),
            F.count_distinct(F.when(F.col("l_linestatus") == "F", F.col("l_orderkey"))).alias("pedidos_fechados"),
            F.sum_distinct(price).cast("double").alias("soma_distinta"),
            F.try_divide(F.sum_distinct(price).cast("double"), F.count_distinct(price).cast("double")).alias("media_distinta"),
        )
    )


def safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star.table(spark, sf_dir, "lineitem")
    ratio = c.safe_ratio("l_extendedprice", F.col("l_tax") * c.num(100)).alias("razao")
    return plain(lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", ratio))


QUERIES = {
    f.__name__: f
    for f in (
        route_volume, top_routes, route_ticket, fleet_performance, order_enriched, order_date_parts, load_order_link,
        city_centroid, driver_truck_join, item_flatten, nest_roundtrip, nested_totals, item_rollup, reconcile_totals,
        freight_price, volume_class, licence_map, weekly_features, weekly_features_ref, weekly_totals, week_label,
        distinct_aggs, safe_ratio,
    )
}

_ITEMS = """SELECT id_pedido, id_nf, id_item, descricao, ncm, quantidade, unidade, valor_unitario,
    valor_total AS valor_total_item, peso_kg, comprimento_cm, largura_cm, altura_cm FROM itens WHERE quantidade > 0"""

ORACLE = {
    "route_volume": oracle("SELECT * FROM rotas"),
    "top_routes": oracle(
        """SELECT cidade_origem || ' -> ' || cidade_destino AS rota, total_pedidos, peso_total AS peso_total_kg,
        valor_frete_total, frete_medio, valor_frete_total / NULLIF(peso_total, 0) AS ticket_medio_kg FROM rotas
        ORDER BY total_pedidos DESC, rota, uf_origem, uf_destino LIMIT 20"""
    ),
    "route_ticket": oracle(
        """SELECT cidade_origem || ' -> ' || cidade_destino AS rota,
        valor_frete_total / NULLIF(peso_total, 0) AS ticket_medio_kg FROM rotas"""
    ),
    "fleet_performance": oracle(
        f"""SELECT tipo, COUNT(id_carga) AS total_cargas, {eavg('capacidade_toneladas')} AS capacidade_media,
        CAST(SUM(km_total) AS BIGINT) AS km_total,
        CAST(SUM(CAST({half_up('pct', 8)} AS DECIMAL(18,8))) AS DOUBLE) / NULLIF(COUNT(pct), 0) AS ocupacao_media_pct
        FROM (SELECT c.*, t.tipo, t.capacidade_toneladas,
              c.peso_total_kg / (t.capacidade_toneladas * CAST(1000 AS DOUBLE)) * CAST(100 AS DOUBLE) AS pct
              FROM cargas c LEFT JOIN caminhoes t USING (id_caminhao)) GROUP BY tipo"""
    ),
    "order_enriched": oracle(
        """SELECT id_pedido, p.id_cliente, razao_social, cnpj, c.uf AS uf_cliente, c.cidade AS cidade_cliente, data_pedido,
        peso_total_kg, valor_frete, tipo_frete, prioridade, YEAR(data_pedido) AS ano, MONTH(data_pedido) AS mes,
        DAY(data_pedido) AS dia FROM pedidos p LEFT JOIN clientes c ON p.id_cliente = c.id_cliente"""
    ),
    "order_date_parts": """SELECT o_orderkey AS id_pedido, YEAR(o_orderdate) AS ano, MONTH(o_orderdate) AS mes,
        DAY(o_orderdate) AS dia, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data FROM orders""",
    "load_order_link": "SELECT o_orderkey // 8 AS id_carga, o_orderkey AS id_pedido FROM orders",
    "city_centroid": oracle("SELECT cidade AS cidade_chave, uf AS uf_chave, latitude, longitude FROM centros"),
    "driver_truck_join": oracle(
        """SELECT id_motorista, nome, celular, t.id_caminhao, placa, tipo, capacidade_toneladas
        FROM motoristas m JOIN caminhoes t ON m.id_caminhao = t.id_caminhao WHERE m.status = 'Ativo'"""
    ),
    "item_flatten": oracle(_ITEMS),
    "nest_roundtrip": oracle(_ITEMS),
    "nested_totals": oracle(
        f"""SELECT id_pedido, {esum('valor_total')} AS valor_itens, {esum('peso_kg')} AS peso_itens_kg
        FROM itens GROUP BY id_pedido"""
    ),
    "item_rollup": oracle(
        f"""SELECT id_pedido, COUNT(DISTINCT id_nf) AS total_nfs, COUNT(*) AS total_itens,
        {esum('valor_total')} AS valor_mercadoria, {esum('peso_kg')} AS peso_total_kg,
        {esum(half_up(BOX, 4))} AS volume_total_m3 FROM itens GROUP BY id_pedido"""
    ),
    "reconcile_totals": oracle(
        f"""SELECT coluna, COUNT(*) AS pedidos, COUNT(*) FILTER (ABS(guardado - soma) > 0.01) AS divergentes,
        COUNT(*) FILTER (soma IS NULL) AS sem_itens FROM (
        SELECT 'valor_mercadoria' AS coluna, valor_mercadoria AS guardado, v AS soma FROM pedidos LEFT JOIN s USING (id_pedido)
        UNION ALL SELECT 'peso_total_kg', peso_total_kg, w FROM pedidos LEFT JOIN s USING (id_pedido)) GROUP BY coluna"""
    ).replace(
        "WITH ",
        f"""WITH s AS (SELECT CAST(l_orderkey AS BIGINT) AS id_pedido, {esum('l_extendedprice')} AS v,
        {esum('l_quantity * CAST(50 AS DOUBLE)')} AS w FROM lineitem GROUP BY 1), """,
        1,
    ),
    "freight_price": oracle(f"SELECT id_pedido, {FREIGHT} AS valor_frete FROM pedidos_base"),
    "volume_class": oracle(
        f"""SELECT CASE WHEN comprimento_cm * comprimento_cm / 30 < 1 THEN 'pequeno'
        WHEN comprimento_cm * comprimento_cm / 30 < 10 THEN 'medio' WHEN comprimento_cm * comprimento_cm / 30 < 50 THEN 'grande' ELSE 'extra grande' END AS classe, COUNT(*) AS total,
        {esum(half_up(BOX, 4))} AS volume_m3 FROM itens GROUP BY 1"""
    ),
    "licence_map": oracle(
        """SELECT t.id_caminhao, tipo, CASE WHEN tipo IN ('VUC', 'Toco') THEN 'C' WHEN tipo = 'Truck' THEN 'D' ELSE 'E' END
        AS cnh_categoria FROM caminhoes t"""
    ),
    "weekly_features": oracle(
        """SELECT CAST(inicio_semana AS VARCHAR) AS inicio_semana, semana, rota, total_pedidos, peso_medio, valor_medio,
        dia_da_semana_medio, ano, mes, total_pedidos_semana_anterior FROM semanal"""
    ),
    "weekly_features_ref": oracle(
        f"""SELECT *, LAG(total_pedidos) OVER (PARTITION BY rota ORDER BY ano, semana, mes) AS total_pedidos_semana_anterior
        FROM (SELECT CAST(YEAR(data_pedido) AS BIGINT) AS ano, CAST(WEEK(data_pedido) AS BIGINT) AS semana,
        CAST(MONTH(data_pedido) AS BIGINT) AS mes, cidade_origem || ' -> ' || cidade_destino AS rota,
        COUNT(id_pedido) AS total_pedidos, {eavg('peso_total_kg')} AS peso_medio, {eavg('valor_frete')} AS valor_medio,
        {eavg('CAST(DAYOFWEEK(data_pedido) + 1 AS DOUBLE)')} AS dia_da_semana_medio FROM silver GROUP BY 1, 2, 3, 4)"""
    ),
    "weekly_totals": oracle(
        """SELECT ano || '_W' || LPAD(CAST(semana AS VARCHAR), 2, '0') AS ano_semana,
        CAST(SUM(total_pedidos) AS BIGINT) AS total FROM semanal GROUP BY 1"""
    ),
    "week_label": """SELECT ISOYEAR(o_orderdate) || '_W' || LPAD(CAST(WEEK(o_orderdate) AS VARCHAR), 2, '0') AS ano_semana,
        COUNT(*) AS total FROM orders GROUP BY 1""",
    "distinct_aggs": """SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS pedidos,
        COUNT(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_orderkey END) AS pedidos_fechados,
        CAST(SUM(DISTINCT CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS soma_distinta,
        CAST(SUM(DISTINCT CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
            / COUNT(DISTINCT CAST(l_extendedprice AS DECIMAL(18,2))) AS media_distinta
        FROM lineitem GROUP BY 1""",
    "safe_ratio": """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
        l_extendedprice / NULLIF(l_tax * CAST(100 AS DOUBLE), 0) AS razao FROM lineitem""",
}
