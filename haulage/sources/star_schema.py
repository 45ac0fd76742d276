"""The sample star schema (orders, lineitem, events, …) seen as the logistics tables.

    customer -> clientes            supplier -> caminhoes, motoristas
    orders + lineitem -> pedidos    lineitem + part -> itens, notas fiscais
    orders -> movimento_cargas (a load is eight consecutive orders)
    events -> status events (user_id is the load)

Keys are BIGINT throughout. Nothing is filtered: every frame covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from haulage.functions import columns as c
from haulage.operators.links import id_list
from haulage.operators.lookup import bounded, sized

# Truck types in the order of their base capacity in tonnes, and the status of each event type.
TRUCK_TYPES = ("VUC", "Toco", "Truck", "Carreta", "Bitrem", "Rodotrem")
BASE_TONNES = (3.5, 8.0, 14.0, 25.0, 37.0, 50.0)
STATUS_OF_EVENT = {"signup": 1, "click": 8, "view": 9, "purchase": 12, "error": 15}
PRIORITY_OF = {"1-URGENT": "Urgente", "2-HIGH": "Expressa"}
ORDERS_PER_LOAD = 8
KG_PER_UNIT, M3_PER_UNIT = 50.0, 0.15
DEPOT = "BUILDING"


_known: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table. Its schema is read from a footer once per path, not by a job per use."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _known:
        _known[path] = spark.read.parquet(path).schema
    return spark.read.schema(_known[path]).parquet(path)


def _choose(column: Column | str, pairs: dict, otherwise=None) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    out = F
    for key, value in pairs.items():
        out = out.when(col == key, value)
    return out.otherwise(otherwise)


def _big(name: str) -> Column:
    return F.col(name).cast("bigint")


def _place(nation_key: Column, segment: Column) -> Column:
    return nation_key.cast("bigint") * 100 + F.ascii(segment)


def _padded(name: str, digits: int) -> Column:
    text = F.col(name).cast("string")
    return F.lpad(text, F.greatest(F.lit(digits), F.length(text)), F.lit("0"))


def _load_of(order: str) -> Column:
    return F.expr(f"CAST({order} AS BIGINT) DIV {ORDERS_PER_LOAD}")


def latitude_of(place: Column) -> Column:
    return c.num(-33) + (place * 7919 % 38000).cast("double") / c.num(1000)


def longitude_of(place: Column) -> Column:
    return c.num(-73) + (place * 104729 % 38000).cast("double") / c.num(1000)


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = _place(F.col("c_nationkey"), F.col("c_mktsegment"))
    shift = ((F.col("c_custkey") % 101) - 50).cast("double") / c.num(1000)
    key = _padded("c_custkey", 8)
    return (
        table(spark, sf_dir, "customer")
        .join(nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _big("c_custkey").alias("id_cliente"),
            F.concat(
                F.substring(key, 1, 2), F.lit("."), F.substring(key, 3, 3), F.lit("."), F.substring(key, 6, 3), F.lit("/0001-"), F.substring(key, 7, 2),
            ).alias("cnpj"),
            F.col("c_name").alias("razao_social"),
            F.col("n_name").alias("uf"),
            F.concat_ws(" ", "n_name", "c_mktsegment").alias("cidade"),
            (latitude_of(place) + shift).alias("latitude"),
            (longitude_of(place) - shift).alias("longitude"),
        )
    )


def trucks(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("s_suppkey") % 6
    tonnes = _choose(kind, dict(enumerate(BASE_TONNES)))
    number = _padded("s_suppkey", 3)
    return table(spark, sf_dir, "supplier").select(
        _big("s_suppkey").alias("id_caminhao"),
        F.concat(F.lit("HLG"), F.substring(number, 1, 1), F.lit("A"), F.substring(number, 2, 18)).alias("placa"),
        _choose(kind, dict(enumerate(TRUCK_TYPES))).alias("tipo"),
        tonnes.alias("capacidade_toneladas"),
        (tonnes * c.num(2.5)).alias("volume_m3"),
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("s_acctbal")
    number = _padded("s_suppkey", 8)
    state = F.when(balance < c.num(0), "Afastado").when(balance < c.num(1000), "Férias").otherwise("Ativo")
    kind = _choose(F.col("s_suppkey") % 6, dict(enumerate(TRUCK_TYPES)))
    return table(spark, sf_dir, "supplier").select(
        _big("s_suppkey").alias("id_motorista"),
        F.concat(
            F.lit("1"), F.substring(number, 1, 2), F.lit("."), F.substring(number, 3, 3), F.lit("."), F.lit("1"),
            F.substring(number, 6, 2), F.lit("-"), F.substring(number, 7, 2),
        ).alias("cpf"),
        F.col("s_name").alias("nome"),
        F.concat(F.lit("(11)9"), F.substring(number, 1, 4), F.lit("-"), F.substring(number, 5, 4)).alias("celular"),
        c.licence_category(kind).alias("cnh_categoria"),
        _big("s_suppkey").alias("id_caminhao"),
        state.alias("status"),
        (c.num(3) + (F.col("s_suppkey") % 21).cast("double") / c.num(10)).alias("avaliacao"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, volume, value and first supplier of each order that has lines."""
    quantity = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        c.exact_sum(quantity * c.num(KG_PER_UNIT)).alias("peso_total_kg"),
        c.exact_sum(quantity * c.num(M3_PER_UNIT)).alias("volume_total_m3"),
        c.exact_sum("l_extendedprice").alias("valor_mercadoria"),
        F.min("l_suppkey").alias("l_suppkey"),
    )


def _cities(spark: SparkSession, sf_dir: str, rows: DataFrame, customer: Column, supplier: Column) -> DataFrame:
    """Add both ends of the way: the depot in the supplier's nation and the city of the customer.

    Each lookup is joined as it is stored, so its file size decides between broadcast and shuffle.
    """
    depot = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return _to_city(spark, sf_dir, _from_depot(spark, sf_dir, rows, depot, supplier), customer)


def _from_depot(spark: SparkSession, sf_dir: str, rows: DataFrame, depot: DataFrame, supplier: Column) -> DataFrame:
    sender = nations(spark, sf_dir).select(F.col("n_nationkey").alias("_sn"), F.col("n_name").alias("uf_origem"))
    return (
        rows.join(depot, supplier == F.col("s_suppkey"), "left")
        .join(sender, F.col("s_nationkey") == F.col("_sn"), "left")
        .withColumn("cidade_origem", F.concat(F.col("uf_origem"), F.lit(" " + DEPOT)))
    )


def _to_city(spark: SparkSession, sf_dir: str, rows: DataFrame, customer: Column) -> DataFrame:
    receiver = nations(spark, sf_dir).select(F.col("n_nationkey").alias("_cn"), F.col("n_name").alias("uf_destino"))
    buyer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (
        rows.join(buyer, customer == F.col("c_custkey"), "left")
        .join(receiver, F.col("c_nationkey") == F.col("_cn"), "left")
        .withColumn("cidade_destino", F.concat(F.col("uf_destino"), F.lit(" "), F.col("c_mktsegment")))
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order header. Weight and freight are NULL for an order without lines.

    From the depot city in the nation of the first supplier to the city of the customer. Orders meet their customers while they are
    short, and their lines after that, so that whole orders are dealt by their own key and stay there.
    """
    head = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    bound = _to_city(spark, sf_dir, head, F.col("o_custkey"))
    whole = bound.join(order_lines(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    depot = sized(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"))
    priority = _choose("o_orderpriority", PRIORITY_OF, "Normal")
    return _from_depot(spark, sf_dir, whole, depot, F.col("l_suppkey")).select(
        _big("o_orderkey").alias("id_pedido"),
        _big("o_custkey").alias("id_cliente"),
        F.col("o_orderdate").cast("timestamp").alias("data_pedido"),
        "peso_total_kg",
        "volume_total_m3",
        "valor_mercadoria",
        c.freight_price(priority, "peso_total_kg", "volume_total_m3", "valor_mercadoria").alias("valor_frete"),
        F.when(F.col("o_orderstatus") == "F", "FOB").otherwise("CIF").alias("tipo_frete"),
        priority.alias("prioridade"),
        "cidade_origem",
        "uf_origem",
        "cidade_destino",
        "uf_destino",
    )


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that pass the dropping rules of the silver layer."""
    return orders(spark, sf_dir).filter("id_pedido IS NOT NULL AND valor_frete >= 0")


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight consecutive orders each (so a list never exceeds eight ids), on a truck chosen by load number.

    Weight and volume follow the price of the orders: a load's own figures need not match its orders.
    From the depot in the nation of the truck to the city of the last order's customer.
    """
    fleet_size = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    last = F.max_by(F.struct("o_custkey", "o_orderdate", "o_orderstatus"), "o_orderkey")
    grouped = (
        table(spark, sf_dir, "orders")
        .groupBy(_load_of("o_orderkey").alias("id_carga"))
        .agg(
            last.alias("u"),
            c.exact_sum("o_totalprice").alias("_valor"),
            F.to_json(F.sort_array(F.collect_list(_big("o_orderkey")))).alias("pedidos_json"),
        )
        .withColumn("id_caminhao", F.col("id_carga") * 7919 % fleet_size)
    )
    plates = trucks(spark, sf_dir).select(F.col("id_caminhao").alias("_id"), "placa")
    with_plate = grouped.join(plates, F.col("id_caminhao") == F.col("_id"), "left")
    return _cities(spark, sf_dir, with_plate, F.col("u.o_custkey"), F.col("id_caminhao")).select(
        "id_carga",
        "id_caminhao",
        "placa",
        F.when(F.col("u.o_orderstatus") == "F", "FOB").otherwise("CIF").alias("tipo_frete"),
        "cidade_origem",
        "uf_origem",
        "cidade_destino",
        "uf_destino",
        F.col("u.o_orderdate").cast("timestamp").alias("data_saida"),
        (F.lit(100) + F.col("id_carga") * 37 % 1900).cast("bigint").alias("km_total"),
        (F.col("_valor") * c.num(0.01)).alias("peso_total_kg"),
        (F.col("_valor") * c.num(0.00003)).alias("volume_total_m3"),
        "pedidos_json",
    )


def load_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the order lists of the loads, without any of the joins."""
    keyed = table(spark, sf_dir, "orders").select(
        _big("o_orderkey").alias("id_pedido"), _load_of("o_orderkey").alias("id_carga")
    )
    return id_list(keyed, "id_carga", "id_pedido", "pedidos_json")


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw status events; positions lie around the depots."""
    place = _place(F.col("user_id") % 25, F.lit(DEPOT))
    north = ((F.col("event_id") * 37 % 3001) - 1500).cast("double") / c.num(1000)
    east = ((F.col("event_id") * 91 % 3001) - 1500).cast("double") / c.num(1000)
    return table(spark, sf_dir, "events").select(
        _big("user_id").alias("id_carga"),
        _choose("event_type", STATUS_OF_EVENT).cast("bigint").alias("id_status"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("observacao"),
        (latitude_of(place) + north).alias("latitude"),
        (longitude_of(place) + east).alias("longitude"),
        _big("event_id").alias("id_movimento"),
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invoice per order and line number. Lines are dealt by order, so that invoices stay beside it and need no second shuffle."""
    return (
        table(spark, sf_dir, "lineitem")
        .repartition("l_orderkey")
        .groupBy((_big("l_orderkey") * 8 + F.col("l_linenumber")).alias("id_nf"), _big("l_orderkey").alias("id_pedido"))
        .agg(c.exact_sum("l_extendedprice").alias("valor_total"), F.max("l_shipdate").cast("timestamp").alias("data_emissao"))
        .withColumn("numero_nf", F.lpad((F.col("id_nf") % 1_000_000).cast("string"), 6, "0"))
        .withColumn("chave_acesso", F.lpad(F.col("id_nf").cast("string"), 44, "0"))
    )


def items(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """One item per line; there is no unique line id, id_item is the part.

    With `by_order`, and parts few enough to go to every executor, lines are dealt by order while they are short, before they get their part.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    if by_order and bounded(part):
        lines, part = lines.repartition("l_orderkey"), F.broadcast(part)
    return (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(
            _big("l_orderkey").alias("id_pedido"),
            (_big("l_orderkey") * 8 + F.col("l_linenumber")).alias("id_nf"),
            _big("l_partkey").alias("id_item"),
            F.col("p_name").alias("descricao"),
            F.col("p_brand").alias("ncm"),
            F.col("l_quantity").cast("int").alias("quantidade"),
            F.lit("UN").alias("unidade"),
            F.col("p_retailprice").alias("valor_unitario"),
            F.col("l_extendedprice").alias("valor_total"),
            (F.col("l_quantity") * c.num(KG_PER_UNIT)).alias("peso_kg"),
            (F.col("p_size").cast("double") + c.num(0.5)).alias("comprimento_cm"),
            (c.num(10) + (F.col("l_partkey") % 40).cast("double")).alias("largura_cm"),
            (c.num(5) + (F.col("l_partkey") % 25).cast("double")).alias("altura_cm"),
        )
    )
