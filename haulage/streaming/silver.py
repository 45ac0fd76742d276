"""Cleaned and enriched tables. Each function works on a stream and on a batch frame alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from haulage.functions import columns as c
from haulage.operators import rules
from haulage.operators.lookup import sized
from haulage.operators.nesting import explode_invoices, explode_items
from haulage.operators.rules import Rule

ORDER_RULES = (
    Rule("id_pedido_valido", "id_pedido IS NOT NULL", drop=True),
    Rule("peso_positivo", "peso_total_kg > 0 AND NOT isnan(peso_total_kg)"),
    Rule("valor_frete_valido", "valor_frete >= 0 AND NOT isnan(valor_frete)", drop=True),
    Rule("data_pedido_legivel", "data_pedido IS NOT NULL"),
)
ITEM_RULES = (Rule("quantidade_valida", "quantidade > 0", drop=True),)
STATUS_RULES = (
    Rule("carga_valida", "id_carga IS NOT NULL", drop=True),
    Rule("momento_legivel", "timestamp IS NOT NULL"),
)

ITEM_CARRY = [
    "id_pedido",
    "id_cliente",
    "data_pedido",
    "cidade_origem",
    "uf_origem",
    "cidade_destino",
    "uf_destino",
]


def first_parts(orders: DataFrame) -> DataFrame:
    """One document per order: continuation documents only add invoices."""
    if "parte" not in orders.columns:
        return orders
    return orders.filter(F.coalesce(F.col("parte"), F.lit(0)) == 0).drop("parte")


def enrich_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with their customer and the parts of the order date; before any rule.

    Customers are broadcast when their counted number allows it, so that orders are not shuffled.
    """
    who = customers.select(
        F.col("id_cliente").alias("_id"),
        "razao_social",
        "cnpj",
        F.col("uf").alias("uf_cliente"),
        F.col("cidade").alias("cidade_cliente"),
    )
    joined = orders.join(sized(who), F.col("id_cliente") == F.col("_id"), "left").drop("_id")
    dated = c.with_moment(joined, "data_pedido").withColumn("prioridade", c.normal_priority("prioridade"))
    return dated.withColumns(c.calendar_parts("data_pedido"))


def version(bronze: DataFrame) -> list[str]:
    """The columns that say which version of which document a row comes from, as far as the source has them."""
    return [c for c in ("parte", "lote") if c in bronze.columns]


def orders(bronze: DataFrame, customers: DataFrame, metrics: str | Observation | None = "regras_pedidos") -> DataFrame:
    """Order headers. Invoices are a table of their own (`invoices`): a continuation document holds further ones."""
    headers = first_parts(bronze).drop("notas_fiscais")
    return rules.apply(enrich_orders(headers, customers), ORDER_RULES, metrics)


def invoices(bronze: DataFrame) -> DataFrame:
    """Invoices of all documents of an order, one row per struct; `nesting.invoices` gives the invoice grain."""
    return c.with_moment(explode_invoices(bronze, version(bronze)), "data_emissao")


def items(bronze: DataFrame, metrics: str | Observation | None = "regras_itens") -> DataFrame:
    flat = explode_items(c.with_moment(bronze, "data_pedido"), [*ITEM_CARRY, *version(bronze)]).withColumn("ncm", c.digits_only("ncm"))
    return rules.apply(flat, ITEM_RULES, metrics)


def describe_status(events: DataFrame, reference: DataFrame) -> DataFrame:
    """Events with the name and order of their status. The lookup has 15 rows, so it is broadcast."""
    names = reference.select(
        F.col("id_status").alias("_id"), F.col("descricao").alias("descricao_status"), "ordem"
    )
    named = events.join(F.broadcast(names), F.col("id_status") == F.col("_id"), "left").drop("_id")
    return c.with_moment(named, "timestamp")


def status(bronze: DataFrame, reference: DataFrame, metrics: str | Observation | None = "regras_status") -> DataFrame:
    return rules.apply(describe_status(bronze, reference), STATUS_RULES, metrics)
