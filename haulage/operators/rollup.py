"""Bottom-up totals item -> invoice -> order, and their comparison with stored totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.functions import columns as c


def invoice_totals(items: DataFrame) -> DataFrame:
    """One row per (id_pedido, id_nf); sums are combined on the map side before the shuffle."""
    volume = c.item_volume_m3("comprimento_cm", "largura_cm", "altura_cm", "quantidade")
    return items.groupBy("id_pedido", "id_nf").agg(
        F.count(F.lit(1)).alias("total_itens"),
        c.exact_sum("valor_total").alias("valor_nf"),
        c.exact_sum("peso_kg").alias("peso_nf_kg"),
        c.exact_sum(volume).alias("volume_nf_m3"),
    )


def order_totals(items: DataFrame) -> DataFrame:
    return (
        invoice_totals(items)
        .groupBy("id_pedido")
        .agg(
            F.count(F.lit(1)).alias("total_nfs"),
            F.sum("total_itens").alias("total_itens"),
            c.exact_sum("valor_nf").alias("valor_mercadoria"),
            c.exact_sum("peso_nf_kg").alias("peso_total_kg"),
            c.exact_sum("volume_nf_m3").alias("volume_total_m3"),
        )
    )


def reconcile(orders: DataFrame, totals: DataFrame, columns: list[str], tolerance: float = 0.01) -> DataFrame:
    """Per column: orders compared, orders off by more than the tolerance, orders without items."""
    stored = orders.select("id_pedido", *columns)
    rolled = totals.select("id_pedido", *[F.col(x).alias(f"_{x}") for x in columns])
    joined = stored.join(rolled, "id_pedido", "left")
    counts = joined.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.abs(F.col(x) - F.col(f"_{x}")) > F.lit(tolerance)).alias(f"d_{x}") for x in columns],
        *[F.count_if(F.col(f"_{x}").isNull()).alias(f"m_{x}") for x in columns],
    )
    rows = F.array(
        *[
            F.struct(F.lit(x).alias("coluna"), F.col(f"d_{x}").alias("divergentes"), F.col(f"m_{x}").alias("sem_itens"))
            for x in columns
        ]
    )
    return counts.select(F.col("_all").alias("pedidos"), F.explode(rows).alias("r")).select(
        "r.coluna", "pedidos", "r.divergentes", "r.sem_itens"
    )
