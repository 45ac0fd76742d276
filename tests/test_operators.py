from __future__ import annotations

import random

import pytest
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from haulage.operators import latest, links, lookup, nesting, positions, rollup, rules, skew
from haulage.operators.rules import Rule


def test_latest_breaks_ties_and_null_time_loses(spark, rows):
    df = spark.createDataFrame(
        [(1, "10:00", 5, "a"), (1, "10:00", 7, "b"), (1, None, 9, "c"), (2, None, 1, "d")], "k int, t string, s int, v string"
    )
    assert rows(latest.latest_per_key(df, ["k"], ["t", "s"]), "k", "v") == [(1, "b"), (2, "d")]
    assert rows(latest.latest_fold(df.filter("t IS NOT NULL"), ["k"], ["t", "s"], ["v"])) == [(1, "b")]


def test_top_per_key_limits_before_the_shuffle(spark, rows):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    top = latest.top_per_key(df, ["k"], [F.col("id").asc()], 2)
    assert rows(top) == [(0, 0, 1), (0, 3, 2), (1, 1, 1), (1, 4, 2), (2, 2, 1), (2, 5, 2)]
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


RULES = (Rule("id", "k IS NOT NULL", drop=True), Rule("peso", "w > 0"), Rule("frete", "f >= 0", drop=True))
RULE_ROWS = [(1, 1.0, 0.0), (None, 1.0, 1.0), (2, 0.0, 5.0), (3, None, None), (4, 2.0, -1.0)]


def test_rules_drop_warn_and_count(spark, rows):
    df = spark.createDataFrame(RULE_ROWS, "k int, w double, f double")
    assert rows(rules.apply(df, RULES), "k") == [(1,), (2,)]
    assert rows(rules.report(df, RULES)) == [
        ("frete", "drop", 5, 3, 2), ("id", "drop", 5, 4, 1), ("peso", "warn", 5, 3, 2),
    ]


def test_rule_metrics_are_observed(spark):
    df = spark.createDataFrame(RULE_ROWS, "k int, w double, f double")
    watch = Observation("m")
    counts = [F.count_if(~r.passed()).alias(r.name) for r in RULES]
    df.observe(watch, *counts).count()
    assert watch.get == {"id": 1, "peso": 2, "frete": 2}


def skewed(spark, n=6000):
    """A third of the rows in one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("v")
    )


def test_hot_keys_are_few_and_sliced(spark, rows):
    found = rows(skew.hot_keys(skewed(spark), ["k"], share=0.01, least=10))
    assert [r[0] for r in found] == [7] and found[0][1] >= 33


def test_salted_join_gives_the_pairs_of_the_plain_join(spark):
    big, small = skewed(spark), spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    left, right, keys = skew.salted(big, small, ["k"], ["v"], share=0.01, least=10)
    assert left.filter("k = 7").select("_slice").distinct().count() > 10
    got = left.join(right, keys).select("k", "v", "w")
    want = big.join(small, "k").select("k", "v", "w")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def numbered(df, keys, order):
    w = Window.partitionBy(*keys)
    return df.withColumn("indice", F.row_number().over(w.orderBy(*order)).cast("bigint")).withColumn("total", F.count("*").over(w))


def same_rows(got, want):
    return got.count() == want.count() and got.exceptAll(want).isEmpty()


@pytest.mark.parametrize("most", [20, 150, 100_000])
def test_number_within_equals_the_window_whatever_the_cut(spark, most):
    df = skewed(spark).withColumn("t", F.col("v") % 50)
    assert same_rows(skew.number_within(df, ["k"], ["t", "v"], most=most), numbered(df, ["k"], ["t", "v"]))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
def test_number_within_by_times_with_gaps_outliers_and_one_crowded_moment(spark, kind):
    moment = F.when(F.col("v") < 900, F.lit(1_750_000_000)).when(F.col("v") < 950, F.lit(None)).otherwise(F.col("v") * 7919 % 9973 + 1_700_000_000)
    far = F.when(F.col("v") == 5999, F.lit(253_000_000_000)).otherwise(moment)
    df = spark.range(6000).select(F.lit("a").alias("k"), F.lit(None).cast("int").alias("l"), F.col("id").alias("v"))
    df = df.withColumn("t", F.timestamp_seconds(far).cast(kind)).union(df.limit(7).select(F.lit("b"), F.lit(1), "v", F.lit(None).cast(kind)))
    assert same_rows(skew.number_within(df, ["k", "l"], ["t", "v"], most=100), numbered(df, ["k", "l"], ["t", "v"]))


def test_number_within_sorts_no_large_range_and_copies_nothing(spark, tmp_path):
    df = skewed(spark).withColumn("t", F.when(F.col("v") < 2500, F.lit(3)).otherwise(F.col("v")))
    got = skew.number_within(df, ["k"], ["t", "v"], most=100)
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "Range (0, 6000" in plan  # the rows come from the input itself
    reach = got.where("k = 7").select("indice", F.spark_partition_id().alias("p"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert reach.select("p").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_number_within_keeps_null_keys_and_empty_input(spark, rows):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 5)], "k int, v int")
    for most in (1, 100):
        assert rows(skew.number_within(df, ["k"], ["v"], most=most)) == [(1, 5, 1, 1), (None, 1, 1, 2), (None, 2, 2, 2)]
        assert skew.number_within(df.limit(0), ["k"], ["v"], most=most).isEmpty()


def test_sized_broadcasts_only_what_it_counted(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(lookup.sized(spark.range(10), most=320))
    assert not hinted(lookup.sized(spark.range(11), most=320))


def test_order_load_links(spark, rows):
    df = spark.createDataFrame([(1, "[10, 11]"), (2, "[]"), (3, "broken"), (4, None), (5, "[12, null]")], "id_carga bigint, pedidos_json string")
    assert rows(links.order_load_links(df)) == [(1, 10), (1, 11), (5, 12)]
    back = links.id_list(links.order_load_links(df), "id_carga", "id_pedido", "pedidos_json")
    assert rows(back) == [(1, "[10,11]"), (5, "[12]")]


ORDER_DDL = "id_pedido bigint, valor_mercadoria double, peso_total_kg double"
INVOICE_DDL = "id_nf bigint, numero_nf string, id_pedido bigint, data_emissao string, valor_total double, chave_acesso string"
ITEM_DDL = (
    "id_item bigint, id_nf bigint, descricao string, ncm string, quantidade int, unidade string, valor_unitario double, "
    "valor_total double, peso_kg double, comprimento_cm double, largura_cm double, altura_cm double"
)


def documents(spark, **limits):
    orders = spark.createDataFrame([(1, 60.0, 6.0), (2, 0.0, 0.0), (3, 4.0, 4.0)], ORDER_DDL)
    invoices = spark.createDataFrame([(n, "000001", 1 if n < 9 else 3, "2025-01-01 00:00:00", 1.0, "k") for n in range(10)], INVOICE_DDL)
    items = spark.createDataFrame(
        [(i, i % 10, "x", "1", 1, "UN", 1.0, 2.5, 0.5, 10.5, 10.0, 10.0) for i in range(60)], ITEM_DDL
    )
    return orders, items, nesting.nest_orders(orders, invoices, items, **limits)


@pytest.mark.parametrize("limits", [{}, {"items_per_invoice": 2, "invoices_per_document": 3}, {"invoices_per_document": 2}])
def test_nesting_keeps_every_item_whatever_the_limits(spark, rows, limits):
    orders, items, nested = documents(spark, **limits)
    assert rows(nested.filter("parte = 0"), "id_pedido") == [(1,), (2,), (3,)]
    assert nested.filter("id_pedido = 2").select("notas_fiscais").head()[0] is None
    flat = nesting.explode_items(nested, ["id_pedido"])
    assert rows(flat, "id_item", "id_nf", "comprimento_cm") == sorted(
        [(i, i % 10, 10.5) for i in range(60)], key=lambda r: tuple((False, str(v)) for v in r)
    )
    assert rows(nesting.document_totals(nested)) == [(1, 135.0, 27.0), (3, 15.0, 3.0)]
    if limits:
        assert nested.filter("id_pedido = 1").count() > 1


@pytest.mark.parametrize("limits", [{}, {"items_per_invoice": 4}, {"items_per_invoice": 2, "invoices_per_document": 3}])
def test_items_that_name_their_order_meet_their_invoices_by_it(spark, rows, limits):
    orders, items, _ = documents(spark)
    orders = orders.unionByName(spark.createDataFrame([(None, 1.0, 1.0)], ORDER_DDL))
    invoices = spark.createDataFrame(
        [(n, "000001", 1 if n < 9 else 3, "2025-01-01 00:00:00", 1.0, "k") for n in range(11)] + [(None, "0", 3, "d", 1.0, "k"), (5, "0", None, "d", 1.0, "k")],
        INVOICE_DDL,
    )
    owned = items.withColumn("id_pedido", F.when(F.col("id_nf") < 9, 1).otherwise(3).cast("bigint"))
    nested = nesting.nest_orders(orders, invoices, owned, **limits)
    plan = nested._jdf.queryExecution().executedPlan().toString()
    assert limits or "hashpartitioning(id_nf" not in plan
    flat = nesting.explode_items(nested, ["id_pedido"])
    assert rows(flat, "id_item") == rows(items, "id_item")
    assert rows(nesting.document_totals(nested)) == [(1, 135.0, 27.0), (3, 15.0, 3.0)]
    empty = nested.select(F.explode("notas_fiscais").alias("nf")).where("nf.itens IS NULL")
    assert rows(empty, "nf.id_nf") == [(10,), (None,)]


def test_explode_skips_null_and_empty_lists(spark):
    ddl = "id_pedido bigint, notas_fiscais array<struct<id_nf: bigint, numero_nf: string, data_emissao: string, valor_total: double, itens: array<struct<id_item: bigint, descricao: string, ncm: string, quantidade: int, unidade: string, valor_unitario: double, valor_total: double, peso_kg: double, dimensoes: struct<comprimento_cm: double, largura_cm: double, altura_cm: double>>>>>"
    item = (1, "d", "n", 1, "UN", 1.0, 1.0, 1.0, (1.5, 2.0, 3.0))
    data = [(1, None), (2, []), (3, [(1, "1", "d", 1.0, None)]), (4, [(2, "1", "d", 1.0, [])]), (5, [(3, "1", "d", 1.0, [item])])]
    flat = nesting.explode_items(spark.createDataFrame(data, ddl), ["id_pedido"])
    assert [tuple(r) for r in flat.select("id_pedido", "id_nf", "comprimento_cm").collect()] == [(5, 3, 1.5)]


def test_rollup_and_reconciliation(spark, rows):
    orders, items, _ = documents(spark)
    with_order = items.withColumn("id_pedido", F.when(F.col("id_nf") < 9, 1).otherwise(3).cast("bigint"))
    totals = rollup.order_totals(with_order)
    assert rows(totals, "id_pedido", "total_nfs", "total_itens", "valor_mercadoria") == [(1, 9, 54, 135.0), (3, 1, 6, 15.0)]
    found = rows(rollup.reconcile(orders, totals, ["valor_mercadoria", "peso_total_kg"]))
    assert found == [("peso_total_kg", 3, 2, 1), ("valor_mercadoria", 3, 2, 1)]


def test_interpolated_positions(spark, rows):
    events = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 1, "x"), (None, 1, "y")], "id_carga int, t int, n string")
    ends = spark.createDataFrame(
        [(1, 0.0, 0.0, 10.0, 20.0), (2, 5.0, 5.0, 9.0, 9.0)],
        "id_carga int, lat_origem double, long_origem double, lat_destino double, long_destino double",
    )
    got = rows(positions.interpolated(events, ends, ["t", "n"], most=3), "n", "indice", "lat_estimada", "long_estimada")
    assert got == [("a", 1, 0.0, 0.0), ("b", 2, 5.0, 10.0), ("c", 3, 10.0, 20.0), ("x", 1, 5.0, 5.0)]
