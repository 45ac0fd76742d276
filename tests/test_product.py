"""Generations of views, versions of models, merged feeds, and the data step that publishes only what passed."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from haulage.operators import checks, feeds
from haulage.plans import demand, product, refresh, views
from haulage.sources import tables
from tests import logistics
from tests.test_streams import event, order, put


def test_generations_replace_a_view_as_a_whole(spark, rows):
    tables.create_layers(spark, "ger_")
    name, told = "ger_gold.vw_x", {"id": "Número"}
    first = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)

    def publish(n, day, check=None):
        return tables.publish(spark.range(n).select("id"), name, "x", told, check=check, now=first + dt.timedelta(days=day))

    publish(3, 0)
    reader = spark.read.table(name)
    publish(5, 1)
    assert reader.count() == 3 and spark.read.table(name).count() == 5
    with pytest.raises(ValueError):
        publish(0, 2, views._has_rows)
    assert spark.read.table(name).count() == 5 and len(tables.generations(spark, name)) == 3
    publish(7, 3)
    gone = tables.expire(spark, name, dt.timedelta(days=2), now=first + dt.timedelta(days=3, hours=1))
    assert len(gone) == 2 and spark.read.table(name).count() == 7 and len(tables.generations(spark, name)) == 2
    assert tables.expire(spark, name, dt.timedelta(0), now=first + dt.timedelta(days=90)) and spark.read.table(name).count() == 7
    assert rows(tables.described(spark, name)) == [("id", "Número")]
    assert rows(tables.listed(spark, ["ger_gold", "falta"]).where("tipo = 'VIEW'"), "nome") == [("vw_x",)]


def test_every_column_of_the_views_has_a_comment():
    assert all(text for _, columns in views.COMMENTS.values() for text in columns.values())


def test_versions_are_claimed_once(spark, tmp_path):
    root = str(tmp_path / "m")
    one, two = demand.new_version(spark, root), demand.new_version(spark, root)
    assert (one, two, demand.new_version(spark, root)) == (1, 2, 3)


def test_folds_see_earlier_weeks_only(spark):
    weeks = [(dt.date(2025, 1, 6) + dt.timedelta(days=7 * w), f"r{r}", 5 + w * r, None if w == 0 else 4 + w) for w in range(6) for r in range(3)]
    features = spark.createDataFrame(weeks, "inicio_semana date, rota string, total_pedidos bigint, total_pedidos_semana_anterior bigint")
    parts = demand.folds(features, 2)
    got = {(r.fold, r.papel): (r.n, r.a, r.b) for r in parts.groupBy("fold", "papel").agg(
        F.count("*").alias("n"), F.min("inicio_semana").cast("string").alias("a"), F.max("inicio_semana").cast("string").alias("b")).collect()}
    assert got == {
        (1, "teste"): (3, "2025-02-10", "2025-02-10"), (1, "treino"): (12, "2025-01-13", "2025-02-03"),
        (2, "teste"): (3, "2025-02-03", "2025-02-03"), (2, "treino"): (9, "2025-01-13", "2025-01-27"),
    }
    assert demand.baseline_scores(parts.where("false")).head().linhas == 0


def test_feeds_are_merged_by_precedence(spark, rows):
    one = spark.createDataFrame([(1, "a", None), (2, "b", 2), (None, "n", 0)], "k bigint, t string, v int")
    two = spark.createDataFrame([(2, "B", 9), (3, "c", 3), (None, "m", 1), (4, None, None)], "k bigint, t string, v int")
    got = rows(feeds.merged(one, two, "k", ["t", "v"], ("um", "dois")))
    assert sorted(got, key=str) == sorted(
        [(1, "a", None, "um", "um"), (2, "b", 2, "um", "ambas"), (3, "c", 3, "dois", "dois"), (4, None, None, "dois", "dois"),
         (None, "m", 1, "dois", "dois"), (None, "n", 0, "um", "um")], key=str)
    counts = dict(rows(feeds.reconciled(one, two, "k", ["t", "v"], ("um", "dois"))))
    assert counts == {"divergentes": 1, "só um": 2, "só dois": 3}
    assert feeds.merged(one.limit(0), two.limit(0), "k", ["t"], ("a", "b")).count() == 0


def test_a_failed_check_leaves_what_is_published(spark, tmp_path):
    put(f"{tmp_path}/p", "a", [order(1), order(2)])
    put(f"{tmp_path}/s", "a", [event(1, 12, "2025-01-01 10:00:00")])
    masters = product.Masters(logistics.clientes(spark), logistics.caminhoes(spark), logistics.motoristas(spark), logistics.cargas(spark))
    given = refresh.Inputs(
        customers=masters.customers, orders=f"{tmp_path}/p", status=f"{tmp_path}/s", loads=masters.loads, trucks=masters.trucks
    )
    lake = refresh.Lake(str(tmp_path / "lake"))
    tables.create_layers(spark, "prod_", str(tmp_path / "db"))
    named = {r.nome: r.linhas for r in product.run(spark, lake, given, masters, "prod_").collect()}
    assert named["prod_gold.vw_mapa_entregas"] == 2 and named["prod_bronze.bronze_clientes"] == 5 and len(named) == 14
    assert tables.quality(spark, "prod_gold.gold_volume_por_rota") == "gold"
    with pytest.raises(checks.CheckFailed):
        product.run(spark, lake, given, replace(masters, customers=masters.customers.limit(0)), "prod_")
    put(f"{tmp_path}/p", "b", [order(3, valor_frete=0.0)])
    assert product.run(spark, lake, given, masters, "prod_").where("nome = 'prod_gold.vw_mapa_entregas'").head().linhas == 3
