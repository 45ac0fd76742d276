"""Replays, corrections, retried micro-batches and figures carried forward, against plain recomputation."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from haulage.functions import columns as c
from haulage.operators import rules
from haulage.plans import counters, gold, refresh, views
from haulage.streaming import silver
from haulage.streaming.deltas import Deltas, bucket
from haulage.streaming.live import StateTable
from haulage.streaming.seen import Seen
from tests import logistics
from tests.test_streams import event, order, put


def rows_of(spark, table, number):
    return sorted(tuple(r) for r in spark.read.parquet(f"{table}/lote={number}").select("k", "v").collect())


def test_deltas_replace_retries_and_compact(spark, tmp_path, rows):
    kept = Deltas(str(tmp_path / "d"), "k bigint, v bigint", ("k",))

    def write(number, *values):
        frame = spark.createDataFrame(values or [], "k bigint, v bigint")
        kept.write(frame.withColumn("balde", bucket(F.col("k"))), number)

    assert kept.read(spark).count() == 0 and kept.parts(spark) == (None, [])
    write(0, (1, 1), (2, 2))
    write(0, (1, 1))  # a second attempt
    write(1, (5000, 3))
    write(2)
    assert rows(kept.read(spark), "k", "lote") == [(1, 0), (5000, 1)]
    assert rows(kept.read(spark, below=1), "k") == [(1,)]
    (tmp_path / "d/deltas/lote=2/_SUCCESS").unlink()
    assert kept.parts(spark) == (None, [0, 1])
    assert not kept.compact(spark, 2, lambda r: r.drop("lote"), most=2)
    for number in (3, 4):
        write(number, (number, number))
    assert kept.compact(spark, 5, lambda r: r.drop("lote"), most=2) and kept.parts(spark) == (4, [])
    write(5, (9, 9))
    assert rows(kept.read(spark), "k") == [(1,), (3,), (4,), (5000,), (9,)]
    for number in (6, 7):
        write(number, (number, 0))
    assert kept.compact(spark, 8, lambda r: r.drop("lote"), most=2)
    assert kept.numbers(spark, "base") == [4, 7] and kept.numbers(spark, "deltas") == [5, 6, 7]
    assert kept.read(spark).count() == 7


def test_lookups_read_the_buckets_they_touch(spark, tmp_path):
    known = Seen(str(tmp_path / "s"), ("k",), "k bigint")
    known.add(spark.range(100_000).select(F.col("id").alias("k"), F.lit(1).alias("v")), 0, str(tmp_path / "t"))
    batch = spark.createDataFrame([(7, 1), (8, 1)], "k long, v int").withColumns({"_perto": F.col("k"), "balde": bucket(F.col("k"))})
    found = known.matching(batch, 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "balde" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(_perto,7)" in plan and "LessThanOrEqual(_perto,8)" in plan
    assert len({r.f.split("balde=")[1].split("/")[0] for r in found.select(F.input_file_name().alias("f")).collect()}) == 1
    assert found.count() == 2


def test_replays_and_corrections(spark, tmp_path):
    known, table = Seen(str(tmp_path / "s"), ("k",), "k bigint"), str(tmp_path / "t")

    def add(number, *values):
        known.add(spark.createDataFrame(values, "k bigint, v int"), number, table)
        return rows_of(spark, table, number) if None not in [k for k, _ in values] else None

    def current():
        return sorted(map(tuple, known.current(spark.read.parquet(table)).select("k", "v").where("k IS NOT NULL").collect()))

    assert add(0, (1, 1), (1, 1), (2, 1)) == [(1, 1), (2, 1)]
    assert add(1, (1, 1), (3, 1)) == [(3, 1)]
    assert add(2, (1, 2), (2, 1)) == [(1, 2)]
    assert current() == [(1, 2), (2, 1), (3, 1)]
    assert add(2, (1, 2), (2, 1)) == [(1, 2)]  # the same micro-batch again
    assert add(3, (1, 1), (1, 2)) == []  # old versions come late
    add(4, (None, 1), (None, 1))
    add(5, (None, 1))
    assert spark.read.parquet(table).where("k IS NULL").count() == 3
    assert add(6, (1, 3), (3, 9)) == [(1, 3), (3, 9)]
    assert current() == [(1, 3), (2, 1), (3, 9)]


def test_a_hot_replay_stays_one_row(spark, tmp_path):
    known, table = Seen(str(tmp_path / "s"), ("k",), "k bigint"), str(tmp_path / "t")
    for number in (0, 1):
        many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + number).alias("k"), F.lit(1).alias("v"))
        known.add(many, number, table)
    assert spark.read.parquet(table).where("k = 7").count() == 1
    assert spark.read.parquet(table).groupBy("k").count().where("count > 1").count() == 0


@pytest.fixture
def given(spark, tmp_path):
    return refresh.Inputs(
        customers=logistics.clientes(spark), orders=f"{tmp_path}/pedidos", invoices=f"{tmp_path}/nfs",
        status=f"{tmp_path}/status", loads=logistics.cargas(spark), trucks=logistics.caminhoes(spark),
    )


def test_orders_that_come_again_or_corrected_count_once(spark, tmp_path, given, rows):
    lake = refresh.Lake(str(tmp_path / "lake"))
    put(given.invoices, "a", order(1)["notas_fiscais"])
    put(given.status, "a", [event(1, 8, "2025-01-01 10:00:00"), event(1, 9, "2025-01-01 11:00:00")])
    put(given.orders, "a", [order(i) for i in (1, 2, 3)])
    refresh.refresh(spark, lake, given)
    fewer = order(2, valor_frete=99.0, cidade_destino="Recife")
    fewer["notas_fiscais"][0]["itens"] = fewer["notas_fiscais"][0]["itens"][:1] * 3
    put(given.orders, "b", [order(1), fewer, order(4), order(3, valor_frete=-1.0), order(5, valor_frete=float("nan"))])
    put(given.status, "b", [event(1, 8, "2025-01-01 10:00:00"), event(2, 12, "2025-01-01 11:00:00")])
    put(given.invoices, "b", order(1)["notas_fiscais"])
    refresh.refresh(spark, lake, given)

    def read(name):
        return refresh.read(spark, lake, name)

    assert rows(read("silver_pedidos"), "id_pedido", "valor_frete") == [(1, 10.0), (2, 99.0), (4, 10.0)]
    assert rows(read("silver_itens_nf").groupBy("id_pedido").count()) == [(1, 1), (2, 3), (3, 1), (4, 1), (5, 1)]
    assert refresh.invoices(spark, lake).count() == 5 and read("bronze_nfs").count() == 1
    assert read("silver_status").count() == 3
    assert rows(refresh.state(lake).read(spark), "id_carga", "id_status") == [(1, 9), (2, 12)]
    found = rows(read("gold_volume_por_rota"), "cidade_destino", "total_pedidos", "valor_frete_total")
    assert found == [("Recife", 1, 99.0), ("Salvador", 2, 20.0)]
    assert rows(read("gold_volume_por_rota")) == rows(gold.route_volume(read("silver_pedidos")))
    assert rows(read("gold_volume_diario")) == rows(views.daily_volume(read("silver_pedidos")))
    assert not refresh.count_orders(spark, lake)
    counted = {(r.tabela, r.regra): (r.total, r.violacoes) for r in rules.totals(refresh.ledger(spark, lake)).collect()}
    # the replay is no row; the two bad freights are, and each is counted in the batch that brought it
    assert counted["silver_pedidos", "valor_frete_valido"] == (7, 2)
    assert counted["silver_status", "carga_valida"] == (3, 0)


def test_a_retried_micro_batch_leaves_no_trace(spark, tmp_path, given, rows):
    lake = refresh.Lake(str(tmp_path / "lake"))
    for name in "ab":
        put(given.orders, name, [order(ord(name)), order(None)])
    put(given.status, "a", [event(1, 8, "2025-01-01 10:00:00")])
    given = replace(given, invoices=None)
    refresh.ingest(spark, lake, given)
    batch = spark.read.parquet(lake.table("bronze_pedidos"))
    step = refresh.steps(spark, given)[0]
    for number in (0, 0, 1, 1):
        refresh.clean_batch(lake, step, batch.where(F.col("id_pedido").isNull() if number else F.col("id_pedido").isNotNull()), number)
    assert spark.read.parquet(lake.table("silver_pedidos")).count() == 2
    ledger = refresh.ledger(spark, lake).where("regra = 'id_pedido_valido'")
    assert rows(ledger, "passo", "total", "violacoes") == [(0, 2, 0), (1, 2, 2)]
    last = refresh.steps(spark, given)[-1]
    events = spark.read.parquet(lake.table("bronze_status"))
    for _ in range(2):
        refresh.clean_batch(lake, last, events, 0)
    assert refresh.state(lake).read(spark).count() == 1


def test_state_table_keeps_the_newest_event(spark, tmp_path, rows):
    rng = random.Random(3)
    table, want = StateTable(str(tmp_path / "s")), {}
    for number in range(30):
        made = [(rng.randint(1, 40) * 5000, rng.randint(1, 15), rng.randint(0, 900)) for _ in range(6)]
        frame = spark.createDataFrame(made, "id_carga bigint, id_status int, s int").select(
            "id_carga", "id_status", F.lit("x").alias("descricao_status"), F.col("id_status").alias("ordem"),
            F.timestamp_seconds("s").alias("timestamp"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"),
            F.lit(None).cast("timestamp").alias("data_ingestao"),
        )
        table.put(frame, number)
        for load, status, second in made:
            want[load] = max(want.get(load, (-1, -1)), (second, status))
    assert table.rows.numbers(spark, "base")
    found = table.read(spark).select("id_carga", F.unix_timestamp("timestamp").alias("s"), "id_status").collect()
    assert {r.id_carga: (r.s, r.id_status) for r in found} == want
    some = sorted(want)[:2]
    assert {r.id_carga for r in table.of(spark, some).collect()} == set(some)


def test_counters_are_those_of_a_full_count(spark, tmp_path, rows):
    """Orders are added and corrected at random; figures from deltas equal those from the rows that are left, to the last bit."""
    rng = random.Random(11)
    table, current = counters.table(str(tmp_path / "c")), {}
    ddl = "id_pedido bigint, data_pedido timestamp, cidade_origem string, uf_origem string, cidade_destino string, uf_destino string, " \
        "prioridade string, peso_total_kg double, valor_frete double"

    def frame(values):
        days = [(i, d, *rest) for i, d, *rest in values]
        made = spark.createDataFrame(days, ddl.replace("data_pedido timestamp", "data_pedido string"))
        return made.withColumn("data_pedido", F.to_timestamp("data_pedido"))

    for number in range(4):
        new = {}
        for i in rng.sample(range(60), 25):
            new[i] = (
                i, f"2025-01-0{rng.randint(1, 3)} 10:00:00", rng.choice("AB"), "X", rng.choice("CD"), None, rng.choice(["Normal", "Urgente", None]),
                rng.choice([None, rng.uniform(-5, 1e6)]), rng.uniform(0, 3) * 10 ** rng.randint(0, 7),
            )
        rows_now = counters.counted(frame(list(new.values())))
        old = [current[i] for i in new if i in current]
        if old:
            rows_now = rows_now.unionByName(counters.counted(frame(old), -1))
        table.write(counters.merged(rows_now), number)
        current |= new
    left = frame(list(current.values()))
    for kept in (table.read(spark), table):
        if kept is table:
            table.compact(spark, 9, counters.merged, most=1)
            kept = table.read(spark)
        assert rows(counters.route_volume(kept)) == rows(gold.route_volume(left))
        assert rows(counters.daily_volume(kept)) == rows(views.daily_volume(left))


def test_sums_with_numbers_that_are_none(spark):
    frame = spark.createDataFrame([("a", 1.5), ("a", float("nan")), ("b", 2.25), ("b", None), ("c", float("inf")), ("d", None)], "g string, x double")
    found = {r.g: r.s for r in frame.groupBy("g").agg(c.exact_sum("x").alias("s")).collect()}
    assert found["a"] != found["a"] and found["c"] != found["c"] and found["b"] == 2.25 and found["d"] is None
    assert silver.ORDER_RULES[2].name == "valor_frete_valido"
    nan = spark.createDataFrame([(1, float("nan"))], "id bigint, valor_frete double")
    assert nan.where(silver.ORDER_RULES[2].passed()).count() == 0
