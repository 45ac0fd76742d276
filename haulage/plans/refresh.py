"""One refresh from landing files to gold tables, in folders of a shared file system."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from haulage.functions import columns as c
from haulage.operators import lookup, nesting, rules
from haulage.plans import counters, gold
from haulage.session import STORED
from haulage.sources import schemas
from haulage.streaming import bronze, silver
from haulage.streaming.live import StateTable
from haulage.streaming.seen import Seen

#: What makes two documents of a feed the same one.
ORDER_KEYS = ("id_pedido", "parte")
INVOICE_KEYS = ("id_nf", "id_pedido")
EVENT_KEYS = ("id_carga", "id_status", "timestamp", "observacao", "latitude", "longitude")
FEEDS = {
    "bronze_pedidos": (schemas.ORDER, ORDER_KEYS, "id_pedido bigint, parte int"),
    "bronze_nfs": (schemas.INVOICE, INVOICE_KEYS, "id_nf bigint, id_pedido bigint"),
    "bronze_status": (
        schemas.STATUS,
        EVENT_KEYS,
        "id_carga bigint, id_status int, timestamp string, observacao string, latitude double, longitude double",
    ),
}


@dataclass(frozen=True)
class Lake:
    """Folder layout. A full refresh starts a new `generation` and leaves the old one untouched."""

    root: str
    generation: str = "g0"

    def table(self, name: str) -> str:
        return f"{self.root}/{self.generation}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/{self.generation}/_checkpoints/{name}"

    def restarted(self) -> "Lake":
        return Lake(self.root, f"g-{uuid.uuid4().hex[:12]}")


@dataclass(frozen=True)
class Inputs:
    """Landing folders (None: not used) and the master tables.

    `max_files` and `max_stored` bound a micro-batch in landing files and in files of a bronze table (by `max_files`, if not given).
    """

    customers: DataFrame
    orders: str | None = None
    invoices: str | None = None
    status: str | None = None
    loads: DataFrame | None = None
    trucks: DataFrame | None = None
    layout: str = "array"
    max_files: int | None = None
    max_stored: int | None = None


def seen(lake: Lake, name: str) -> Seen:
    """The index of what a bronze table holds."""
    _, keys, types = FEEDS[name]
    return Seen(lake.table(f"_vistos/{name}"), keys, types)


def ledger(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rule counts of every micro-batch, see `rules.recorded`."""
    return rules.recorded(spark, lake.table("_regras"))


def ingest(spark: SparkSession, lake: Lake, given: Inputs) -> None:
    """Bronze: only files that earlier calls have not seen are read, and of their documents those that are not stored yet.

    The streams run side by side; a micro-batch becomes `lote=<number>` of its table.
    """
    running = []
    for name, folder in (("bronze_pedidos", given.orders), ("bronze_nfs", given.invoices), ("bronze_status", given.status)):
        if folder:
            stream = bronze.landing_stream(spark, folder, FEEDS[name][0], given.layout, given.max_files)
            known, table = seen(lake, name), lake.table(name)
            running.append(
                bronze.each_batch(stream, lake.checkpoint(name), lambda batch, number, k=known, t=table: k.add(batch, number, t))
            )
    bronze.finish_all(running)


@dataclass(frozen=True)
class Step:
    """How a bronze table becomes a silver one: the change takes the rows and where to count rule violations."""

    source: str
    target: str
    change: Callable[[DataFrame, Observation], DataFrame]
    rules: tuple[rules.Rule, ...] = ()
    by: tuple[str, ...] = ()


def steps(spark: SparkSession, given: Inputs) -> list[Step]:
    found = []
    if given.orders:
        made = lambda df, seen_: silver.orders(df, given.customers, seen_)
        found.append(Step("bronze_pedidos", "silver_pedidos", made, silver.ORDER_RULES, ("ano", "mes")))
        found.append(Step("bronze_pedidos", "silver_itens_nf", silver.items, silver.ITEM_RULES))
        found.append(Step("bronze_pedidos", "silver_notas_fiscais", lambda df, _: silver.invoices(df)))
    if given.status:
        names = schemas.status_reference(spark)
        found.append(Step("bronze_status", "silver_status", lambda df, seen_: silver.status(df, names, seen_), silver.STATUS_RULES))
    return found


@contextmanager
def _observed_to_the_end(spark: SparkSession) -> Iterator[None]:
    """A plan that turns out to give no rows is else replaced by an empty one, and what was observed below it (all rows broke a rule) is
    lost."""
    name, rule = "spark.sql.adaptive.optimizer.excludedRules", "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ",".join(filter(None, [before, rule])))
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def clean_batch(lake: Lake, step: Step, batch: DataFrame, number: int) -> None:
    """One micro-batch of a silver table: its rows as `passo=<number>`, its rule counts in the ledger, and for events the newest status
    of each load. All of it replaces what an earlier attempt of the batch has left."""
    spark, counts, target = batch.sparkSession, Observation(), lake.table(step.target)
    kept = step.change(batch.drop("_perto", "_conteudo"), counts)
    if step.by:  # Writers by measured size: small groups share one, large ones are split. Else each task writes what it has read.
        kept = kept.hint("rebalance", "lote", *step.by)
    with _observed_to_the_end(spark):
        kept.write.mode("overwrite").partitionBy("lote", *step.by).options(**STORED).parquet(f"{target}/passo={number}")
    if step.rules:
        rules.record(spark, lake.table("_regras"), step.target, number, step.rules, counts.get)
    if step.target == "silver_status":
        written = spark.read.schema(kept.schema).parquet(f"{target}/passo={number}")
        state(lake).put(written, number)


def clean(spark: SparkSession, lake: Lake, given: Inputs, targets: Collection[str] | None = None) -> None:
    """Silver: new bronze rows through rules and lookups. Orders are stored by year and month.

    `targets` names the tables to bring up to date; the others keep their place in the stream for a later call.
    """
    running = []
    for step in steps(spark, given):
        if targets is not None and step.target not in targets:
            continue
        rows = bronze.table_stream(spark, lake.table(step.source), given.max_stored or given.max_files)
        each = lambda batch, number, s=step: clean_batch(lake, s, batch, number)
        running.append(bronze.each_batch(rows, lake.checkpoint(step.target), each))
    bronze.finish_all(running)


def state(lake: Lake) -> StateTable:
    return StateTable(lake.table("estado_cargas"))


def read(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """Full read of a table. Of corrected documents the newest version counts."""
    rows = spark.read.parquet(lake.table(name))
    if name in ("silver_pedidos", "silver_itens_nf", "silver_notas_fiscais"):
        return seen(lake, "bronze_pedidos").current(rows)
    if name.startswith("bronze_"):
        return seen(lake, name).current(rows)
    return rows


def invoices(spark: SparkSession, lake: Lake) -> DataFrame:
    """Silver invoices at invoice grain."""
    return nesting.invoices(read(spark, lake, "silver_notas_fiscais"))


def all_invoices(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Invoice headers of the separate feed and of those nested in orders, in one form, one row for each."""
    fields = ["id_pedido", "numero_nf", "data_emissao", "valor_total", "chave_acesso"]
    own = c.with_moment(read(spark, lake, "bronze_nfs"), "data_emissao").select("id_nf", *fields)
    return own, invoices(spark, lake).select("id_nf", *fields)


def count_orders(spark: SparkSession, lake: Lake) -> bool:
    """Bring the order counters forward by the bronze micro-batches that came since the last call; False if there are none.

    Reads the silver partitions of these batches, and those of the versions that their corrections replace.
    """
    totals, known = counters.table(lake.table("_contadores")), seen(lake, "bronze_pedidos")
    newest = max(known.index.numbers(spark, "deltas"), default=-1)
    base, deltas = totals.parts(spark)
    done = max([*deltas, -1 if base is None else base], default=-1)
    if newest <= done:
        return False
    orders = spark.read.parquet(lake.table("silver_pedidos"))
    rows = counters.counted(orders.where(F.col("lote").between(done + 1, newest)))
    replaced = known.old.read(spark).where(F.col("lote").between(done + 1, newest) & (F.coalesce("parte", F.lit(0)) == 0))
    if not replaced.isEmpty():
        gone = known.among(orders, lookup.sized(replaced.drop("lote")), "left_semi")
        rows = rows.unionByName(counters.counted(gone, -1))
    totals.write(counters.merged(rows), newest)
    totals.compact(spark, newest + 1, counters.merged)
    return True


def order_counters(spark: SparkSession, lake: Lake) -> DataFrame:
    return counters.table(lake.table("_contadores")).read(spark)


def aggregate(spark: SparkSession, lake: Lake, given: Inputs) -> None:
    """Gold: figures of orders from counters that only the new rows change, the status summary from one row per load."""
    results = {}
    if given.orders:
        count_orders(spark, lake)
        counted = order_counters(spark, lake)
        results["gold_volume_por_rota"] = counters.route_volume(counted)
        results["gold_volume_diario"] = counters.daily_volume(counted)
    if given.loads is not None and given.trucks is not None:
        results["gold_performance_frota"] = gold.fleet_performance(given.loads, given.trucks)
    if given.status:
        results["gold_status_entregas"] = gold.status_summary(state(lake).read(spark))
    for name, frame in results.items():
        frame.write.mode("overwrite").parquet(lake.table(name))


def refresh(spark: SparkSession, lake: Lake, given: Inputs, full_refresh: bool = False) -> Lake:
    """Process what is new and stop; with `full_refresh`, everything again into a new generation."""
    lake = lake.restarted() if full_refresh else lake
    ingest(spark, lake, given)
    clean(spark, lake, given)
    aggregate(spark, lake, given)
    return lake
