"""Declared row rules: count violations, and drop the rows of the strict ones."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A row passes only when `condition` is TRUE; NULL is a violation. `drop` removes failing rows."""

    name: str
    condition: str
    drop: bool = False

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def apply(df: DataFrame, rules: Sequence[Rule], metrics: str | Observation | None = None) -> DataFrame:
    """Rows that pass every dropping rule.

    With `metrics`, row and violation counts are observed under that name: in `observedMetrics` of each
    micro-batch for a stream, through an `Observation` or listener for a batch.
    """
    if metrics:
        counts = [F.count_if(~r.passed()).alias(r.name) for r in rules]
        df = df.observe(metrics, F.count(F.lit(1)).alias("linhas"), *counts)
    for rule in rules:
        if rule.drop:
            df = df.filter(rule.passed())
    return df


def report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule (regra, acao, total, aprovadas, violacoes) from a single pass over df."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(r.passed()).alias(f"_{i}") for i, r in enumerate(rules)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("regra"),
                F.lit("drop" if r.drop else "warn").alias("acao"),
                F.col(f"_{i}").alias("aprovadas"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return (
        counted.select("_all", F.explode(rows).alias("r"))
        .select("r.regra", "r.acao", F.col("_all").alias("total"), "r.aprovadas")
        .withColumn("violacoes", F.col("total") - F.col("aprovadas"))
    )


def record(spark: SparkSession, path: str, table: str, number: int, rules: Sequence[Rule], observed: dict[str, int]) -> None:
    """Write what `apply` observed in micro-batch `number` of a table into the ledger at `path`.

    A batch that is tried again replaces its rows, so each one counts once.
    """
    total = observed.get("linhas", 0)
    lines = [(r.name, "drop" if r.drop else "warn", total, observed.get(r.name, 0)) for r in rules]
    frame = spark.createDataFrame(lines, "regra string, acao string, total bigint, violacoes bigint").coalesce(1)
    frame.withColumn("momento", F.current_timestamp()).write.mode("overwrite").parquet(f"{path}/tabela={table}/passo={number}")


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """The ledger: (tabela, passo, regra, acao, total, violacoes, momento), one row per table, micro-batch and rule."""
    ddl = "regra string, acao string, total bigint, violacoes bigint, momento timestamp, tabela string, passo bigint"
    return spark.read.schema(ddl).parquet(path)


def totals(ledger: DataFrame) -> DataFrame:
    """Sums over all micro-batches, in the form of `report`, by table."""
    return (
        ledger.groupBy("tabela", "regra", "acao")
        .agg(F.sum("total").alias("total"), F.sum("violacoes").alias("violacoes"))
        .withColumn("aprovadas", F.col("total") - F.col("violacoes"))
    )
