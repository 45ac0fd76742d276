"""Demand model over the weekly features. Training has no SQL form; split, baseline, runs and the form of the results do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.catalogue.shared import oracle, plain
from haulage.plans import demand
from haulage.session import scratch
from haulage.sources import star_schema as star


def _fitted(spark: SparkSession, sf_dir: str):
    """Model, all weeks and test weeks. Trained once on a written copy of the features; the forest reads its input many times."""
    path = scratch(spark, "features")
    demand.weekly_features(star.silver_orders(spark, sf_dir)).write.parquet(path)
    weeks = spark.read.parquet(path)
    train, test = demand.split(weeks)
    return demand.train(train), weeks, test


def demand_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every route-week and the week after the newest one of each route."""
    model, weeks, _ = _fitted(spark, sf_dir)
    return plain(demand.forecast_table(demand.forecast(model, weeks)))


def forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, test = _fitted(spark, sf_dir)
    return plain(demand.score_frame(demand.predict(model, test)))


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(demand.importance(spark, _fitted(spark, sf_dir)[0]))


def _weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.weekly_features(star.silver_orders(spark, sf_dir))


def demand_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which route-weeks with a known lag train the model and which test it."""
    train, test = demand.split(_weeks(spark, sf_dir))
    named = [part.select("rota", "inicio_semana", F.lit(name).alias("parte")) for name, part in (("treino", train), ("teste", test))]
    return plain(named[0].unionByName(named[1]))


def baseline_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of last week's count as forecast over the test rows: what the forest has to beat."""
    return plain(demand.baseline_scores(demand.split(_weeks(spark, sf_dir))[1]))


def baseline_by_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for each of the newest four weeks, with the number of rows that a model may learn from."""
    path = scratch(spark, "features")
    _weeks(spark, sf_dir).write.parquet(path)
    parts = demand.folds(spark.read.parquet(path))
    seen = parts.groupBy("fold").agg(F.count_if(F.col("papel") == "treino").alias("treino"))
    return plain(demand.baseline_scores(parts.where("papel = 'teste'"), "fold").join(seen, "fold"))


def importance_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of the fitted forest; their importances add up to one (to nothing, if all weeks are alike)."""
    found = demand.importance(spark, _fitted(spark, sf_dir)[0])
    whole = found.agg(F.round(F.sum("importance"), 6).alias("soma"), F.count_if(~F.col("importance").between(0, 1)).alias("fora"))
    return plain(found.select("feature").crossJoin(F.broadcast(whole)))


def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts by a share of last week's count are logged as runs with versions of their own; that with the least error wins."""
    path = scratch(spark, "features")
    demand.split(_weeks(spark, sf_dir))[1].write.parquet(path)
    test, root = spark.read.parquet(path), scratch(spark, "execucoes")
    for percent in (50, 75, 100, 125):
        version = demand.new_version(spark, root)
        found = demand.score_frame(demand.baseline(test, percent / 100)).first().asDict()
        demand.log_run(spark, f"{root}/runs", f"r{version}", f"semana anterior x {percent}%", f"{root}/v{version}", found, percent=percent)
    best = demand.best_run(spark.read.schema(demand.RUNS_DDL).parquet(f"{root}/runs"))
    return plain(best.select("run_id", "nome", F.round("rmse", 6).alias("rmse")))


QUERIES = {
    f.__name__: f
    for f in (
        demand_forecast, forecast_metrics, feature_importance, demand_split, baseline_scores, baseline_by_fold, importance_names, best_run
    )
}

_DRAW = "('0x' || SUBSTR(MD5(rota || '|' || ano || '|' || semana || '|' || mes || '|42'), 1, 8))::BIGINT % 10000"
_KNOWN = f"(SELECT *, {_DRAW} AS sorte FROM semanal WHERE total_pedidos_semana_anterior IS NOT NULL)"
_SCORES = """linhas, a::DOUBLE / linhas AS mae, SQRT(e::DOUBLE / linhas) AS rmse, CASE WHEN yy::DOUBLE - y::DOUBLE * y::DOUBLE / linhas > 0
    THEN CAST(1 AS DOUBLE) - e::DOUBLE / (yy::DOUBLE - y::DOUBLE * y::DOUBLE / linhas) END AS r2"""
_SUMS = """COUNT(*) AS linhas, SUM(ABS(total_pedidos - total_pedidos_semana_anterior)) AS a,
    SUM((total_pedidos - total_pedidos_semana_anterior) * (total_pedidos - total_pedidos_semana_anterior)) AS e,
    SUM(total_pedidos) AS y, SUM(total_pedidos * total_pedidos) AS yy"""

ORACLE: dict[str, str] = {
    "demand_split": oracle(
        f"SELECT rota, CAST(inicio_semana AS VARCHAR) AS inicio_semana, CASE WHEN sorte < 8000 THEN 'treino' ELSE 'teste' END AS parte FROM {_KNOWN}"
    ),
    "baseline_scores": oracle(f"SELECT {_SCORES} FROM (SELECT {_SUMS} FROM {_KNOWN} WHERE sorte >= 8000)"),
    "baseline_by_fold": oracle(
        f"""SELECT fold, {_SCORES}, treino FROM (SELECT fold, {_SUMS}, ANY_VALUE(treino) AS treino
        FROM (SELECT w AS semana_teste, ROW_NUMBER() OVER (ORDER BY w DESC) AS fold FROM (SELECT DISTINCT inicio_semana AS w FROM semanal))
        JOIN semanal ON inicio_semana = semana_teste
        JOIN (SELECT w AS antes, (SELECT COUNT(*) FROM semanal s WHERE s.inicio_semana < w AND s.total_pedidos_semana_anterior IS NOT NULL) AS treino
            FROM (SELECT DISTINCT inicio_semana AS w FROM semanal)) ON antes = semana_teste
        WHERE fold <= 4 AND total_pedidos_semana_anterior IS NOT NULL GROUP BY fold)"""
    ),
    "importance_names": oracle(
        f"""SELECT feature, (SELECT CAST(COUNT(DISTINCT total_pedidos) > 1 AS INT)::DOUBLE FROM {_KNOWN} WHERE sorte < 8000) AS soma,
        CAST(0 AS BIGINT) AS fora FROM (VALUES ('ano'), ('semana'), ('mes'), ('dia_da_semana_medio'),
        ('peso_medio'), ('valor_medio'), ('total_pedidos_semana_anterior')) AS v(feature)"""
    ),
    "best_run": oracle(
        f"""SELECT 'r' || n AS run_id, 'semana anterior x ' || p || '%' AS nome, ROUND(rmse, 6) AS rmse FROM (SELECT n, p,
        SQRT(AVG(POW(total_pedidos_semana_anterior * (p::DOUBLE / 100) - total_pedidos, 2))) AS rmse
        FROM {_KNOWN}, (VALUES (1, 50), (2, 75), (3, 100), (4, 125)) AS v(n, p) WHERE sorte >= 8000 GROUP BY n, p)
        ORDER BY rmse, run_id LIMIT 1"""
    ),
}
