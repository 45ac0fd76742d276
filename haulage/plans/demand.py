"""Weekly demand per route: features, forest model, forecast and run log."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.ml import PipelineModel
from pyspark.ml import Pipeline as Stages
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulage.functions import columns as c

FEATURES = [
    "ano",
    "semana",
    "mes",
    "dia_da_semana_medio",
    "peso_medio",
    "valor_medio",
    "total_pedidos_semana_anterior",
]
TARGET, PREDICTION = "total_pedidos", "previsao"
TREES, DEPTH, SEED, TRAIN_SHARE = 100, 10, 42, 0.8
RUNS_DDL = "run_id string, nome string, modelo string, mae double, rmse double, r2 double, parametros string, momento timestamp"


def _dated(orders: DataFrame) -> DataFrame:
    """Day-level columns. An order without a date belongs to no week; one without a city to no route."""
    return (
        orders.filter("data_pedido IS NOT NULL AND cidade_origem IS NOT NULL AND cidade_destino IS NOT NULL")
        .withColumn("rota", c.route_key("cidade_origem", "cidade_destino"))
        .withColumn("semana", F.weekofyear("data_pedido").cast("bigint"))
        .withColumn("_weekday", F.dayofweek("data_pedido").cast("double"))
    )


def _measures() -> list:
    return [
        F.count("id_pedido").alias(TARGET),
        c.exact_avg("peso_total_kg").alias("peso_medio"),
        c.exact_avg("valor_frete").alias("valor_medio"),
        c.exact_avg("_weekday").alias("dia_da_semana_medio"),
    ]


def weekly_features(orders: DataFrame, strict_reference: bool = False) -> DataFrame:
    """One row per week and route with the count of the week before.

    Weeks start on Monday and have ISO numbers; a skipped week leaves the lag NULL. With
    `strict_reference` the groups are calendar year, ISO week and month, and the lag is the previous row.
    The window runs over aggregated rows: a route has one row per week, however many orders it has.
    """
    base = _dated(orders)
    if strict_reference:
        base = base.withColumn("ano", F.year("data_pedido").cast("bigint")).withColumn("mes", F.month("data_pedido").cast("bigint"))
        weekly = base.groupBy("ano", "semana", "mes", "rota").agg(*_measures())
        ahead = Window.partitionBy("rota").orderBy("ano", "semana", "mes")
        return weekly.withColumn("total_pedidos_semana_anterior", F.lag(TARGET, 1).over(ahead))
    weekly = base.groupBy(F.to_date(F.date_trunc("week", "data_pedido")).alias("inicio_semana"), "semana", "rota").agg(*_measures())
    ahead = Window.partitionBy("rota").orderBy("inicio_semana")
    next_to = F.date_add(F.lag("inicio_semana", 1).over(ahead), 7) == F.col("inicio_semana")
    return (
        weekly.withColumn("ano", F.expr("extract(YEAROFWEEK FROM inicio_semana)").cast("bigint"))
        .withColumn("mes", F.month("inicio_semana").cast("bigint"))
        .withColumn("total_pedidos_semana_anterior", F.when(next_to, F.lag(TARGET, 1).over(ahead)))
    )


def weekly_totals(features: DataFrame) -> DataFrame:
    return features.groupBy(c.week_label("ano", "semana").alias("ano_semana")).agg(F.sum(TARGET).alias("total"))


def split(features: DataFrame, by_time: bool = False, train_share: float = TRAIN_SHARE, seed: int = SEED):
    """Train and test rows with a known lag.

    The default assigns each (route, week) by hash, so a retried task sees the same split. `by_time`
    keeps the newest weeks for the test.
    """
    known = features.filter(F.col("total_pedidos_semana_anterior").isNotNull())
    if by_time:
        weeks = F.col("ano") * 100 + F.col("semana")
        border = known.agg(F.percentile_approx(weeks, train_share, 10000)).scalar()
        return known.filter(weeks <= border), known.filter(weeks > border)
    keys = [x for x in ("rota", "ano", "semana", "mes") if x in features.columns]
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10_000
    cut = int(train_share * 10_000)
    return known.filter(draw < cut), known.filter(draw >= cut)


def train(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> PipelineModel:
    """Distributed random forest. The caller caches `rows` if they are costly to build."""
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="_x", handleInvalid="skip")
    forest = RandomForestRegressor(
        featuresCol="_x", labelCol=TARGET, predictionCol=PREDICTION, numTrees=trees, maxDepth=depth, seed=seed
    )
    return Stages(stages=[assemble, forest]).fit(rows)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).drop("_x")


def following(features: DataFrame) -> DataFrame:
    """The week after the newest one of each route. Its lag is the newest week's count, and the averages are carried on."""
    newest = features.groupBy("rota").agg(F.max_by(F.struct(*features.columns), "inicio_semana").alias("row")).select("row.*")
    start = F.date_add("inicio_semana", 7)
    return newest.withColumns(
        {
            "total_pedidos_semana_anterior": F.col(TARGET),
            TARGET: F.lit(None).cast("bigint"),
            "inicio_semana": start,
            "semana": F.weekofyear(start).cast("bigint"),
            "ano": F.extract(F.lit("YEAROFWEEK"), start).cast("bigint"),
            "mes": F.month(start).cast("bigint"),
        }
    ).select(*features.columns)


def forecast(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Predictions for every route-week of `weekly_features` and for the week after each route's newest one.

    A missing lag counts as 0, since the route had no order in the week before; a missing average goes into the model as 0 too,
    and stays NULL in the result. The following week has neither a count nor averages yet: NULL.
    """
    given = {name: F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in FEATURES}
    known = features.withColumn("_peso", F.col("peso_medio"))
    ahead = following(features).withColumn("_peso", F.lit(None).cast(features.schema["peso_medio"].dataType))
    made = predict(model, known.unionByName(ahead).withColumns(given))
    whole = {name: F.col(name).cast("bigint") for name in ("ano", "semana", "mes")}
    return made.withColumns(whole | {"peso_medio": F.col("_peso")}).drop("_peso")


def scores(predicted: DataFrame) -> dict[str, float]:
    """MAE, RMSE and R2 of predictions."""
    judge = RegressionEvaluator(labelCol=TARGET, predictionCol=PREDICTION)
    labelled = predicted.withColumn(TARGET, F.col(TARGET).cast("double"))
    return {m: judge.evaluate(labelled, {judge.metricName: m}) for m in ("mae", "rmse", "r2")}


def score_frame(predicted: DataFrame) -> DataFrame:
    """The same figures as one row, in one aggregate."""
    error = F.col(PREDICTION) - F.col(TARGET)
    mean_square = F.avg(error * error)
    return predicted.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(mean_square).alias("rmse"),
        (F.lit(1.0) - F.try_divide(mean_square, F.var_pop(TARGET))).alias("r2"),
    )


def baseline(rows: DataFrame, factor: float = 1.0) -> DataFrame:
    """The count of the week before, times a factor, as prediction: what a model has to beat."""
    return rows.withColumn(PREDICTION, F.col("total_pedidos_semana_anterior").cast("double") * F.lit(factor))


def folds(features: DataFrame, n: int = 4) -> DataFrame:
    """Rolling origin: rows of the last `n` weeks, each in the fold that tests it, and earlier rows in every fold that may see them.

    (fold, papel, features): fold k tests the k-th last week and sees all weeks before. One job serves all folds; a row is repeated
    at most `n` times.
    """
    last = features.select("inicio_semana").distinct().orderBy(F.desc("inicio_semana")).limit(n)
    starts = last.select((F.row_number().over(Window.orderBy(F.desc("inicio_semana")))).alias("fold"), F.col("inicio_semana").alias("_teste"))
    role = F.when(F.col("inicio_semana") == F.col("_teste"), "teste").otherwise("treino")
    known = features.where("total_pedidos_semana_anterior IS NOT NULL")
    paired = known.join(F.broadcast(starts), F.col("inicio_semana") <= F.col("_teste"))
    return paired.select("fold", role.alias("papel"), *features.columns)


def baseline_scores(rows: DataFrame, *by: str) -> DataFrame:
    """Errors of the week before as prediction, from integer sums, so that they are the same in any order: linhas, mae, rmse, r2."""
    error = F.col(TARGET) - F.col("total_pedidos_semana_anterior")
    summed = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("linhas"),
        F.sum(F.abs(error)).alias("_a"),
        F.sum(error * error).alias("_e"),
        F.sum(TARGET).alias("_y"),
        F.sum(F.col(TARGET) * F.col(TARGET)).alias("_yy"),
    )
    n, e = F.col("linhas").cast("double"), F.col("_e").cast("double")
    spread = F.col("_yy").cast("double") - F.col("_y").cast("double") * F.col("_y").cast("double") / n
    return summed.select(
        *by,
        "linhas",
        (F.col("_a").cast("double") / n).alias("mae"),
        F.sqrt(e / n).alias("rmse"),
        F.when(spread > 0, F.lit(1.0) - e / spread).alias("r2"),
    )


def importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Feature and importance, seven rows, least important first."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(FEATURES, weights)), "feature string, importance double").orderBy("importance", "feature")


def forecast_table(predicted: DataFrame) -> DataFrame:
    return predicted.select(
        "rota", c.week_label("ano", "semana").alias("semana"), TARGET, "peso_medio", F.col(PREDICTION)
    )


def new_version(spark: SparkSession, root: str) -> int:
    """The next version number below `root`, claimed by a file that is created only if it is not there.

    Two writers get two numbers, as far as the file system creates a file for one of them only (as shared ones do).
    """
    jvm = spark._jvm
    number = 1
    while True:
        claim = jvm.org.apache.hadoop.fs.Path(f"{root}/_versoes/v{number:06d}")
        system = claim.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(claim) and system.createNewFile(claim):
            return number
        number += 1


def save_model(model: PipelineModel, root: str, version: int) -> str:
    """Save under a number from `new_version`; a number is written once."""
    path = f"{root}/v{version}"
    model.write().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def log_run(spark: SparkSession, path: str, run_id: str, name: str, model_path: str, found: dict[str, float], **params) -> None:
    """Append one run to the run table."""
    row = (run_id, name, model_path, found["mae"], found["rmse"], found["r2"], json.dumps(params), dt.datetime.now(dt.timezone.utc))
    spark.createDataFrame([row], RUNS_DDL).write.mode("append").parquet(path)


def best_run(runs: DataFrame) -> DataFrame:
    """The run with the lowest test RMSE."""
    return runs.orderBy("rmse", "run_id").limit(1)
