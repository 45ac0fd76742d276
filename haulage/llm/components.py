"""Connected components of a graph of ids, by Spark joins with written tables between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.session import scratch


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in the links (a, b): the smallest id that is reachable.

    Each round takes the least label among the neighbours and then the label of that label, so distances halve. A round's
    labels are a written table, which cuts lineage and survives lost executors. Nothing but counts comes to the driver.
    """
    spark = edges.sparkSession
    folder = scratch(spark, "links")
    both = edges.where("a <> b").select("a", "b")
    both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().write.parquet(folder)
    links = spark.read.schema("a long, b long").parquet(folder)
    labels = _kept(links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least")).select("id", F.least("id", "least").alias("component")))
    while True:
        near = links.join(labels.select(F.col("id").alias("b"), F.col("component").alias("label")), "b")
        least = near.groupBy(F.col("a").alias("id")).agg(F.min("label").alias("label"))
        moved = labels.join(least, "id").select("id", F.least("component", "label").alias("next"), F.col("component").alias("old"))
        up = labels.select(F.col("id").alias("next"), F.col("component").alias("above"))
        jumped = moved.join(up, "next", "left").select("id", F.least("next", F.coalesce("above", "next")).alias("component"), "old")
        fresh = _kept(jumped)
        changed = fresh.where("component <> old").limit(1).count()
        labels = fresh.select("id", "component")
        if not changed:
            return labels


def _kept(frame: DataFrame) -> DataFrame:
    folder = scratch(frame.sparkSession, "labels")
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)
