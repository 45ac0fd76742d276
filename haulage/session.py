"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

#: Codec of the tables that the library writes, and how hard it tries: about half the size of the default one.
STORED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}


def build(app: str = "haulage", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above. `master` is for local runs; a cluster brings its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local-master session without that setting gets a temporary folder; on a cluster a missing
    setting is an error, since executors could not see a folder of the driver's machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="haulage-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the scratch root."""
    return f"{scratch_root(spark).rstrip('/')}/haulage/{label}-{uuid.uuid4().hex}"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of jobs in here go with their job, not when the driver happens to collect its garbage. A job that needs them again
    makes them anew. Streams started in here go by it too."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def take(spark: SparkSession, path: str, place: str) -> None:
    """Give a written folder its place, instead of what is there."""
    jvm = spark._jvm
    given, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(place)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(target, True)
    if not system.rename(given, target):
        raise OSError(f"{path} was not moved to {place}")
