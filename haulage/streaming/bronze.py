"""Incremental ingest of the landing folders into append-only bronze tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from haulage.sources.landing import read_options
from haulage.sources.schemas import struct
from haulage.streaming.seen import Seen


def landing_stream(
    spark: SparkSession, path: str, ddl: str, layout: str = "array", max_files: int | None = None
) -> DataFrame:
    """New files of a folder, each read once; with the file of origin and the time of ingest.

    `max_files` bounds a micro-batch, so a large backlog is worked off in even pieces.
    """
    reader = spark.readStream.format("json").schema(struct(ddl)).options(**read_options(layout))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.load(path)
        .withColumn("arquivo_origem", F.col("_metadata.file_path"))
        .withColumn("arquivo_momento", F.col("_metadata.file_modification_time"))
        .withColumn("data_ingestao", F.current_timestamp())
    )


def table_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New rows of an upstream table written by `append`."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def share_of_files(spark: SparkSession, path: str, batches: int, least: int) -> int:
    """Files for a micro-batch so that the backlog at `path` takes about `batches` of them, whatever its size; `least` at least."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found, files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(place, True), 0
    while found.hasNext():
        files += not found.next().getPath().getName().startswith(("_", "."))
    return max(least, -(-files // batches))


def append(df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Write everything that is available now, then stop. A later call goes on where this one ended."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(path)


def append_new(df: DataFrame, path: str, checkpoint: str, keys: list[str], index: str | None = None) -> StreamingQuery:
    """Like `append`, without rows whose keys are stored already, however late either of them comes: see `seen`. NULL keys are equal
    to one another.

    Each micro-batch becomes `<path>/lote=<number>` whole, so one that runs again after a failure replaces itself. What has been
    seen is an index beside the checkpoint (or at `index`), of which a batch reads the buckets it touches.
    """
    types = dict(df.dtypes)
    given = ", ".join(f"{k} {types[k]}" for k in keys)
    known = Seen(index or f"{checkpoint}-vistos", tuple(keys), given, by_content=False, null_is_key=True)
    return each_batch(df, checkpoint, lambda batch, number: known.add(batch, number, path))


def each_batch(df: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """`step` for each micro-batch of what is available now."""
    return df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for the end; a failed query raises here."""
    query.awaitTermination()
    return query


def finish_all(queries: list[StreamingQuery]) -> None:
    """Wait for queries that run side by side. All of them end before the first failure is raised."""
    failed = None
    for query in queries:
        try:
            finish(query)
        except Exception as error:  # noqa: BLE001 - raised below
            failed = failed or error
    if failed:
        raise failed
