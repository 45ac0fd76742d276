"""JSON landing folders: batch read and distributed export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.session import discard
from haulage.sources.schemas import struct

ORDERS_PER_FILE = 500
EVENTS_PER_FILE = 1000
# "array": one JSON array per file, as external producers write. "lines": one document per line, which Spark
# reads row by row, so large exports should use it.
LAYOUTS = ("array", "lines")
# A large export lands in about so many files, while these stay within the documents that one file may hold. An array is read as a whole.
FILES = 128
MOST_IN_FILE = {"array": 5_000, "lines": 10_000}


def read_options(layout: str) -> dict[str, str]:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    return {"multiLine": str(layout == "array").lower()}


def read_json(spark: SparkSession, path: str, ddl: str, layout: str = "array") -> DataFrame:
    return spark.read.schema(struct(ddl)).options(**read_options(layout)).json(path)


def per_file(documents: int, least: int, layout: str = "lines") -> int:
    """Documents of a file in an export of so many: each file costs its writer, its reader and the driver something, however short it is."""
    return max(least, min(MOST_IN_FILE[layout], -(-documents // FILES)))


def _pack(documents: DataFrame, per_file: int) -> DataFrame:
    """JSON texts joined into arrays of `per_file`, batch by batch inside each task."""

    def pack(batches):
        import pandas as pd

        held: list[str] = []
        for batch in batches:
            held.extend(batch["value"])
            while len(held) >= per_file:
                yield pd.DataFrame({"value": ["[" + ",\n".join(held[:per_file]) + "]"]})
                held = held[per_file:]
        if held:
            yield pd.DataFrame({"value": ["[" + ",\n".join(held) + "]"]})

    return documents.mapInPandas(pack, "value string")


def write_json(
    df: DataFrame, path: str, per_file: int, layout: str = "lines", mode: str = "error", compression: str = "none"
) -> None:
    """Export with at most `per_file` documents per file; every task writes its own files.

    Readers tell the compression by the suffix. A compressed file is read by one task, so `per_file` bounds its work in either layout.
    Landing files are read once, so gzip is asked for speed.
    """
    read_options(layout)
    quick = {"zlib.compress.level": "BEST_SPEED"} if compression == "gzip" else {}
    if layout == "lines":
        df.write.mode(mode).options(**quick).option("maxRecordsPerFile", per_file).option("compression", compression).json(path)
    else:
        texts = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
        _pack(texts, per_file).write.mode(mode).options(**quick).option("maxRecordsPerFile", 1).option("compression", compression).text(path)


def write_orders(nested: DataFrame, path: str, layout: str = "lines", mode: str = "error", documents: int = 0) -> None:
    """Nested order documents, timestamps as text; compressed, as they repeat their field names in every item. `documents`: about as
    many, see `per_file`."""
    write_json(nested, path, per_file(documents, ORDERS_PER_FILE, layout), layout, mode, "gzip")


def write_events(events: DataFrame, path: str, layout: str = "lines", mode: str = "error", documents: int = 0) -> None:
    write_json(events, path, per_file(documents, EVENTS_PER_FILE, layout), layout, mode, "gzip")


def clear(spark: SparkSession, path: str) -> None:
    """Delete the files of a landing folder, for a producer whose readers have all ingested them; the folder stays for the next ones."""
    discard(spark, path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
