"""What has been ingested already: replays are dropped, corrections are told apart from them.

A document is known by its key columns; its content is a hash of all other columns but those of the ingest. Of the same key and
content one is kept, whenever the others come. A known key with other content is a correction: it is kept, and the versions before it
are listed as superseded. The index has one short row per version (two hashes of the key, one of the content), in `deltas` buckets by
the first key column, so that a micro-batch is compared with the buckets and the id range it touches, and not with the table.

Rows whose first key column is NULL can't be told apart: they are all kept, unless `null_is_key` says that NULL is a key like others.
Without `by_content` a known key is a replay whatever it says.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulage.operators.lookup import sized
from haulage.session import STORED, discard, take
from haulage.streaming.deltas import Deltas, bucket

#: Columns that say how a row came in, not what it says.
INGEST = ("arquivo_origem", "data_ingestao", "arquivo_momento")
NULL_KEY = -(2**63)
_VERSION = "_perto long, _um long, _dois long, _conteudo long, origem long"


def _identity(keys: Sequence[str], seed: int) -> Column:
    """A hash of the key columns in which NULLs keep their place."""
    return F.xxhash64(F.lit(seed), *[x for k in keys for x in (F.col(k).isNull(), F.col(k))])


def tagged(rows: DataFrame, keys: Sequence[str], by_content: bool = True, null_is_key: bool = False) -> DataFrame:
    """`rows` with the index columns."""
    first = F.col(keys[0])
    integral = dict(rows.dtypes)[keys[0]] in ("bigint", "int", "smallint", "tinyint")
    said = [c for c in rows.columns if c not in INGEST]
    near = first.cast("bigint") if integral else F.when(first.isNotNull(), F.xxhash64(first))
    made = rows.withColumns(
        {
            "_perto": F.coalesce(near, F.lit(NULL_KEY)) if null_is_key else near,
            "_um": _identity(keys, 1),
            "_dois": _identity(keys, 2),
            "_conteudo": F.xxhash64(F.to_json(F.struct(*said))) if by_content else F.lit(0).cast("bigint"),
        }
    )
    return made.withColumn("balde", bucket(F.col("_perto")))


@dataclass(frozen=True)
class Seen:
    """The index at `path` of documents with the key columns `keys`; `key_ddl` are their types, for the superseded versions."""

    path: str
    keys: Sequence[str]
    key_ddl: str
    by_content: bool = True
    null_is_key: bool = False

    @property
    def index(self) -> Deltas:
        return Deltas(f"{self.path}/indice", _VERSION, ("_perto", "_um"))

    @property
    def old(self) -> Deltas:
        """Superseded versions: the key columns and `origem`, the micro-batch that had stored them."""
        return Deltas(f"{self.path}/superados", f"{self.key_ddl}, origem long", tuple(self.keys))

    def matching(self, batch: DataFrame, number: int) -> DataFrame:
        """Stored versions, from before micro-batch `number`, in the buckets and the range of ids that `batch` touches.

        At most one value per bucket comes to the driver.
        """
        span = (F.collect_set("balde").alias("baldes"), F.min("_perto").alias("low"), F.max("_perto").alias("high"))
        touched = batch.agg(*span).first()
        within = F.col("balde").isin(list(touched.baldes)) & F.col("_perto").between(touched.low, touched.high)
        return self.index.read(batch.sparkSession, number, within)

    @staticmethod
    def newest(rows: DataFrame) -> DataFrame:
        """One row per key of a tagged micro-batch: that of the newest file, then the first by content."""
        newest = [F.col(c).desc() for c in ("arquivo_momento",) if c in rows.columns]
        turn = F.row_number().over(Window.partitionBy("_um", "_dois").orderBy(*newest, "_conteudo"))
        return rows.withColumn("_turno", turn).where("_turno = 1").drop("_turno")

    def add(self, batch: DataFrame, number: int, table: str) -> None:
        """Store what micro-batch `number` has that is new, in `<table>/lote=<number>`, and bring the index forward.

        Every write replaces that of an earlier attempt and looks at smaller numbers only, so a batch may be tried again at any point.
        The documents are read once and written beside the table, where no reader looks; what is new is decided on their short tags. If
        that is all of them, the folder takes its place in the table, else those to keep are read again from there; only those that come
        several times in the batch are shuffled.
        """
        spark, place, aside = batch.sparkSession, f"{table}/lote={number}", f"{table}/_novos/lote={number}"
        tagged_rows = tagged(batch, self.keys, self.by_content, self.null_is_key).drop("_um", "_dois", "balde")
        tagged_rows.write.mode("overwrite").options(**STORED).parquet(aside)  # the short hashes stay with the rows, for the index
        rows = spark.read.schema(tagged_rows.schema).parquet(aside).withColumns(
            {"_um": _identity(self.keys, 1), "_dois": _identity(self.keys, 2), "balde": bucket(F.col("_perto"))}
        )
        versions = ["_um", "_dois", "_conteudo"]
        tags = rows.select("_perto", "balde", *versions, *self.keys)
        fresh = tags.where("_perto IS NOT NULL")
        stored = self._stored(spark, number, tags)
        if stored is not None:
            fresh = fresh.join(stored.select(versions), versions, "left_anti")
            gone = fresh.select(*self.keys, "balde", "_um", "_dois").join(stored.select("_um", "_dois", "origem"), ["_um", "_dois"])
            gone = gone.drop("_um", "_dois").distinct()
            if not gone.isEmpty():
                self.old.write(gone, number)
        counts = [F.count(F.lit(1)).alias("_n"), F.first("_conteudo").alias("_conteudo")]
        sizes = fresh.groupBy("_um", "_dois").agg(*counts).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            kept = self._chosen(rows, tags, fresh, sizes, versions)
            if kept is rows:
                take(spark, aside, place)
            else:
                kept.drop("_um", "_dois", "balde").write.mode("overwrite").options(**STORED).parquet(place)
                discard(spark, aside)
        finally:
            sizes.unpersist()
        written = spark.read.schema(tagged_rows.schema).parquet(place).where("_perto IS NOT NULL")
        entries = written.select(
            "_perto", _identity(self.keys, 1).alias("_um"), _identity(self.keys, 2).alias("_dois"), "_conteudo", F.lit(number).cast("long").alias("origem")
        )
        self.index.write(entries.withColumn("balde", bucket(F.col("_perto"))), number)
        self.index.compact(spark, number + 1, lambda all_rows: all_rows.drop("lote"))
        self.old.compact(spark, number + 1, lambda all_rows: all_rows.drop("lote"))

    def _stored(self, spark: SparkSession, number: int, tags: DataFrame) -> DataFrame | None:
        """`matching` of a batch, None if there is nothing: then the documents are compared with one another only."""
        if self.index.parts(spark, number) == (None, []):
            return None
        found = self.matching(tags.where("_perto IS NOT NULL"), number)
        return None if found.isEmpty() else found

    def _chosen(self, rows: DataFrame, tags: DataFrame, fresh: DataFrame, sizes: DataFrame, versions: list[str]) -> DataFrame:
        """Of tagged `rows`, one per key that is in `fresh`, and all without a key. `sizes` has the rows of each key of `fresh`.

        The rows meet the versions that come once, or those of all other documents, whichever are fewer: by broadcast while these are
        small.
        """
        total, known = tags.agg(F.count(F.lit(1)), F.count("_perto")).first()
        once, several = sizes.agg(F.count_if(F.col("_n") == 1), F.count_if(F.col("_n") > 1)).first()
        if once == known:
            return rows
        single, with_key = sizes.where("_n = 1").select(versions), rows.where("_perto IS NOT NULL")
        if known - once < once:
            others = tags.where("_perto IS NOT NULL").join(single, versions, "left_anti").select(versions).distinct()
            found = with_key.join(sized(others), versions, "left_anti")
        else:
            found = with_key.join(sized(single), versions, "left_semi")
        if several:
            again = fresh.join(sizes.where("_n > 1").select("_um", "_dois"), ["_um", "_dois"], "left_semi").select(versions).distinct()
            found = found.unionByName(self.newest(with_key.join(sized(again), versions, "left_semi")))
        return found if known == total else found.unionByName(rows.where("_perto IS NULL"))

    def current(self, rows: DataFrame) -> DataFrame:
        """`rows` (with key columns and `lote`, the micro-batch they come from) without superseded versions.

        Without corrections it is `rows` itself; their few keys are one side of an anti join.
        """
        spark = rows.sparkSession
        if self.old.parts(spark) == (None, []):
            return rows
        return self.among(rows, self.old.read(spark), "left_anti")

    def among(self, rows: DataFrame, versions: DataFrame, how: str) -> DataFrame:
        """Join of `rows` to versions (key columns, origem), over the key columns that `rows` has."""
        keys = [k for k in self.keys if k in rows.columns]
        gone = versions.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.col("origem").alias("_s_lote")).distinct()
        same = F.col("lote") == F.col("_s_lote")
        for k in keys:
            same &= F.col(k).eqNullSafe(F.col(f"_s_{k}"))
        return rows.join(gone, same, how)
