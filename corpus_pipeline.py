"""Training-data pipeline over `documents`: quality, near-duplicates, repeated passages, mixing by source, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last return the columns of
`documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulage.llm import bpe, minhash, mixture, quality, repeats
from haulage.session import scratch


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.5 or more. The classifier learns from all labelled documents among `docs`."""
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.scorer(spark, model)(F.col("text")) >= 0.5)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by five-word shingles with a similarity of 0.8 or more.

    Rows equal in id and text are one document, and one of them stays. Rows of one id with different texts, and rows without an id,
    are documents of their own, which count as later than all others. Documents without words are linked with nothing.
    """
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", text_hash.alias("hash"))
    ids = docs.select("doc_id", text_hash.alias("hash")).groupBy("doc_id").agg(F.min("hash").alias("low"), F.max("hash").alias("high"))
    shared = ids.where("doc_id IS NULL OR low <> high").select(F.col("doc_id").alias("id"), F.lit(True).alias("shared"))
    number = F.col("doc_id").cast("long")
    if not shared.isEmpty():  # else the texts need not be shuffled for it
        rows = rows.join(shared, F.col("doc_id").eqNullSafe(F.col("id")), "left")
        own = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "hash").bitwiseAND((1 << 61) - 1).bitwiseOR(1 << 62)
        number = F.when(F.col("shared"), own).otherwise(number)
    rows = rows.select("row", "text", number.alias("number"))
    groups = minhash.groups(rows.select(F.col("number").alias("doc_id"), "text"), words=5, percent=80)
    stay = groups.where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    first = Window.partitionBy("number").orderBy("number")
    known = rows.join(stay, rows["number"] == stay["kept_id"], "left_semi")
    return known.select("row", F.row_number().over(first).alias("turn")).where("turn = 1").select("row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that start earlier in the corpus; n_chars is that of the new text."""
    return repeats.cleaned(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights take them, in the order of the curriculum."""
    return mixture.curriculum(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for each training document."""
    made = bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality classifier", keep_good),
    ("near-duplicates", keep_one),
    ("suffix-array dedup", cut_repeats),
    ("source mixture", mix_sources),
    ("BPE encoding", encode),
]

#: Compression, sketches and BPE can't be said in SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
