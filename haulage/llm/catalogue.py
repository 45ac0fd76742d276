"""One named query for each corpus operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from haulage.llm import anchors, bpe, language, minhash, mixture, neighbours, packing, periods, prints, quality, records, repeats, resampling
from haulage.llm.statements import ORACLE
from haulage.session import scratch

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(spark, _documents(spark, sf_dir), PIECES)


def op2_permutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(spark, _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "records")
    records.write(_documents(spark, sf_dir), folder, BYTE_BPE)
    return records.read(spark, folder, digest_only=True)


def op5_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.removed(_documents(spark, sf_dir))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prints.neighbours(_documents(spark, sf_dir))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed(_documents(spark, sf_dir))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(_documents(spark, sf_dir), words=3, percent=85)


def op9_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_documents(spark, sf_dir), WORD_BPE)


def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture.assigned(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "position")
    return mixed.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digests(periods.found(periods.doubled(_documents(spark, sf_dir))))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resampled(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(_documents(spark, sf_dir), WORD_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_language": op1_language,
    "op2_permutations": op2_permutations,
    "op3_quality": op3_quality,
    "op4_records": op4_records,
    "op5_anchors": op5_anchors,
    "op6_fingerprints": op6_fingerprints,
    "op7_repeats": op7_repeats,
    "op8_minhash": op8_minhash,
    "op9_bpe_trie": op9_bpe_trie,
    "op10_mixture": op10_mixture,
    "op11_periods": op11_periods,
    "op12_resampling": op12_resampling,
    "op13_packing": op13_packing,
}

__all__ = ["ORACLE", "QUERIES"]
