"""Quality by compression: which of two zstandard dictionaries, from good or from bad text, makes a text smaller.

Each text is cut into blocks, and each block is compressed alone with either dictionary, so that the whole text counts and not
only its beginning. The difference of the two sizes over their sum, beside the logarithm of their sum over the text's own size
(text that repeats itself is small with either), goes into a logistic curve that gives the probability of label 1. The
dictionaries come from one half of the learning rows and the curve from the other half, on which the dictionaries are new.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm import batches

#: Learning rows per class, about: chosen by a hash of their id (the documented bound of this fit). Scoring covers all rows.
LEARNED_PER_CLASS = 3_000
#: Blocks of learning text per class that the driver holds, about, chosen by a hash of their place.
LEARNED_BLOCKS = 6_000
BLOCK_BYTES = 1_024
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
#: Added to sizes before they are divided: a few bytes more or less say little about a short text.
EVEN_BYTES = 100


@dataclass
class Model:
    """Two dictionaries and the curve 1 / (1 + exp(-(a + b * difference + c * density)))."""

    good: bytes
    bad: bytes
    a: float
    b: float = 0.0
    c: float = 0.0

    def probability(self, difference: float, density: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, self.a + self.b * difference + self.c * density))))


class Measure:
    """Compressed sizes of a text with either dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=BLOCK_BYTES, dict_size=DICTIONARY_BYTES, write_content_size=False, write_dict_id=False, write_checksum=False
        )
        self.tools = []
        for content in (good, bad):
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_AUTO)
            shared.precompute_compress(compression_params=params)
            self.tools.append(zstandard.ZstdCompressor(dict_data=shared, compression_params=params).compress)

    def of(self, text: bytes | None) -> tuple[float, float]:
        """(bad - good) / (bad + good), above 0 when the good dictionary helps more; and log((bad + good) / size): evened out.

        NULL and empty texts give 0 and 0.
        """
        if not text:
            return 0.0, 0.0
        good, bad = self.tools
        g = b = 0
        for at in range(0, len(text), BLOCK_BYTES):
            block = text[at : at + BLOCK_BYTES]
            g += len(good(block))
            b += len(bad(block))
        return (b - g) / (b + g + EVEN_BYTES), math.log((b + g + EVEN_BYTES) / (len(text) + EVEN_BYTES))


def _curve(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Logistic regression, constant first: Newton steps with a little shrinkage, so separable data stay finite."""
    scale = np.abs(x).mean(axis=0)
    scale[scale == 0] = 1.0
    z = np.column_stack([np.ones(len(x)), x / scale])
    shrink = np.array([1e-6] + [0.01] * x.shape[1])
    w = np.zeros(z.shape[1])
    for _ in range(80):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -700, 700)))
        step = np.linalg.solve((z * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ z + np.diag(shrink), z.T @ (y - p) - shrink * w)
        w = w + step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w / np.concatenate([[1.0], scale])]


def learn(docs: DataFrame, labels: DataFrame, per_class: int = LEARNED_PER_CLASS, blocks: int = LEARNED_BLOCKS) -> Model:
    """Fit on documents that have a label 0 or 1; rows with NULL text, id or label are not used.

    A document with several labels takes the largest. With one class missing there is nothing to tell apart: every text then
    scores the share of label 1 among the learning rows (0.5 without any).
    """
    marks = labels.where("quality IN (0, 1)").groupBy(F.col("doc_id").alias("doc_id")).agg(F.max("quality").alias("quality"))
    sizes = {r.quality: r["count"] for r in marks.groupBy("quality").count().collect()}
    share = F.lit(0.0)
    for quality, n in sizes.items():
        share = F.when(F.col("quality") == quality, min(1.0, per_class / n)).otherwise(share)
    spread = lambda *c: F.shiftrightunsigned(F.xxhash64(*c), 1) / F.lit(2.0**63)
    chosen = marks.where(spread("doc_id") < share)
    used = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # about 2 * per_class rows
    used = used.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)))
    cut = pa.schema([("quality", pa.int32()), ("block", pa.binary()), ("pick", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for part in batches.slices(parts):
            out: list[tuple] = []
            for quality, text in zip(part.column("quality").to_pylist(), batches.raw(part)):
                for at in range(0, len(text), BLOCK_BYTES):
                    block = text[at : at + BLOCK_BYTES]
                    out.append((quality, block, xxhash.xxh3_64_intdigest(block, at) >> 1))
            yield batches.rows(cut, **{n: [o[i] for o in out] for i, n in enumerate(cut.names)})

    pieces = used.where("half = 0").select("quality", "text").mapInArrow(run, "quality int, block binary, pick long")
    counts = {r.quality: r["count"] for r in pieces.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return Model(b"", b"", _logit(sizes.get(1, 0), sum(sizes.values())))
    limit = F.lit(0.0)
    for quality, n in counts.items():
        limit = F.when(F.col("quality") == quality, min(1.0, blocks / n)).otherwise(limit)
    held = pieces.where(F.col("pick") / F.lit(2.0**63) < limit).orderBy("quality", "pick", "block").collect()
    good, bad = (_dictionary([bytes(r.block) for r in held if r.quality == q]) for q in (1, 0))
    measured = used.where("half = 1").select("quality", "text").mapInArrow(_measures(good, bad), "quality int, difference double, density double")
    rows = sorted(tuple(r) for r in measured.collect())
    y, x = np.array([r[0] for r in rows], float), np.array([r[1:] for r in rows], float)
    return Model(good, bad, *(_curve(x, y) if len(set(y)) == 2 else [_logit(sizes.get(1, 0), sum(sizes.values()))]))


def _logit(ones: int, total: int) -> float:
    p = (ones + 0.5) / (total + 1.0)
    return math.log(p / (1 - p))


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained zstandard dictionary, or the samples themselves where there are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _measures(good: bytes, bad: bytes):
    schema = pa.schema([("quality", pa.int32()), ("difference", pa.float64()), ("density", pa.float64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measure(good, bad)
        for part in batches.slices(parts):
            made = [measure.of(t) for t in batches.raw(part)]
            yield batches.rows(schema, quality=part.column("quality"), difference=[m[0] for m in made], density=[m[1] for m in made])

    return run


def scorer(spark: SparkSession, model: Model):
    """A function of a text column: the probability of label 1. NULL and empty texts get the curve's constant."""
    given = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted: Model = given.value
        measure = Measure(fitted.good, fitted.bad) if fitted.good else None
        for texts in parts:
            found = [fitted.probability(*(measure.of(t.encode() if t else None) if measure else (0.0, 0.0))) for t in texts]
            yield pd.Series(found, dtype="float64")

    return score


def judged(spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted): learn from rows whose CRC-32 of the id's digits leaves another remainder than `held`."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds
    model = learn(docs.where(fold != held), labels.where(fold != held))
    score = scorer(spark, model)(F.col("text").cast("string")).alias("score")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold == held).alias("held_out"), score)
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
