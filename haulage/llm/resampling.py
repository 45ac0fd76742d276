"""Importance resampling towards a target distribution.

Documents and target texts are counted as runs of one to three words, hashed into buckets. A bucket's gain is the logarithm of how
much more often the target has it; the gains are one short array that every task holds, and a document's weight is the sum of the
array over its buckets. With noise drawn from a hash of the id (Gumbel noise, so the best scores are a sample without replacement in
proportion to the weights' exponentials), the best share of the documents is drawn.

The scores are written once. The cut is a number found by bisection: jobs count exactly how many scores lie at or beyond trial values,
and the interval shrinks until one score is left; where several documents have that score, the same search goes on over their ids,
and over row numbers for repeated ids. Only counts reach the driver. The drawn rows are range-partitioned and numbered by partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm import batches
from haulage.session import scratch

BUCKETS, LONGEST, SEED, PERCENT, LEAST_WORDS = 10_000, 3, 42, 5, 20
#: Trial values that one job counts at once: four halvings of the interval.
TRIALS = 15
NO_ID = 2**63 - 1

#: A-Z become small; of the other ASCII characters only letters and digits stay, the others part words.
_TIDY = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))

COUNTED = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
WEIGHED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TIDY).split()


def hashed(own: list[bytes], longest: int = LONGEST) -> list[int]:
    """CRC-32 of all runs of 1 to `longest` consecutive words, joined by a space: a longer run goes on from the shorter one's."""
    found = last = list(map(crc32, own))
    spaced = [b" " + w for w in own]
    for size in range(1, longest):
        last = list(map(crc32, spaced[size:], last))
        found = found + last
    return found


def counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, text_col: str = "text") -> DataFrame:
    """(bucket, n): how many features of all the whole texts fall into each bucket. Tasks add up before anything is shuffled."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in batches.slices(parts):
            for text in batches.raw(part):
                total += np.bincount(np.array(hashed(words(text), longest), np.int64) % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield batches.rows(COUNTED, bucket=used, n=total[used])

    each = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) for each bucket. `buckets` rows at most reach the driver."""
    own, wanted = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for into, texts in ((own, docs), (wanted, target)):
        for row in counts(texts, buckets, longest).collect():
            into[row.bucket] = row.n
    s, t, room = own.astype(float), wanted.astype(float), float(buckets)
    ratio = ((t + 1) * (s.sum() + room)) / ((s + 1) * (t.sum() + room))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row of `docs`."""
    buckets = len(gain)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(parts):
            n, features, weights = [], [], []
            for text in batches.raw(part):
                own = words(text)
                made = np.array(hashed(own, longest), np.int64)
                n.append(len(own))
                features.append(len(made))
                weights.append(int(gain[made % buckets].sum()))
            yield batches.rows(WEIGHED, doc_id=part.column("doc_id"), n_words=n, n_features=features, weight=weights)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise, from the first 32 bits of sha256("seed:id")."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    share = (h.cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def cut(rows: DataFrame, key: str, need: int) -> tuple[int, int, int]:
    """(x, rows below x, rows up to x): the least value x of the integer column `key` that `need` rows do not exceed. 0 < need <= rows."""
    span = rows.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("n")).first()
    low, high, before, upto = span.low, span.high, 0, span.n
    while low < high:
        width = high - low
        trial = sorted({low + width * i // (TRIALS + 1) for i in range(1, TRIALS + 1)} - {high})
        inside = rows.where(F.col(key).between(low, high))
        counted = inside.agg(*[F.count(F.when(F.col(key) <= t, 1)).alias(f"t{i}") for i, t in enumerate(trial)]).first()
        start = before
        for t, n in zip(trial, counted):
            if start + n >= need:
                high, upto = t, start + n
                break
            low, before = t + 1, start + n
    return high, before, upto


def drawn(scored: DataFrame, take: int) -> Column:
    """Which rows of `scored` (score, tie, row: longs, unique together) are the `take` with the highest scores, ties to the smaller."""
    if take <= 0:
        return F.lit(False)
    keys, rows, need = ("fall", "tie", "row"), scored.withColumn("fall", -F.col("score")), take
    found: list[int] = []
    for key in keys:
        x, before, upto = cut(rows, key, need)
        found.append(x)
        if upto == need:
            break
        rows, need = rows.where(F.col(key) == x), need - before
    chosen = None
    for key, x in reversed(list(zip(keys, found))):
        column = -F.col("score") if key == "fall" else F.col(key)
        chosen = column <= x if chosen is None else (column < x) | ((column == x) & chosen)
    return chosen


def numbered(rows: DataFrame, label: str, *order: Column) -> DataFrame:
    """`rows` with `rank`: 1, 2, 3 … in an order without ties. Ranges are written with their partition and place; one short table of
    partition sizes gives each range its first number."""
    spark, folder = rows.sparkSession, scratch(rows.sparkSession, label)
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.withColumn("__place", F.monotonically_increasing_id()).write.parquet(folder)
    placed = spark.read.parquet(folder).withColumn("__part", F.shiftright("__place", 33))
    within = F.col("__place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy("__part").agg((F.max(within) + 1).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return placed.join(starts, "__part").withColumn("rank", F.col("__before") + within + 1).drop("__part", "__place", "__before")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    seed: int = SEED,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of each row of `docs` (doc_id, text); rank is NULL for rows not drawn.

    Drawn are floor(percent/100 x rows of at least `least_words` words), highest score first, ties to the smaller id, NULL ids last,
    then in the order of the written scores. NULL and empty texts have no features and a weight of 0; repeated rows count and may be
    drawn each on its own, rows with one id share their noise; without target texts, or without rows, the counts are 0 and nothing
    fails; other columns of both tables are not looked at.
    """
    spark = docs.sparkSession
    gain = gains(docs, target, buckets, longest)
    folder = scratch(spark, "resampling")
    made = weighed(docs, gain, longest).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    made = made.withColumns({"tie": F.coalesce("doc_id", F.lit(NO_ID)), "row": F.monotonically_increasing_id()})
    made.write.parquet(folder)
    scored = spark.read.schema(made.schema).parquet(folder)
    able = scored.where(F.col("n_words") >= least_words)
    chosen = (F.col("n_words") >= least_words) & drawn(able, able.count() * percent // 100)
    best = numbered(scored.where(chosen), "resampling-ranks", F.col("score").desc(), F.col("tie"), F.col("row"))
    rest = scored.where(~chosen).withColumn("rank", F.lit(None).cast("long"))
    return best.select(rest.columns).unionByName(rest).drop("tie", "row")
