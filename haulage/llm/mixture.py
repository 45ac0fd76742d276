"""Mixing sources to weights that change over training time.

Each source has a weight schedule over training time 0 to 1 (straight lines between knots). The integral of the schedule is the
source's weight; weights share the wanted number of words, no source beyond a number of repeats of its own words. Within a
source the documents stand in a fixed random order, and their running word counts are the source's supply. Training time maps
to demand through the integrated schedule, so the time at which a document is reached is the inverse of that integral at its
running count. Documents sorted by this position follow the curriculum.

Running counts come in two steps, sums per bucket of a source and then sums inside a bucket, so that a source with most of the
rows is cut into many pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulage.session import scratch

Schedule = Sequence[tuple[float, float]]

#: Sources take these in turn: falling, even and rising weights, with integrals 3, 1 and 2.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 4.0), (1.0, 2.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.0), (1.0, 3.0)))
#: Wanted words as a share of all words, in percent, and the most repeats of a source.
SHARE_PERCENT, MOST_REPEATS = 150, 2
WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the order hash that name a bucket: 4,096 buckets per source.
BUCKET_DIGITS = 3


def integral(schedule: Schedule) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))


def inverse(schedule: Schedule, share: Column) -> Column:
    """Training time at which `share` (0 to 1) of the schedule's integral is reached.

    Inside a piece the demand is a quadratic; this form of its root holds for level pieces too.
    """
    whole, done, found = integral(schedule), 0.0, None
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        part = (t1 - t0) * (w0 + w1) / 2
        if part <= 0:
            continue
        need = share * whole - F.lit(done)
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + need * (2 * slope), F.lit(0.0)))
        here = F.least(F.lit(t1), F.lit(t0) + F.when(need > 0, need * 2 / (F.lit(w0) + root)).otherwise(0.0))
        done += part
        found = here if found is None else F.when(need < 0, found).otherwise(here)
    return found if found is not None else F.lit(0.0)


def words(text: Column) -> Column:
    """Number of words: runs without ASCII white space. NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    share_percent: int = SHARE_PERCENT,
    repeats: int = MOST_REPEATS,
) -> DataFrame:
    """(source, source_size, number, target) from (source, source_size), one row per source, NULL being one.

    Weights go to sources in code point order, NULL last. Sources are taken by the level (words per unit of weight) at which
    they are full; as long as the level that the rest would get lies above, they are. With no words all targets are 0.
    """
    weights = [integral(s) for s in schedules]
    if min(weights) <= 0:
        raise ValueError("a schedule needs a positive integral")
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    number = (F.row_number().over(ordered) - 1).alias("number")
    turn = sizes.select("source", "source_size", number).withColumn("turn", F.col("number") % len(weights))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("turn") + 1)
    full = turn.withColumn("weight", weight).withColumn("most", F.col("source_size") * repeats)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), "number").rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.sum("source_size").over(everything) * share_percent / F.lit(100.0)
    level = (wanted - F.coalesce(F.sum("most").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    leveled = full.withColumn("level", level).withColumn("is_full", F.col("level") * F.col("weight") > F.col("most"))
    rest = F.max(F.when(~F.col("is_full"), F.col("level"))).over(everything)
    target = F.when(F.col("is_full"), F.col("most").cast("double")).otherwise(F.col("weight") * rest)
    return leveled.withColumn("target", target).select("source", "source_size", "number", "target")


def assigned(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    share_percent: int = SHARE_PERCENT,
    repeats: int = MOST_REPEATS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Each document with what the mix takes of it, and the columns `keep` of `docs` as a struct `kept` (kept_0, kept_1, …).

    doc_id, source, size, source_size, target; supply (words of the source before it), taken (words the mix takes, repeats
    counted: the document at the end of the source's demand in part) and position, the training time at which its first words
    are reached, NULL when none are taken. NULL texts have size 0 and are taken 0 times; a NULL source is a source; repeated
    rows are documents of their own; an empty table gives no rows.
    """
    spark = docs.sparkSession
    own = ["kept"] if keep else []
    whole = [F.struct(*[F.col(name).alias(f"kept_{n}") for n, name in enumerate(keep)]).alias("kept")] if keep else []
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"), *whole
    )
    if not keep:  # small rows: counted once
        folder = scratch(spark, "mixture-sizes")
        sized.write.parquet(folder)
        sized = spark.read.schema("doc_id long, source string, size long").parquet(folder)
    sized = sized.withColumn("turn_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # `home` is the source without NULL, so that windows and joins share one shuffle by (home, bucket)
    sized = sized.withColumns({"bucket": F.substring("turn_key", 1, BUCKET_DIGITS), "home": F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))})
    sums = sized.groupBy("home", "bucket").agg(F.first("source").alias("source"), F.sum("size").alias("bucket_size"))
    goal = targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), schedules, share_percent, repeats)
    goal = goal.withColumn("home", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source")
    earlier = Window.partitionBy("home").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("home", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("bucket_start"))
    facts = starts.join(goal, "home")
    inside = Window.partitionBy("home", "bucket").orderBy("turn_key", "doc_id", "size")
    running = sized.withColumn("inside", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = running.join(facts.hint("merge"), ["home", "bucket"]).select(
        "doc_id", "source", "size", "source_size", "target", "number", (F.col("inside") + F.col("bucket_start")).alias("supply"), *own
    )
    demand = F.round("target").cast("long")
    rounds = F.when(F.col("source_size") > 0, F.floor(demand / F.col("source_size"))).otherwise(0).cast("long")
    rest = demand - rounds * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("supply")))
    placed = placed.withColumn("rounds", rounds).withColumn("part", part.cast("long"))
    placed = placed.withColumn("taken", F.col("rounds") * F.col("size") + F.col("part"))
    at = position(F.col("supply") / F.col("target"), F.col("number"), schedules)
    return placed.withColumn("position", F.when(F.col("taken") > 0, at))


def position(share: Column, number: Column, schedules: Sequence[Schedule]) -> Column:
    found = F.lit(None).cast("double")
    for turn, schedule in enumerate(schedules):
        found = F.when(number % len(schedules) == turn, inverse(schedule, share)).otherwise(found)
    return found


def curriculum(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share_percent: int = SHARE_PERCENT, repeats: int = MOST_REPEATS) -> DataFrame:
    """`docs` as the mix takes them: whole documents, as often as they are taken, sorted by training position over all partitions.

    A last partial take counts as a whole one from half of the document on. The columns are those of `docs`; documents without
    words are not taken.
    """
    names = docs.columns
    placed = assigned(docs, schedules, share_percent, repeats, keep=names)
    copies = F.col("rounds") + F.when((F.col("part") > 0) & (F.col("part") * 2 >= F.col("size")), 1).otherwise(0)
    taken = placed.where(F.col("size") > 0).withColumn("copies", copies.cast("int")).where("copies > 0")
    each = taken.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    share = (F.col("copy") * F.col("source_size") + F.col("supply")) / F.col("target")
    each = each.withColumn("place", position(F.least(share, F.lit(1.0)), F.col("number"), schedules))
    ordered = each.repartitionByRange(F.col("place"), F.col("doc_id")).sortWithinPartitions("place", "doc_id")
    return ordered.select(*[F.col(f"kept.kept_{n}").alias(name) for n, name in enumerate(names)])
