"""Splitting of hot keys: equi-joins with a heavy key and numbering inside a heavy group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulage.operators.lookup import sized
from haulage.session import STORED, discard, scratch

# A key is hot when it holds more than this share of all rows, so there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001
LEAST_ROWS = 200_000
# Rows of one group that are sorted in one task, and pieces for each such number of rows when a group is cut.
ROWS_PER_TASK, FINER = 1_000_000, 4


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, least: int = LEAST_ROWS
) -> DataFrame:
    """Keys above max(share of all rows, least), with the number of slices each should be cut into.

    The counts are combined on the map side, and their exchange serves the total too. The result has fewer than 1 / share rows whatever the
    input, which is what allows `salted` to broadcast it.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_n")).scalar()
    limit = F.greatest(total * F.lit(share), F.lit(float(least)))
    return sizes.filter(F.col("_n") > limit).select(
        *keys, F.ceil(F.col("_n") / limit).cast("int").alias("_slices")
    )


def salted(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[Column | str],
    share: float = HOT_SHARE,
    least: int = LEAST_ROWS,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both inputs of an equi-join on `keys`, with a slice column that cuts the hot keys of `big`.

    Rows of `big` get one slice by hash of `spread_by`; rows of `small` are repeated once per slice of
    their key. Joining on the returned keys gives the same pairs as joining on `keys`.
    """
    hot = F.broadcast(hot_keys(big, keys, share, least))
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    left = (
        big.join(hot, list(keys), "left")
        .withColumn("_slice", F.pmod(F.xxhash64(*spread_by), slices).cast("int"))
        .drop("_slices")
    )
    right = (
        small.join(hot, list(keys), "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_slices")
    )
    return left, right, [*keys, "_slice"]


def _rising(df: DataFrame, column: str) -> Column | None:
    """A whole number that is ordered like the column and differs where it differs; None for types that have none."""
    kind, value = df.schema[column].dataType.typeName(), F.col(f"`{column}`")
    if kind in ("byte", "short", "integer", "long"):
        return value.cast("long")
    if kind == "timestamp":
        return F.unix_micros(value)
    if kind == "timestamp_ntz":  # by its own clock: a cast would fold the hour that a time zone skips
        seconds = F.unix_date(value.cast("date")).cast("long") * 86_400 + F.hour(value) * 3_600 + F.minute(value) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("long")
    return F.unix_date(value).cast("long") if kind == "date" else None


def _beside(rows: DataFrame, table: DataFrame, keys: Sequence[str], by_path: bool) -> DataFrame:
    """`rows` with the columns of a table of few rows per key (and path), NULL keys included."""
    names = {k: f"_k{i}" for i, k in enumerate(keys)} | {"_path": "_at"}
    same = F.col("_path") == F.col("_at") if by_path else F.lit(True)
    for k in keys:
        same = same & rows[k].eqNullSafe(F.col(names[k]))
    return rows.join(sized(table.withColumnsRenamed(names)), same, "left").drop(*names.values())


def _measured(rows: DataFrame, by: Sequence[str], numbers: Sequence[Column]) -> DataFrame:
    """Rows of each group, and for each number its least, its greatest and how often it is missing."""
    spans = [F.struct(F.min(n).alias("lo"), F.max(n).alias("hi"), F.count_if(n.isNull()).alias("gaps")) for n in numbers]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.array(*spans).alias("_spans"))


def _cuts(leaves: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """The groups of over `most` rows with the first number that varies in them and the pieces to cut its span into."""
    varies = lambda s: (s["lo"] < s["hi"]) | ((s["gaps"] > 0) & (s["gaps"] < F.col("_n")))
    at = F.array_position(F.transform("_spans", lambda s: F.coalesce(varies(s), F.lit(False))), F.lit(True))
    pieces = F.least(F.ceil(F.col("_n") / F.lit(most)) * FINER, F.lit(1 << 20)).cast("int")
    found = leaves.where(F.col("_n") > most).withColumn("_which", at.cast("int")).where("_which > 0")
    span = F.element_at("_spans", F.col("_which"))
    return found.select(*keys, "_path", "_which", span["lo"].alias("_lo"), span["hi"].alias("_hi"), pieces.alias("_pieces"))


def _written(frame: DataFrame, folder: str) -> DataFrame:
    frame.write.options(**STORED).parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def kept(frame: DataFrame, label: str) -> DataFrame:
    """`frame` as a written table."""
    return _written(frame, scratch(frame.sparkSession, label))


@contextmanager
def held(frame: DataFrame, label: str) -> Iterator[DataFrame]:
    """`frame` as a written table that is deleted at the end."""
    folder = scratch(frame.sparkSession, label)
    try:
        yield _written(frame, folder)
    finally:
        discard(frame.sparkSession, folder)


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    index: str = "indice",
    total: str = "total",
    most: int = ROWS_PER_TASK,
) -> DataFrame:
    """Position (from 1) and size of each row's group, without bringing a group of over `most` rows into one task.

    Rows are counted per key, combined before the shuffle. Without a group of over `most` rows a plain window follows. Otherwise
    the large groups are cut into ranges of the first order column; ranges that still hold over `most` rows are cut again between
    their own least and greatest value, by the next order column where the first is the same for all. What is kept of that are
    counts by key and range; their running sums are added to the numbers that rows get within their range. `df` is read once for
    each round of counts and once for the result; no copy of it is made, so `df` must give the same rows each time.

    Whole numbers, dates and timestamps can be cut; columns from the first of another type on cannot, and rows that agree in all
    columns before it stay in one task. `order` must end in a column that is unique within a group. NULLs come first; NULL keys
    are a group like others, and an empty `df` gives no rows.
    """
    numbers = []
    for column in order:
        number = _rising(df, column)
        if number is None:
            break
        numbers.append(number)
    whole = Window.partitionBy(*keys)
    leaves = None
    if numbers:
        sizes = _measured(df, keys, numbers).where(F.col("_n") > most)
        leaves = kept(sizes.withColumn("_path", F.array().cast("array<int>")), "sizes")
    if leaves is None or leaves.isEmpty():
        place = F.row_number().over(whole.orderBy(*order)).cast("bigint")
        return df.select("*", place.alias(index), F.count(F.lit(1)).over(whole).alias(total))

    rows = _beside(df, leaves.select(*keys, F.col("_path").alias("_start")), keys, False).withColumnRenamed("_start", "_path")
    cuts = _cuts(leaves, keys, most)
    while not cuts.isEmpty():
        value = F.coalesce(*[F.when(F.col("_which") == i, n) for i, n in enumerate(numbers, start=1)]).cast("double")
        share = F.try_divide(value - F.col("_lo").cast("double"), F.col("_hi").cast("double") - F.col("_lo").cast("double"))
        piece = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * F.col("_pieces")), F.col("_pieces") - 1).cast("int")
        longer = F.concat("_path", F.array(F.when(value.isNull(), F.lit(-1)).otherwise(piece)))
        path = F.when(F.col("_which").isNull(), F.col("_path")).otherwise(longer)
        rows = _beside(rows, cuts, keys, True).withColumn("_path", path).select(*df.columns, "_path")
        before = leaves
        leaves = kept(_measured(rows.where("_path IS NOT NULL"), [*keys, "_path"], numbers), "ranges")
        cuts = _cuts(leaves, keys, most)
        if leaves.count() == before.count():  # values too close to be told apart as doubles
            break

    running = whole.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    offsets = leaves.select(
        *keys, "_path", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_total")
    )
    local = Window.partitionBy(*keys, "_path")
    place = F.row_number().over(local.orderBy(*order)).cast("bigint") + F.coalesce("_before", F.lit(0))
    size = F.coalesce("_total", F.count(F.lit(1)).over(local))
    return _beside(rows, offsets, keys, True).select(*df.columns, place.alias(index), size.alias(total))
