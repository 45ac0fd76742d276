"""Approximate nearest neighbours by a permutation index.

A set of pivots, a bounded sample of the vectors, orders space: a vector is represented by all pivots from the nearest to the
farthest. It is posted in the inverted files of its PREFIX nearest pivots. A query visits the files of its own PREFIX nearest
pivots, ranks what it finds by the footrule distance of the two orders (the sum of the differences in rank over all pivots), and
the nearest share of each file is reranked by the cosine of the original vectors.

Equal vectors are one class before anything is posted, so copies do not crowd a file; of a class only as many ids as can be
asked for stand for it. A long file is cut into slices and its queries into blocks; a task reads one block of queries and then
the vectors of the slice in chunks. A vector that a query meets in several files is ranked in the first of them only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm import batches

#: Pivots: a twentieth of the vectors, at most this many (ranks fit in a byte), at least PREFIX.
PIVOTS = 256
PREFIX = 14
#: Of each chunk of a file, this share, and LEAST vectors at least, are reranked.
SHARE, LEAST = 0.05, 256
SLICE, QUERIES = 4096, 1024

_FOUND = pa.schema([("query", pa.int64()), ("class", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: with an id, not NULL, without NULL or non-finite components, not zero.

    Cosines need one dimension: vectors of another than the most frequent one (ties: the smaller) take no part.
    """
    v = F.col("embedding")
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & sound)
    rows = rows.select("vec_id", F.transform("embedding", lambda x: x + F.lit(0.0)).alias("embedding"))  # -0.0 is 0.0
    sizes = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return rows.where(F.size("embedding") == (sizes[0]["size"] if sizes else 0))


def _ordered(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Pivot numbers from the nearest to the farthest, for unit vectors; ties to the smaller number."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")


def _ranks(order: np.ndarray) -> np.ndarray:
    ranks = np.empty(order.shape, np.uint8)
    np.put_along_axis(ranks, order, np.broadcast_to(np.arange(order.shape[1], dtype=np.uint8), order.shape), 1)
    return ranks


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component to about 1: directions and cosines stay as they are, and
    norms of very small or large vectors are numbers."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True, initial=0.0))
    return np.ldexp(vectors, -exponent)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _posted(pivots: np.ndarray, prefix: int):
    """A row for each of the nearest pivots of a vector."""
    schema = pa.schema([("pivot", pa.int32()), ("id", pa.int64()), ("vector", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for start in range(0, whole.num_rows, SLICE):
                part = whole.slice(start, SLICE)
                vectors = _scaled(_matrix(part.column("embedding")))
                near = _ordered(_unit(vectors), pivots)[:, :prefix].astype(np.int32)
                data = [v.tobytes() for v in vectors]
                ids = part.column("id").to_numpy()
                yield batches.rows(
                    schema, pivot=near.ravel(), id=np.repeat(ids, prefix), vector=[d for d in data for _ in range(prefix)]
                )

    return run


def _searched(pivots: np.ndarray, prefix: int, wanted: int):
    def chunk(pivot: int, queries: tuple, ids: list[int], data: list[bytes]) -> pa.RecordBatch:
        names, vectors, lengths, order, ranks = queries
        mine = np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)
        own_lengths, numbers = np.linalg.norm(mine, axis=1), np.array(ids, np.int64)
        own_ranks = _ranks(_ordered(mine / own_lengths[:, None], pivots))
        out: list[list[np.ndarray]] = [[], [], []]
        for q in range(len(names)):
            turn = int(ranks[q, pivot])
            here = np.flatnonzero(~(own_ranks[:, order[q, :turn]] < prefix).any(axis=1)) if turn else np.arange(len(ids))
            if not len(here):
                continue
            a, b = own_ranks[here], ranks[q]
            footrule = (np.maximum(a, b) - np.minimum(a, b)).sum(axis=1, dtype=np.uint32)
            most = max(LEAST, int(np.ceil(SHARE * len(ids))))
            if len(here) > most:
                here = here[np.argpartition(footrule, most - 1)[:most]]
            score = (mine[here] @ vectors[q]) / (own_lengths[here] * lengths[q])
            best = np.lexsort((numbers[here], -score))[:wanted]
            for kept, made in zip(out, (np.full(len(best), names[q]), numbers[here][best], score[best])):
                kept.append(made)
        query, name, score = (np.concatenate(o) if o else np.zeros(0) for o in out)
        return batches.rows(_FOUND, query=query.astype(np.int64), **{"class": name.astype(np.int64)}, score=score)

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked, ids, data, queries = None, [], [], [], None
        for batch in incoming:
            columns = (batch.column(c).to_pylist() for c in ("pivot", "slice", "block", "side", "id", "vector"))
            for pivot, piece, block, side, number, vector in zip(*columns):
                if (pivot, piece, block) != now:
                    if ids and queries:
                        yield chunk(now[0], queries, ids, data)
                    now, asked, ids, data, queries = (pivot, piece, block), [], [], [], None
                if side == 0:
                    asked.append((number, vector))
                    continue
                if queries is None and asked:
                    vectors = np.frombuffer(b"".join(v for _, v in asked), np.float64).reshape(len(asked), -1)
                    order = _ordered(_unit(vectors), pivots)
                    queries = (np.array([n for n, _ in asked], np.int64), vectors, np.linalg.norm(vectors, axis=1), order, _ranks(order))
                if queries:
                    ids.append(number)
                    data.append(vector)
                    if len(ids) == SLICE:
                        yield chunk(pivot, queries, ids, data)
                        ids, data = [], []
        if ids and queries:
            yield chunk(now[0], queries, ids, data)

    return run


def nearest(vectors: DataFrame, count: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by `every`, the `count` nearest others that are found.

    Nearness is the cosine in double precision; ties go to the smaller id; fewer rows where there are fewer vectors. Vectors that
    `usable` leaves out are neither queries nor found. Of rows with one id and one vector one takes part; rows with one id and
    different vectors all do, and none is found for its own id. Other columns are not looked at. The pivots are a sample of at most PIVOTS
    vectors, those with the smallest hash of their id; every vector is indexed.
    """
    spark = vectors.sparkSession
    rows = usable(vectors).dropDuplicates(["vec_id", "embedding"])
    same = Window.partitionBy("embedding").orderBy("vec_id")
    members = rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= count + 1)
    members = members.withColumn("class", F.min("vec_id").over(Window.partitionBy("embedding")))
    heads = members.where("place = 1").select(F.col("vec_id").alias("id"), "embedding")
    total = heads.count()
    amount = min(PIVOTS, max(PREFIX, total // 20))
    sample = heads.withColumn("h", F.xxhash64(F.col("id"), F.lit("pivot"))).orderBy("h", "id").limit(amount).collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    pivots = _unit(_scaled(np.array([r.embedding for r in sample], np.float64)))
    prefix = min(PREFIX, len(sample))
    asking = rows.where(F.col("vec_id") % every == 0)
    classed = asking.join(heads, "embedding").select(F.col("vec_id").alias("query_id"), F.col("id").alias("query"), "embedding")
    questions = classed.select(F.col("query").alias("id"), "embedding").dropDuplicates(["id"])
    kind = "pivot int, id long, vector binary"
    posts, asks = (f.mapInArrow(_posted(pivots, prefix), kind) for f in (heads, questions))
    count_of = lambda f, name: f.groupBy("pivot").agg(F.count("*").alias(name))
    sizes = count_of(posts.select("pivot"), "posts").join(count_of(asks.select("pivot"), "asks"), "pivot")  # one row per pivot
    cut = sizes.select("pivot", F.ceil(F.col("posts") / SLICE).alias("slices"), F.ceil(F.col("asks") / QUERIES).alias("blocks"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    one = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = asks.join(F.broadcast(cut), "pivot").withColumn("block", one("blocks")).withColumn("slice", each("slices")).withColumn("side", F.lit(0))
    right = posts.join(F.broadcast(cut), "pivot").withColumn("slice", one("slices")).withColumn("block", each("blocks")).withColumn("side", F.lit(1))
    names = ["pivot", "slice", "block", "side", "id", "vector"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = left.select(*names).unionByName(right.select(*names)).repartition(parts, "pivot", "slice", "block").sortWithinPartitions(*names[:5])
    found = met.mapInArrow(_searched(pivots, prefix, count + 1), "query long, class long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    best = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= count + 1).drop("n")
    shown = classed.select("query_id", "query").join(best, "query").join(members.select("class", "vec_id"), "class").where("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return shown.select("query_id", F.row_number().over(final).alias("rank"), "vec_id", "score").where(F.col("rank") <= count)
