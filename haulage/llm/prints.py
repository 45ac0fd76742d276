"""Document fingerprints from polynomial prefix hashes.

Code points are the coefficients of a polynomial; prefix arrays hold its value modulo two primes after each code point. The
hash of any span follows from two entries, so the equality of any two spans is one comparison, and the longest common extension
of two places is found by binary search over span lengths.

A fingerprint holds the length, the hash of the whole text and a sketch of its spans: the spans of SPAN code points are dealt to
SLOTS slots by their hash, and each slot keeps 16 bits of its smallest; empty slots borrow from the next full one. The share of equal
slots estimates how many spans two texts have in common. Texts shorter than a span are one span. Short texts, and those up to twice
their length, have a second sketch of shorter spans, on which a short text is compared with any of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.llm import batches

PRIMES = (2_147_483_629, 2_147_483_587)  # the largest two below 2**31 - 1: products fit in 64 bits
BASES = (1_000_003_571, 1_700_001_089)
SPAN, SLOTS = 12, 64
#: Texts below this length are compared on spans of SHORT_SPAN code points, else an edit would touch each of their few spans. Those
#: below twice this length have both sketches.
SHORT, SHORT_SPAN = 48, 3
_INVERSES = tuple(pow(base, -1, prime) for base, prime in zip(BASES, PRIMES))
_TABLES: list[np.ndarray] = [np.ones(1, np.uint64) for _ in range(4)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers 0 to n of the bases, and of their inverses, modulo the primes; made by doubling and kept."""
    for k, (prime, base) in enumerate(zip(PRIMES * 2, BASES + _INVERSES)):
        have = _TABLES[k]
        while len(have) <= n:
            step = np.uint64(pow(base, len(have), prime))
            have = np.concatenate([have, have * step % np.uint64(prime)])
        _TABLES[k] = have
    return _TABLES


class Prefixes:
    """Prefix arrays of one sequence of code points."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        values = points.astype(np.uint64) + np.uint64(1)
        self.arrays = []
        for prime, power in zip(PRIMES, _powers(self.n)[:2]):
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(values * power[: self.n] % np.uint64(prime), out=sums[1:])
            self.arrays.append(sums % np.uint64(prime))

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Hash of the code points from `start` to `end`, alike wherever such a span stands."""
        a, b = (
            (int(sums[end]) - int(sums[start])) % prime * int(back[start]) % prime
            for prime, sums, back in zip(PRIMES, self.arrays, _powers(self.n)[2:])
        )
        return a, b

    def spans(self, length: int) -> np.ndarray:
        """Hashes of all spans of `length` code points, both residues in one 64-bit word."""
        count = self.n - length + 1
        found = np.zeros(count, np.uint64)
        for prime, sums, back in zip(PRIMES, self.arrays, _powers(self.n)[2:]):
            p = np.uint64(prime)
            found = (found << np.uint64(31)) ^ ((sums[length:] + p - sums[:count]) % p * back[:count] % p)
        return found


def equal(a: Prefixes, i: int, b: Prefixes, j: int, length: int) -> bool:
    """Whether `length` code points of `a` from `i` equal those of `b` from `j`."""
    if i + length > a.n or j + length > b.n:
        return False
    return a.span(i, i + length) == b.span(j, j + length)


def common(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """Length of the longest common extension: how far `a` from `i` and `b` from `j` agree."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if equal(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _sketch(prefixes: Prefixes, length: int) -> str:
    found = batches.mix(prefixes.spans(min(length, prefixes.n)))
    slot = (found >> np.uint64(58)).astype(np.int64)
    least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, slot, found)
    full = np.zeros(SLOTS, bool)
    full[slot] = True
    where = np.flatnonzero(full)
    source = where[np.searchsorted(where, np.arange(SLOTS)) % len(where)]
    short = (batches.mix(least[source]) & np.uint64(0xFFFF)).astype(np.uint16)
    return short.astype(">u2").tobytes().hex()


def fingerprint(codes: np.ndarray) -> str:
    """`length:whole:slots`, all in hex, and for texts below 2 * SHORT `:slots` of the shorter spans. Equal texts have equal
    fingerprints; an empty text has no slots."""
    n = len(codes)
    if not n:
        return "0::"
    prefixes = Prefixes(codes)
    whole = prefixes.span(0, n)
    more = ":" + _sketch(prefixes, SHORT_SPAN) if n < 2 * SHORT else ""
    return f"{n:x}:{whole[0]:08x}{whole[1]:08x}:{_sketch(prefixes, SPAN)}{more}"


def likeness(a: str, b: str) -> float:
    """0 to 1: 1 for fingerprints of equal texts, else below; the share of equal slots. An empty text is like empty ones only. With
    a text below SHORT the slots of the shorter spans are compared, if both have them, and those of the longer ones otherwise."""
    if a == b:
        return 1.0
    (m, _, x, *p), (n, _, y, *q) = a.split(":"), b.split(":")
    if not x or not y:
        return 0.0
    if p and q and min(int(m, 16), int(n, 16)) < SHORT:
        x, y = p[0], q[0]
    left, right = np.frombuffer(bytes.fromhex(x), ">u2"), np.frombuffer(bytes.fromhex(y), ">u2")
    return min(float((left == right).mean()), 1.0 - 1.0 / (4 * SLOTS))


def edited(text: str, following: str) -> str:
    """The last third replaced by as many code points, or all, from the start of another text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of each whole text; NULL is like empty; repeated rows stay."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(parts):
            codes = [points(t or "") for t in batches.strings(part)]
            yield batches.rows(schema, doc_id=part.column("doc_id"), n_chars=[len(c) for c in codes], fingerprint=[fingerprint(c) for c in codes])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def neighbours(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its text with the last third replaced from the next document, and both likenesses.

    The next document is the one with the next smaller id (equal ids: by text; NULL ids last); after the last comes the first.
    Documents are range-partitioned by falling id and go through each task in order. What a task lacks, the first document of
    the next non-empty partition, is sent to it as an extra row: one per partition, found through the largest id of each.
    A single document is its own next one.
    """
    spark = docs.sparkSession
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = picked.approxQuantile("doc_id", [n / parts for n in range(1, parts)], 0.2 / parts)
    bounds = sorted({int(c) for c in cuts})
    # part 0 holds the largest ids and the last part the smallest, and NULL
    above = F.array(*[F.lit(b) for b in bounds]).cast("array<long>")
    part = F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(F.size(F.filter(above, lambda b: b > F.col("doc_id"))))
    dealt = picked.withColumn("part", part.cast("int"))
    heads = {r.part: r.top for r in dealt.groupBy("part").agg(F.max("doc_id").alias("top")).collect()}
    filled = sorted(heads)
    closing = spark.createDataFrame([(p, heads[p], filled[n - 1]) for n, p in enumerate(filled)], "part int, top long, previous int")
    sent = dealt.join(F.broadcast(closing), "part").withColumn(
        "places",
        F.when(
            F.col("doc_id").eqNullSafe(F.col("top")),
            F.array(F.struct("part", F.lit(False).alias("tail")), F.struct(F.col("previous").alias("part"), F.lit(True).alias("tail"))),
        ).otherwise(F.array(F.struct("part", F.lit(False).alias("tail")))),
    )
    spread = sent.select("doc_id", "text", F.explode("places").alias("place")).select("doc_id", "text", "place.*")
    arranged = spread.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "tail", F.col("doc_id").desc_nulls_last(), "text")
    return arranged.mapInArrow(_pairs, ", ".join(f"{n} {k}" for n, k in _PAIR_KINDS))


_PAIR_KINDS = (
    ("doc_id", "long"),
    ("n_chars", "long"),
    ("edited_sha256", "string"),
    ("fingerprint", "string"),
    ("edited_fingerprint", "string"),
    ("near_edited", "double"),
    ("near_next", "double"),
)
_ARROW = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
_PAIR = pa.schema([(n, _ARROW[k]) for n, k in _PAIR_KINDS])


def _pairs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row that is not an extra one, with the row after it in its part."""
    last = None
    for batch in batches.slices(parts):
        out: list[tuple] = []
        columns = (batch.column(n).to_pylist() for n in ("doc_id", "text", "part", "tail"))
        for doc_id, text, part, tail in zip(*columns):
            if tail and (last is None or last[3]):
                continue
            here = (doc_id, text, fingerprint(points(text)), tail)
            if last is not None and not last[3]:
                changed = edited(last[1], text)
                mark = last[2] if changed == last[1] else fingerprint(points(changed))
                sha = hashlib.sha256(changed.encode()).hexdigest()
                out.append((last[0], len(last[1]), sha, last[2], mark, likeness(last[2], mark), likeness(last[2], here[2])))
            last = here
        yield batches.rows(_PAIR, **{n: [o[i] for o in out] for i, n in enumerate(_PAIR.names)})
