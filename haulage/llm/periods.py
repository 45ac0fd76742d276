"""Periodic runs of words: maximal stretches in which words one period apart are identical.

A run of period q that starts at s makes the suffixes at s and s + q share length - q >= q words, and no suffix between them shares
as many. So classes of suffixes are united by falling common prefix, as in Kruskal's algorithm: two suffixes next to one another in
the suffix array join their classes at the length of their common prefix. Each class keeps its positions in order. Positions that
become neighbours in a class by a union, and stand no further apart than the common prefix is long, have their distance as smallest
period; if the words before them differ, they start a run. Every run is found once, and nothing else is.

A run of at least `least` words needs a common prefix of half that, so only suffixes whose first words occur twice in their document
enter the suffix array; in ordinary prose these are few. Documents are whole and by themselves, so nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.llm import batches

LEAST = 12

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
FOUND_ROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])


class Positions:
    """Numbers in order, in short chunks, so that adding one to a long set moves few others."""

    CHUNK = 512

    def __init__(self, first: int):
        self.chunks, self.lasts, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for chunk in self.chunks:
            yield from chunk

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The nearest numbers below and above `x`, which is not in the set."""
        at = bisect_left(self.lasts, x)
        if at == len(self.chunks):
            return self.lasts[-1], None
        chunk = self.chunks[at]
        i = bisect_left(chunk, x)
        below = chunk[i - 1] if i else self.lasts[at - 1] if at else None
        return below, chunk[i]

    def add(self, x: int) -> None:
        at = min(bisect_left(self.lasts, x), len(self.chunks) - 1)
        chunk = self.chunks[at]
        insort(chunk, x)
        if len(chunk) > self.CHUNK:
            half = len(chunk) // 2
            self.chunks[at : at + 1] = [chunk[:half], chunk[half:]]
            self.lasts[at : at + 1] = [chunk[half - 1], chunk[-1]]
        else:
            self.lasts[at] = chunk[-1]
        self.size += 1


class Suffixes:
    """Suffixes, in order, of the sequences in `codes` whose first `width` values occur elsewhere in the same sequence.

    No value may occur in two sequences. `ends` holds, for each place, the end of its sequence.
    """

    def __init__(self, codes: np.ndarray, ends: np.ndarray, width: int):
        self.codes, self.ends, self.width = codes, ends, width
        self.places = self.common = np.zeros(0, np.int64)
        n = len(codes)
        following = np.zeros(n, np.int64)
        inner = np.flatnonzero(np.arange(1, n + 1) < ends)
        following[inner] = codes[inner + 1] + 1
        _, pair, often = np.unique(codes * (n + 1) + following, return_inverse=True, return_counts=True)
        twice = (often[pair] > 1) & (following > 0)
        start = twice.copy()
        for k in range(1, width - 1):
            start[:-k] &= twice[k:]
            start[-k:] = False
        some = np.flatnonzero(start)
        if not len(some):
            return
        rank = self._heads(pair, some)
        some = some[np.bincount(rank)[rank] > 1]
        if not len(some):
            return
        beyond = some + width
        self.known = known = np.union1d(some, beyond[beyond < ends[some]])
        self.slot = np.full(n + 1, -1, np.int64)
        self.slot[known] = np.arange(len(known))
        rank, step, m = self._heads(pair, known), width, len(known)
        self.levels = [(step, rank.astype(np.int32))]
        while int(rank.max()) + 1 < m:
            there = self._slots(known + step, ends[known])
            second = np.where(there >= 0, rank[there] + 1, 0)
            _, rank = np.unique(rank * (m + 1) + second, return_inverse=True)
            step *= 2
            self.levels.append((step, rank.astype(np.int32)))
        self.places = some[np.argsort(rank[self.slot[some]])]
        self.common = self._shared(self.places[:-1], self.places[1:])

    def _heads(self, pair: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the first `width` values at the places `at`, from ranks of pairs."""
        _, rank = np.unique(pair[at], return_inverse=True)  # without gaps: the highest rank tells how many differ
        room = len(pair) + 1
        for offset in [*range(2, self.width - 1, 2), *([self.width - 2] if self.width % 2 else [])]:
            there = at + offset
            more = np.where(there < self.ends[at], pair[np.minimum(there, len(pair) - 1)] + 1, 0)
            _, rank = np.unique(rank * room + more, return_inverse=True)
        return rank

    def _slots(self, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return np.where(at < ends, self.slot[np.minimum(at, len(self.slot) - 1)], -1)

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many values the suffixes at `a` and `b` share."""
        size = np.zeros(len(a), np.int64)
        end_a, end_b = self.ends[a], self.ends[b]
        for step, rank in reversed(self.levels):
            one, two = self._slots(a + size, end_a), self._slots(b + size, end_b)
            size += step * ((one >= 0) & (two >= 0) & (rank[one] == rank[two]))
        last = len(self.codes) - 1
        for _ in range(self.width - 1):
            x, y = a + size, b + size
            size += (x < end_a) & (y < end_b) & (self.codes[np.minimum(x, last)] == self.codes[np.minimum(y, last)])
        return size


def periodic(codes: np.ndarray, ends: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the sequences in `codes`, whose starts count through all of them."""
    width = (least + 1) // 2
    suffixes = Suffixes(codes, ends, width)
    places, common = suffixes.places.tolist(), suffixes.common
    owner = list(range(len(places)))
    sets: list[Positions | None] = [Positions(p) for p in places]

    def find(i: int) -> int:
        while owner[i] != i:
            owner[i] = i = owner[owner[i]]
        return i

    found: list[tuple[int, int, int]] = []

    def seed(i: int, j: int, shared: int) -> None:
        period = j - i
        if period <= shared and period + shared >= least and (i == 0 or codes[i - 1] != codes[j - 1]):
            found.append((i, period + shared, period))

    joints = np.flatnonzero(common >= width)
    joints = joints[np.argsort(-common[joints], kind="stable")]
    for k, shared in zip(joints.tolist(), common[joints].tolist()):
        one, two = find(k), find(k + 1)
        if sets[one].size < sets[two].size:
            one, two = two, one
        large, small = sets[one], list(sets[two])
        for i, x in enumerate(small):
            below, above = large.around(x)
            if below is not None and (i == 0 or small[i - 1] < below):
                seed(below, x, shared)
            if above is not None and (i + 1 == len(small) or small[i + 1] > above):
                seed(x, above, shared)
        for x in small:
            large.add(x)
        owner[two], sets[two] = one, None
    return found


def _coded(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the words, other ones in each text, and begin and end of the text of each word."""
    codes: list[int] = []
    base = 0
    for words in texts:
        number = {w: n for n, w in enumerate(dict.fromkeys(words), base)}
        codes.extend(map(number.__getitem__, words))
        base += len(number)
    sizes = np.array([len(words) for words in texts], np.int64)
    ends = np.cumsum(sizes)
    return np.array(codes, np.int64), np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if runs:
        steps = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            steps[start + period] += 1
            steps[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]
    return b" ".join(words)


def found(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs of at least `least` words (4 or more) and of two periods, for each row of `docs`.

    `runs` is an array of (start, length, period) by start, then period; `start` is a word number from 0, `period` the smallest one,
    and no neighbouring word extends a run. Words are stretches without ASCII white space. `collapsed` has the words that no run
    holds after its first period, joined by one space. NULL and empty texts have no words, no runs and an empty `collapsed`; NULL
    ids and repeated rows stay as they are, with their own results; no rows give no rows; other columns are not looked at. Memory
    of a task: a slice of texts or one longer text, times the logarithm of its longest repetition.
    """
    if least < 4:
        raise ValueError("least must be 4 or more")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(parts):
            texts = [(text or b"").split() for text in batches.raw(part)]
            codes, begins, ends = _coded(texts)
            own: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            if len(codes):
                begin_of = np.cumsum([0, *map(len, texts)])
                for start, length, period in sorted(periodic(codes, ends, least), key=lambda r: (r[0], r[2])):
                    row = int(np.searchsorted(begin_of, start, side="right")) - 1
                    own[row].append((start - int(begin_of[row]), length, period))
            flat = [r for runs in own for r in runs]
            offsets = np.cumsum([0, *map(len, own)]).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array([r[i] for r in flat], pa.int64()) for i in range(3)], fields=list(RUN))
            yield batches.rows(
                FOUND_ROW,
                doc_id=part.column("doc_id"),
                n_words=[len(words) for words in texts],
                runs=pa.ListArray.from_arrays(pa.array(offsets), structs),
                collapsed=[_collapsed(words, runs).decode() for words, runs in zip(texts, own)],
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, FOUND)


def doubled(docs: DataFrame) -> DataFrame:
    """`docs` with the text of every tenth document (by a checksum of its id) made periodic from some word on.

    With h = crc32(doc_id) and g = h // 10, of n words those from a = g % n on repeat the first 1 + (n - a) // (3 + g % 8) of them. All
    columns stay; texts without words, of NULL ids and of other documents stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    own = docs.select("*", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("__words"))
    g = F.floor(h / 10)
    n = F.size("__words")
    own = own.withColumn("__a", F.when(n > 0, g % n)).withColumn("__p", 1 + F.floor((n - F.col("__a")) / (3 + g % 8)))

    def word(w, i):
        place = F.col("__a") + (i - F.col("__a")) % F.col("__p")
        return F.when(i < F.col("__a"), w).otherwise(F.element_at("__words", (place + 1).cast("int")))

    changed = F.when(F.col("__a").isNotNull(), F.array_join(F.transform("__words", word), " ")).otherwise(F.col("text"))
    return own.withColumn("text", changed).drop("__words", "__a", "__p")


def digests(runs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of what `found` gives.

    The four numbers are those of the longest run (ties: smallest start, then period), NULL without one.
    """
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    each = runs.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.array_max(ranked).alias("best"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return each.select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
