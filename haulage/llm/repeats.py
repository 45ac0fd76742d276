"""Removing repeated byte strings with an enhanced suffix array and its common-prefix intervals.

Anchors are chosen by content: of every LENGTH bytes, the piece with the smallest hash, so equal strings choose equal anchors
(see `spans` for how equal neighbourhoods are settled and hot anchors spread). The neighbourhoods that are left, one for each
content, are put together by anchor, and their suffixes are sorted by prefix doubling into a suffix array with the lengths of
common prefixes. A scan with a stack walks the tree of common-prefix intervals; an interval whose suffixes have different
bytes on their left is a maximal repeat, and all its suffixes are its occurrences. Every occurrence but the earliest is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from haulage.llm import batches, spans
from haulage.llm.anchors import _marks
from haulage.session import scratch

LENGTH = 100
SLICE = 4 << 20
#: Bytes of neighbourhoods in one suffix array, whose sorting takes about a hundred times as much; a class of anchors is never split.
BLOCK = 1 << 18
_SEGMENT, _ANCHOR = 9, 0
_ONE, _TWO = spans.Rolling(0xA0761D6478BD642F), spans.Rolling(0xE7037ED1A0B428DB)
_BYTES = batches.mix(np.arange(1, 257, dtype=np.uint64))
_OTHER = batches.mix(np.arange(1001, 1257, dtype=np.uint64))

MARKS = "doc long, at long, kind int"
MARK = pa.schema([("doc", pa.int64()), ("at", pa.int64()), ("kind", pa.int32())])
REPORT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
)


@dataclass(frozen=True)
class Shape:
    """Strings of `length` bytes, and pieces of a third of that as anchors."""

    length: int

    @property
    def piece(self) -> int:
        return max(1, self.length // 3)

    @property
    def reach(self) -> int:
        """How far before an anchor a string that holds its piece may start."""
        return self.length - self.piece

    def starts(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        return np.maximum(at - self.reach, 0), np.minimum(at, n - self.length)

    def anchors(self, sums: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places that hold the smallest piece of some string, and the hashes of those pieces."""
        if n < self.length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.arange(n - self.piece + 1)
        hashes = _ONE.spans(sums, at, at + self.piece)
        width = self.reach + 1
        least = _sliding(hashes, width, np.minimum)
        best = _sliding(np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)]), width, np.maximum)
        found = np.flatnonzero(hashes == best)
        return found, hashes[found]


def _sliding(x: np.ndarray, width: int, of: np.ufunc) -> np.ndarray:
    """Least or greatest of each `width` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = of(x[:-step], x[step:])
        done += step
    return x


def _anchored(shape: Shape):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(parts, most=SLICE):
            found: list[list[np.ndarray]] = [[], [], [], []]
            for doc, th, text in zip(part.column("doc").to_pylist(), part.column("th").to_pylist(), batches.raw(part)):
                n = len(text)
                if n < shape.length:
                    continue
                sums = _ONE.prefixes(_BYTES[np.frombuffer(text, np.uint8)])
                at, h = shape.anchors(sums, n)
                low, high = np.maximum(at - shape.reach, 0), np.minimum(at + shape.length, n)
                around = batches.mix(_ONE.spans(sums, low, high) ^ batches.mix((((at - low) << 32) | (high - at)).view(np.uint64)))
                for kept, made in zip(found, (h, around, np.full(len(at), doc, np.int64), (th << 32) | at)):
                    kept.append(made)
            if found[0]:
                yield from spans.combined(*map(np.concatenate, found), inside=True)

    return run


def _neighbourhoods(shape: Shape):
    """Segments around the representatives of small classes; hashes of the strings around those of hot ones."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(parts, most=SLICE):
            offsets, places, kinds = _marks(part)
            classes = part.column("marks").flatten().field("h").to_numpy()
            hot: list[list[np.ndarray]] = [[], [], [], []]
            rows: dict[str, list] = {n: [] for n in spans.ROW.names}
            for row, (doc, th, text) in enumerate(zip(part.column("doc").to_pylist(), part.column("th").to_pylist(), batches.raw(part))):
                own = slice(offsets[row], offsets[row + 1])
                at, kind, n = places[own], kinds[own], len(text)
                for h, p in zip(classes[own][kind == spans.CLASS].tolist(), at[kind == spans.CLASS].tolist()):
                    low = max(0, p - shape.reach)
                    values = (h, 0, doc, (th << 32) | low, _SEGMENT, text[low : p + shape.length])
                    for name, value in zip(spans.ROW.names, values):
                        rows[name].append(value)
                low, high = shape.starts(at[kind == spans.HOT], n)
                start = np.flatnonzero(spans.covered(n, low, high + 1))
                if len(start):
                    data = np.frombuffer(text, np.uint8)
                    one = _ONE.spans(_ONE.prefixes(_BYTES[data]), start, start + shape.length)
                    two = _TWO.spans(_TWO.prefixes(_OTHER[data]), start, start + shape.length)
                    for kept, made in zip(hot, (one, two, np.full(len(start), doc, np.int64), (th << 32) | start)):
                        kept.append(made)
            if rows["h"]:
                yield batches.rows(spans.ROW, **rows)
            if hot[0]:
                yield from spans.combined(*map(np.concatenate, hot), inside=True)

    return run


class SuffixArray:
    """Sorted suffixes of segments, with the lengths of the prefixes that neighbours share. Suffixes of different classes share none."""

    FIRST = 7

    def __init__(self, segments: list[bytes], classes: np.ndarray, least: int):
        sizes = np.array([len(s) for s in segments])
        data = np.frombuffer(b"".join(segments), np.uint8).astype(np.uint64) + np.uint64(1)
        self.ends = np.repeat(np.cumsum(sizes), sizes)
        self.segment = np.repeat(np.arange(len(sizes)), sizes)
        self.begin = self.ends - sizes[self.segment]
        n = len(data)
        place = np.arange(n)
        self.data = data
        key = np.zeros(n, np.uint64)
        for k in range(self.FIRST):
            there = place + k
            key = (key << np.uint64(9)) | np.where(there < self.ends, data[np.minimum(there, n - 1)], np.uint64(0))
        group = classes[self.segment]
        order = np.lexsort((key, group))
        rank = self._ranks(order, (key, group))
        self.ranks, step, longest = [(self.FIRST, rank)], self.FIRST, int(sizes.max())
        while step < longest:
            there = place + step
            second = np.where(there < self.ends, rank[np.minimum(there, n - 1)], 0)
            both = rank.astype(np.int64) * (n + 1) + second
            order = np.argsort(both, kind="stable")
            rank = self._ranks(order, (both,))
            step *= 2
            self.ranks.append((step, rank))
        self.places = order[(self.ends - place)[order] >= least]
        self.common = self._common(group)

    @staticmethod
    def _ranks(order: np.ndarray, keys: tuple[np.ndarray, ...]) -> np.ndarray:
        new = np.zeros(len(order), bool)
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        rank = np.empty(len(order), np.int32)
        rank[order] = np.cumsum(new) + 1
        return rank

    def _common(self, group: np.ndarray) -> np.ndarray:
        """common[i]: what suffixes i - 1 and i share."""
        a, b = self.places[:-1], self.places[1:]
        n, room = len(self.ends), np.minimum(self.ends[a] - a, self.ends[b] - b)
        size = np.zeros(len(a), np.int64)
        for step, rank in reversed(self.ranks):
            same = (size < room) & (rank[np.minimum(a + size, n - 1)] == rank[np.minimum(b + size, n - 1)])
            size += step * same
        size = np.minimum(size, room)
        for _ in range(self.FIRST - 1):
            size += (size < room) & (self.data[np.minimum(a + size, n - 1)] == self.data[np.minimum(b + size, n - 1)])
        size[group[a] != group[b]] = 0
        return np.concatenate([[0], size])

    def repeats(self, least: int) -> Iterator[tuple[int, np.ndarray]]:
        """(length, places) of each maximal repeat of at least `least` bytes, with all its occurrences.

        What stands before the first byte of a segment counts as different from everything.
        """
        if not len(self.places):
            return
        left = np.where(self.places > self.begin[self.places], self.data[np.maximum(self.places - 1, 0)].astype(np.int64), -1)
        long = self.common >= least
        heads = np.flatnonzero(~long)
        tails = np.append(heads[1:], len(self.places))
        low, high = np.minimum.reduceat(left, heads), np.maximum.reduceat(left, heads)
        for k in np.flatnonzero((tails - heads > 1) & ((low != high) | (low < 0))):
            yield from self._intervals(int(heads[k]), int(tails[k]), left)

    def _intervals(self, head: int, tail: int, left: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Scan of the suffixes from `head` to `tail`; the stack holds open intervals as [length, first, left byte or None]."""
        size, lefts = self.common[head:tail].tolist(), left[head:tail].tolist()
        own = [None if x < 0 else x for x in lefts]  # None: different bytes, or nothing known
        stack: list[list] = []
        before = own[0]
        for i in range(1, tail - head + 1):
            now = size[i] if i < tail - head else 0
            first, seen = i - 1, before
            while stack and stack[-1][0] > now:
                length, first, byte = stack.pop()
                seen = byte if byte == seen else None
                if seen is None:
                    yield length, self.places[head + first : head + i]
            if i == tail - head:
                break
            if stack and stack[-1][0] == now:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == seen else None
            else:
                stack.append([now, first, seen])
            before = own[i]


def _removals(segments: list[tuple[int, int, int, int, bytes]], least: int) -> pa.RecordBatch:
    """Marks of all occurrences but the earliest, of all maximal repeats of whole classes of segments (h, n, doc, at, bytes)."""
    number = {h: i for i, h in enumerate(dict.fromkeys(s[0] for s in segments))}
    array = SuffixArray([s[4] for s in segments], np.array([number[s[0]] for s in segments]), least)
    doc, at = (np.array([s[i] for s in segments], np.int64) for i in (2, 3))
    out: list[list[np.ndarray]] = [[], [], []]
    for length, places in array.repeats(least):
        owner = array.segment[places]
        docs, ats = doc[owner], at[owner] + places - array.begin[places]
        first = np.lexsort((ats, docs))[0]
        rest = (docs != docs[first]) | (ats != ats[first])
        for kept, made in zip(out, (docs[rest], ats[rest], np.full(int(rest.sum()), length, np.int32))):
            kept.append(made)
    doc, at, kind = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in out)
    return batches.rows(MARK, doc=doc, at=at, kind=kind)


def _resolve(shape: Shape):
    """Classes of segments through suffix arrays, and string hashes of hot anchors through the grouping of `spans`."""
    grouped = spans._stream(inside=True)

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, int, int, int, bytes]] = []
        ready: list[pa.RecordBatch] = []

        def others() -> Iterator[pa.RecordBatch]:
            nonlocal waiting
            size = 0
            for batch in incoming:
                mine = pc.equal(batch.column("kind"), _SEGMENT)
                some = batch.filter(mine)
                for row in zip(*(some.column(c).to_pylist() for c in ("h", "n", "doc", "at", "more"))):
                    if size >= BLOCK and row[0] != waiting[-1][0]:
                        ready.append(_removals(waiting, shape.length))
                        waiting, size = [], 0
                    waiting.append(row)
                    size += len(row[4])
                yield batch.filter(pc.invert(mine))

        for found in grouped(others()):
            repeated = found.filter(pc.equal(found.column("kind"), spans.SETTLED))
            kind = np.full(repeated.num_rows, shape.length, np.int32)
            yield batches.rows(MARK, doc=repeated.column("doc"), at=repeated.column("at"), kind=kind)
            yield from ready
            ready.clear()
        if waiting:
            ready.append(_removals(waiting, shape.length))
        yield from ready

    return run


def marked(docs: DataFrame, length: int = LENGTH, keep: Sequence[str] = ()) -> DataFrame:
    """`spans.keyed` documents with lists of (pos, kind): anchors whose whole neighbourhood repeats (0) or spans of `kind` bytes."""
    spark = docs.sparkSession
    shape, parts = Shape(length), int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spans.keyed(docs, keep)
    anchors = rows.select("doc", "th", "text").mapInArrow(_anchored(shape), spans.ROWS)
    folder = scratch(spark, "repeats")
    spans.settled(anchors, parts, inside=True).write.parquet(folder)
    found = spark.read.schema(spans.FOUND).parquet(folder)
    left = spans.by_document(found.where(F.col("kind") != spans.SETTLED), "h", "kind")
    around = rows.join(left, ["doc", "th"]).mapInArrow(_neighbourhoods(shape), spans.ROWS)
    resolved = around.repartition(parts, "h").sortWithinPartitions("h", "n", "doc", "at").mapInArrow(_resolve(shape), MARKS)
    marks = found.where(F.col("kind") == spans.SETTLED).select("doc", "at", F.lit(_ANCHOR).alias("kind")).unionByName(resolved)
    return rows.join(spans.by_document(marks, "kind"), ["doc", "th"], "left")


def _cover(shape: Shape, n: int, at: np.ndarray, kind: np.ndarray) -> np.ndarray:
    low, high = shape.starts(at[kind == _ANCHOR], n)
    ends = np.where(high >= low, high + shape.length, low)
    other = kind != _ANCHOR
    return spans.covered(n, np.concatenate([low, at[other]]), np.concatenate([ends, at[other] + kind[other]]))


def _reported(shape: Shape):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(parts, most=SLICE):
            offsets, places, kinds = _marks(part)
            out: list[tuple] = []
            for row, text in enumerate(batches.raw(part)):
                own = slice(offsets[row], offsets[row + 1])
                gone = pieces = 0
                kept = text
                if own.stop > own.start:
                    out_of = _cover(shape, len(text), places[own], kinds[own])
                    gone = int(out_of.sum())
                    pieces = int(out_of[:1].sum() + (out_of[1:] & ~out_of[:-1]).sum())
                    kept = np.frombuffer(text, np.uint8)[~out_of].tobytes()
                out.append((len(text), gone, pieces, hashlib.sha256(kept).hexdigest()))
            yield batches.rows(REPORT, doc_id=spans.ids(part.column("doc")), **{n: [o[i] for o in out] for i, n in enumerate(REPORT.names[1:])})

    return run


def removed(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): bytes covered by a string of `length` bytes that starts earlier go.

    Earlier: in a document with a smaller id, or further up in the same document. Strings are those of the whole input texts, as
    UTF-8, and do not cross documents. NULL texts are empty, a NULL id is the smallest; of rows with one id and different texts one
    is earlier (by a hash of the text); rows equal in id and text are one document; other columns are not looked at.
    """
    return marked(docs, length).select("doc", "text", "marks").mapInArrow(
        _reported(Shape(length)), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def cleaned(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`docs` with the repeated strings taken out of `text`; all rows and all columns stay, a text may become empty.

    A character goes only if all its bytes are covered, so texts stay valid. A NULL text stays NULL.
    """
    shape = Shape(length)
    others = [c for c in docs.columns if c != "text"]  # the text itself goes once through the shuffles
    absent = "__no_text"
    while absent in docs.columns:
        absent += "_"
    given = docs.withColumn(absent, F.col("text").isNull())
    rows = marked(given, length, keep=[*others, absent]).select("text", "marks", "rest")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(parts, most=SLICE):
            offsets, places, kinds = _marks(part)
            texts = []
            for row, text in enumerate(batches.raw(part)):
                own = slice(offsets[row], offsets[row + 1])
                if own.stop > own.start:
                    data = np.frombuffer(text, np.uint8)
                    starts = np.flatnonzero((data & 0xC0) != 0x80)
                    whole = np.minimum.reduceat(_cover(shape, len(text), places[own], kinds[own]), starts)
                    text = data[~np.repeat(whole, np.diff(np.append(starts, len(data))))].tobytes()
                texts.append(text.decode())
            yield pa.RecordBatch.from_arrays([part.column("rest"), pa.array(texts, pa.string())], names=["rest", "cleaned"])

    made = rows.mapInArrow(run, StructType([rows.schema["rest"], StructField("cleaned", StringType())]))
    kept = {c: F.col(f"rest.kept_{n}") for n, c in enumerate(others)}
    kept["text"] = F.when(~F.col(f"rest.kept_{len(others)}"), F.col("cleaned"))
    return made.select(*[kept[c].alias(c) for c in docs.columns])
