"""Removing repeated stretches of words by difference-cover anchors.

A difference cover of a period holds, for any two places, a shift below the period that brings both to places of the cover. So
hashing pieces only at cover places (places modulo the period) is enough: two equal windows of WINDOW words, wherever they
stand, hold an equal piece at a common cover place, if piece and period fit into a window. Equal anchors are then extended
on both sides: at once where whole neighbourhoods agree (see `spans`), and window by window around the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.llm import batches, spans
from haulage.session import scratch

WINDOW = 50
# Perfect difference sets by their period.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52)}
#: A slice combines the anchors of equal documents, so it is larger than those of other operators.
SLICE = 6 << 20

_ONE, _TWO = spans.Rolling(0x9E3779B97F4A7C15), spans.Rolling(0xD1B54A32D192ED03)
_ANCHOR, _START = 0, 1

REPORT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
CLEANED = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_removed", pa.int64())])


class Cover:
    """The anchors of windows of `window` words: the largest period that leaves a piece of two fifths of a window, or 7."""

    def __init__(self, window: int):
        fitting = [p for p in COVERS if window - p + 1 >= 2 * window / 5]
        self.window, self.period = window, max(fitting, default=min(COVERS))
        self.piece = window - self.period + 1
        if self.piece < 1:
            raise ValueError(f"a window of {window} words is too short for a cover of period {self.period}")
        self.reach = window - self.piece  # how far before an anchor a window that holds it may start

    def places(self, n: int) -> np.ndarray:
        """Cover places at which a piece fits into `n` words; none where no window does."""
        if n < self.window:
            return np.zeros(0, np.int64)
        blocks = np.arange(0, n, self.period)
        found = (blocks[:, None] + np.array(COVERS[self.period])).ravel()
        return found[found + self.piece <= n]

    def starts(self, anchors: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last start of the windows in `n` words that hold each anchor's piece."""
        return np.maximum(anchors - self.reach, 0), np.minimum(anchors, n - self.window)


def _words(text: bytes) -> list[bytes]:
    return text.split()  # of bytes: at ASCII white space only


def _anchors(cover: Cover):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = batches.WordHashes()
        for part in batches.slices(parts, most=SLICE):
            found: list[list[np.ndarray]] = [[], [], [], []]
            docs, ths = part.column("doc").to_pylist(), part.column("th").to_pylist()
            for doc, th, text in zip(docs, ths, batches.raw(part)):
                own = _words(text)
                at = cover.places(len(own))
                if not len(at):
                    continue
                sums = _ONE.prefixes(hashes.of(own))
                low, high = np.maximum(at - cover.reach, 0), np.minimum(at + cover.window, len(own))
                shape = batches.mix((((at - low) << 32) | (high - at)).view(np.uint64))
                for kept, made in zip(
                    found,
                    (
                        _ONE.spans(sums, at, at + cover.piece),
                        batches.mix(_ONE.spans(sums, low, high) ^ shape),
                        np.full(len(at), doc, np.int64),
                        (th << 32) | at,
                    ),
                ):
                    kept.append(made)
            if found[0]:
                yield from spans.combined(*map(np.concatenate, found), inside=False)

    return run


def _marks(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, places, kinds) of the lists of marks; a NULL list is empty."""
    lists = part.column("marks")
    inner = lists.flatten()
    sizes = np.diff(lists.offsets.to_numpy()) * ~np.asarray(lists.is_null())
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    kinds = inner.field("kind").to_numpy() if inner.type.get_field_index("kind") >= 0 else np.zeros(len(inner), np.int32)
    return offsets, inner.field("pos").to_numpy().astype(np.int64), kinds


def _windows(cover: Cover):
    """Hashes of the windows around representatives."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = batches.WordHashes()
        for part in batches.slices(parts, most=SLICE):
            offsets, places, _ = _marks(part)
            found: list[list[np.ndarray]] = [[], [], [], []]
            rows = zip(part.column("doc").to_pylist(), part.column("th").to_pylist(), batches.raw(part))
            for row, (doc, th, text) in enumerate(rows):
                own = _words(text)
                low, high = cover.starts(places[offsets[row] : offsets[row + 1]], len(own))
                start = np.flatnonzero(spans.covered(len(own), low, high + 1))
                if not len(start):
                    continue
                values = hashes.of(own)
                sums = [r.prefixes(v) for r, v in ((_ONE, values), (_TWO, batches.mix(values)))]
                for kept, made in zip(
                    found,
                    (
                        _ONE.spans(sums[0], start, start + cover.window),
                        _TWO.spans(sums[1], start, start + cover.window),
                        np.full(len(start), doc, np.int64),
                        (th << 32) | start,
                    ),
                ):
                    kept.append(made)
            if found[0]:
                yield from spans.combined(*map(np.concatenate, found), inside=False)

    return run


def marked(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`spans.keyed` documents with what repeats in them: lists of (pos, kind), anchors or windows, NULL where nothing does."""
    spark = docs.sparkSession
    cover, parts = Cover(window), int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spans.keyed(docs)
    anchors = rows.select("doc", "th", "text").mapInArrow(_anchors(cover), spans.ROWS)
    folder = scratch(spark, "anchors")
    spans.settled(anchors, parts, inside=False).drop("h").write.parquet(folder)
    found = spark.read.schema("doc long, at long, kind int").parquet(folder)
    left = spans.by_document(found.where(F.col("kind") != spans.SETTLED))
    windows = rows.join(left, ["doc", "th"]).mapInArrow(_windows(cover), spans.ROWS)
    repeated = spans.settled(windows, parts, inside=False).where(F.col("kind") == spans.SETTLED)
    marks = found.where(F.col("kind") == spans.SETTLED).select("doc", "at", F.lit(_ANCHOR).alias("kind"))
    marks = marks.unionByName(repeated.select("doc", "at", F.lit(_START).alias("kind")))
    return rows.join(spans.by_document(marks, "kind"), ["doc", "th"], "left")


def _kept(cover: Cover, report: bool):
    schema = REPORT if report else CLEANED

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(parts, most=SLICE):
            offsets, places, kinds = _marks(part)
            out: list[tuple] = []
            for row, text in enumerate(batches.raw(part)):
                own = _words(text)
                at, kind = places[offsets[row] : offsets[row + 1]], kinds[offsets[row] : offsets[row + 1]]
                kept, gone = own, 0
                if len(at):
                    low, high = cover.starts(at[kind == _ANCHOR], len(own))
                    ends = np.where(high >= low, high + cover.window, low)
                    starts = at[kind == _START]
                    out_of = spans.covered(len(own), np.concatenate([low, starts]), np.concatenate([ends, starts + cover.window]))
                    gone = int(out_of.sum())
                    kept = [own[i] for i in np.flatnonzero(~out_of)]
                if report:
                    out.append((len(own), gone, hashlib.sha256(b" ".join(kept)).hexdigest()))
                else:
                    out.append(((text if not gone else b" ".join(kept)).decode(), gone))
            names = schema.names[1:]
            yield batches.rows(schema, doc_id=spans.ids(part.column("doc")), **{n: [o[i] for o in out] for i, n in enumerate(names)})

    return run


def removed(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): words covered by a window that also starts in a document with a smaller id go.

    Words are runs without ASCII white space. Windows are those of the whole input texts. NULL and empty texts have no words, a
    NULL id is the smallest, rows with equal ids do not remove from each other, other columns are not looked at.
    """
    kept = marked(docs, window).select("doc", "text", "marks")
    return kept.mapInArrow(_kept(Cover(window), True), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def cleaned(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text, n_removed): the texts themselves. A text that loses words has the others joined by single spaces."""
    kept = marked(docs, window).select("doc", "text", "marks")
    return kept.mapInArrow(_kept(Cover(window), False), "doc_id long, text string, n_removed long")
