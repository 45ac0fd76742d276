"""Finding stretches that occur twice in a corpus: what the substring operators share.

Each operator picks *anchors*, places of a document such that any two equal long stretches hold a pair of anchors at the same
offset. An anchor has two hashes: `h` of a short piece at the place, and `n` of its neighbourhood, which holds every long
stretch around the piece. Anchors with equal `h` and `n` agree in all those stretches, so all but the earliest are settled: what
surrounds them repeats. Only classes of equal `h` with several `n` are left, one representative for each `n`; how far those
agree is for the operator to find out.

Hot anchors: a slice of documents gives at most one row for each (h, n), the earliest; the others of the slice are settled
on the spot. A slice with more than MOST_CONTEXTS neighbourhoods of one `h` declares `h` hot and sends the rest past the
grouping, and a class with more than MOST_CLASS representatives is hot too. Nothing is dropped: hot representatives are handled by
hashes of whole stretches, which spread over all tasks.

Documents are known by (doc, at >> 32): the id and 31 bits of a hash of the text; the low 32 bits of `at` are a place in it. Rows
equal in id and text are one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.llm import batches

MOST_CONTEXTS = 16
MOST_CLASS = 256
SETTLED, CLASS, HOT = 0, 1, 2
NO_ID = -(2**63)
_MARKER = -(2**63)

ROWS = "h long, n long, doc long, at long, kind int, more binary"
ROW = pa.schema(
    [("h", pa.int64()), ("n", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("kind", pa.int32()), ("more", pa.binary())]
)
FOUND = "h long, doc long, at long, kind int"
FOUND_ROW = pa.schema([("h", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("kind", pa.int32())])

_ONE, _MANY_SETTLED, _MANY_HOT = 0, 1, 2


class Rolling:
    """Hashes of all spans of sequences of 64-bit values, alike wherever a span stands."""

    def __init__(self, base: int):
        self.base, self.back = np.uint64(base | 1), np.uint64(pow(base | 1, -1, 1 << 64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            size = max(1 << 14, 2 * n)
            self.powers, self.inverses = (
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (self.base, self.back)
            )

    def prefixes(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values))
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Scrambled hashes of the spans from `start` to `end`."""
        self._grow(len(sums))
        return batches.mix((sums[end] - sums[start]) * self.inverses[start])


def keyed(docs: DataFrame, keep: Sequence[str] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, th, text) and, with `keep`, those columns as `rest`: NULL texts become empty, NULL ids NO_ID, `th` is 31 bits of the text's hash.

    All joins of an operator take just these columns, so that Spark shuffles the texts once for all of them.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rest = [F.struct(*[F.col(c).alias(f"kept_{n}") for n, c in enumerate(keep)]).alias("rest")] if keep else []
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text).bitwiseAND(0x7FFFFFFF).alias("th"),
        text.alias("text"),
        *rest,
    )


def ids(doc: pa.Array) -> pa.Array:
    """Document ids, NULL again where there was none."""
    return pc.if_else(pc.equal(doc, NO_ID), pa.scalar(None, pa.int64()), doc)


def combined(h: np.ndarray, n: np.ndarray, doc: np.ndarray, at: np.ndarray, inside: bool) -> Iterator[pa.RecordBatch]:
    """The rows that one slice sends into the grouping. `inside`: an earlier place of the same document counts too."""
    if not len(h):
        return
    h, n = h.view(np.int64), n.view(np.int64)
    n = np.where(n == _MARKER, 1, n)
    order = np.lexsort((at, doc, n, h))
    h, n, doc, at = h[order], n[order], doc[order], at[order]
    new_h = np.concatenate([[True], h[1:] != h[:-1]])
    new = new_h.copy()
    new[1:] |= n[1:] != n[:-1]
    first = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    later = doc > doc[first][run]
    same = ~new & ~later & (at != at[first][run])
    if inside:
        later, same = later | same, np.zeros(len(h), bool)
    # which neighbourhood of its h a run is, in this slice
    run_h = np.cumsum(new_h[first]) - 1
    start_of_h = np.flatnonzero(new_h[first])
    turn = np.arange(len(first)) - start_of_h[run_h]
    beyond = turn >= MOST_CONTEXTS
    hot = np.unique(h[first][beyond])
    ones = first[~beyond]
    more: list[bytes | None] = [None] * len(ones)
    own = np.flatnonzero(same & ~beyond[run])
    if len(own):
        place = np.cumsum(~beyond) - 1
        for some in np.split(own, np.flatnonzero(np.diff(run[own])) + 1):
            more[place[run[some[0]]]] = at[some].tobytes()
    parts = [
        dict(h=h[ones], n=n[ones], doc=doc[ones], at=at[ones], kind=np.full(len(ones), _ONE, np.int32), more=more),
        dict(h=hot, n=np.full(len(hot), _MARKER), doc=np.zeros(len(hot), np.int64), at=np.zeros(len(hot), np.int64), kind=np.full(len(hot), _ONE, np.int32), more=[None] * len(hot)),
    ]
    spread = [(later, _MANY_SETTLED), ((new | same) & beyond[run], _MANY_HOT)]
    for mask, kind in spread:
        picked = np.flatnonzero(mask)
        for i in range(0, len(picked), 2048):
            some = picked[i : i + 2048]
            seed = batches.mix(np.array([doc[some[0]] ^ at[some[0]] ^ kind], np.int64).view(np.uint64)).view(np.int64)
            blob = np.concatenate([h[some], doc[some], at[some]]).tobytes()
            parts.append(dict(h=seed, n=np.zeros(1, np.int64), doc=np.zeros(1, np.int64), at=np.zeros(1, np.int64), kind=np.array([kind], np.int32), more=[blob]))
    for part in parts:
        if len(part["h"]):
            yield batches.rows(ROW, **part)


def settled(anchors: DataFrame, parts: int, inside: bool) -> DataFrame:
    """(h, doc, at, kind) of every anchor that repeats: SETTLED, or a representative of a small class or of a HOT one.

    Rows are dealt by `h` and sorted, and a task keeps the rows of one class at a time, at most MOST_CLASS representatives.
    """
    ordered = anchors.repartition(parts, "h").sortWithinPartitions("h", "n", "doc", "at")
    return ordered.mapInArrow(_stream(inside), FOUND)


def _stream(inside: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def emit(h, doc, at, kind) -> pa.RecordBatch:
        return batches.rows(FOUND_ROW, h=h, doc=doc, at=at, kind=np.full(len(doc), kind, np.int32))

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_h = open_n = None  # class and neighbourhood that the last row belongs to
        first_doc = first_at = 0  # earliest row of that neighbourhood
        held: list[tuple[int, int]] = []  # representatives of the class that are not sent yet
        contexts, hot = 0, False
        for batch in incoming:
            kind = batch.column("kind").to_numpy()
            h, n, doc, at = (batch.column(c).to_numpy() for c in ("h", "n", "doc", "at"))
            more = batch.column("more")
            for row in np.flatnonzero(kind != _ONE):
                blob = np.frombuffer(more[row].as_buffer(), np.int64).reshape(3, -1)
                yield emit(*blob, SETTLED if kind[row] == _MANY_SETTLED else HOT)
            use = np.flatnonzero(kind == _ONE)
            if not len(use):
                continue
            h, n, doc, at = h[use], n[use], doc[use], at[use]
            extra = np.flatnonzero(~np.asarray(more.is_null())[use]) if more.null_count < len(more) else []
            new_h = np.concatenate([[h[0] != open_h], h[1:] != h[:-1]])
            new = new_h.copy()
            new[0] |= n[0] != open_n
            new[1:] |= n[1:] != n[:-1]
            run_no = np.cumsum(new)  # 0: goes on from the last batch
            starts = np.flatnonzero(new)
            lead_doc = np.concatenate([[first_doc], doc[starts]])[run_no]
            lead_at = np.concatenate([[first_at], at[starts]])[run_no]
            later = ~new & ((doc > lead_doc) | (inside & (doc == lead_doc) & (at != lead_at)))
            if later.any():
                yield emit(h[later], doc[later], at[later], SETTLED)
            for row in extra:
                others = np.frombuffer(more[int(use[row])].as_buffer(), np.int64)
                if later[row]:
                    yield emit(np.full(len(others), h[row]), np.full(len(others), doc[row]), others, SETTLED)
            # classes: the rows that start a neighbourhood are its representatives, with their twins in the same document
            others_of = {int(r): np.frombuffer(more[int(use[r])].as_buffer(), np.int64).tolist() for r in extra if not later[r]}
            twins = np.flatnonzero(~new & ~later & (at != lead_at))
            out_h, out_doc, out_at, out_kind = [], [], [], []

            def flush() -> None:
                if hot or contexts > 1:
                    for d, a in held:
                        out_h.append(open_h), out_doc.append(d), out_at.append(a), out_kind.append(HOT if hot else CLASS)
                held.clear()

            lone = np.zeros(len(starts), bool)  # a class that begins and ends here with one neighbourhood needs no look
            if len(starts) > 1:
                begins = new_h[starts]
                lone[:-1] = begins[:-1] & begins[1:]
                lone &= n[starts] != _MARKER
            seen = np.concatenate([[True], ~lone])  # by run_no
            for row in np.union1d(starts[~lone], twins[seen[run_no[twins]]]).tolist() if len(twins) else starts[~lone].tolist():
                if new_h[row]:
                    flush()
                    open_h, contexts, hot = int(h[row]), 0, False
                if n[row] == _MARKER:
                    hot = True
                    continue
                contexts += bool(new[row])
                held.append((int(doc[row]), int(at[row])))
                held.extend((int(doc[row]), a) for a in others_of.get(row, ()))
                hot = hot or contexts > MOST_CLASS
                if hot:
                    flush()
            last = len(h) - 1
            open_n, first_doc, first_at = int(n[last]), int(lead_doc[last]), int(lead_at[last])
            if out_doc:
                kinds = np.array(out_kind, np.int32)
                yield batches.rows(FOUND_ROW, h=out_h, doc=out_doc, at=out_at, kind=kinds)
        if hot or contexts > 1:
            yield batches.rows(
                FOUND_ROW, h=[open_h] * len(held), doc=[d for d, _ in held], at=[a for _, a in held], kind=[HOT if hot else CLASS] * len(held)
            )

    return run


def by_document(marks: DataFrame, *values: str) -> DataFrame:
    """(doc, th, marks): the places of each document as one list, which is bounded by the document's length."""
    return (
        marks.select("doc", F.shiftright("at", 32).alias("th"), F.struct(F.col("at").bitwiseAND(0xFFFFFFFF).alias("pos"), *values).alias("mark"))
        .groupBy("doc", "th")
        .agg(F.collect_list("mark").alias("marks"))
    )


def covered(length: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of the places 0 to length - 1 lie in a span. Spans reach beyond the borders at will; empty ones count for nothing."""
    starts, ends = np.clip(starts, 0, length), np.clip(ends, 0, length)
    use = ends > starts
    steps = np.zeros(length + 1, np.int64)
    np.add.at(steps, starts[use], 1)
    np.add.at(steps, ends[use], -1)
    return np.cumsum(steps[:-1]) > 0
