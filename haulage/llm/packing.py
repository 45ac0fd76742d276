"""Packing token sequences into windows of one size by bounded-space online packing.

Each task keeps a fixed number of windows open. A document's ids fill whole windows as long as they can; what is left goes into the
open window where it leaves the least room, or opens a new one. When none has room and all are open, the fullest is topped up with
the head of the piece and emitted, and the rest of the piece is placed anew. At its end a task merges its open windows into full
ones and one tail. The tails of all tasks, less than one window each, follow one another in the order of their tasks and are cut
at the window size; what remains of them in the end is cut at powers of two, which need no padding. So no window is padded.

Pieces are written once, then read: which pieces share a window is decided once, whatever tasks are repeated.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm import batches, vocabulary
from haulage.session import scratch

SIZE, OPEN, END_ID = 4096, 32, 2
#: Stretches and words a worker remembers before it starts its memory anew. It affects time only.
ENTRIES_KEPT = 500_000
#: Text bytes encoded at once: the more, the more often a stretch occurs among them.
SLICE = 4 << 20
#: Bytes of ids in one batch of a task's output.
BATCH = 4 << 20
#: Sequence ids of merged tails begin here; those of a task are its number times 2^32 and more.
TAILS = 1 << 60

_PIECES = "doc_id long, start long, length long, doc_tokens long, part int, window long, offset long, ids binary"
_PIECE = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens")]
    + [("part", pa.int32()), ("window", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]
)


class WordIds:
    """The tokenizers library for files that split texts into words and end them, with a memory.

    A word's ids don't depend on what stands around it, and no word reaches over white space. So ids are remembered for stretches
    without white space, put together from those of their words, which the library encodes many at a time. Texts with unusual
    characters or special tokens go through the library whole.
    """

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, specials = spec["model"]["vocab"], vocabulary.specials(spec)
        #: Only files of this kind take the short path.
        self.usual = spec["model"].get("end_of_word_suffix") == "</w>" and (spec.get("pre_tokenizer") or {}).get("type") == "Sequence"
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        #: Whether a token ends a word; of a word's tokens just the last one does.
        self.final = np.zeros(max([*vocab.values(), *specials.values()], default=0) + 1, bool)
        self.final[[n for text, n in vocab.items() if text.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        #: The number of each stretch or word, whose ids are flat[first[number] : first[number + 1]].
        self.number: dict[str, int] = {"": 0}
        self.flat, self.first = np.zeros(0, "<u4"), np.zeros(2, np.int64)

    def _keep(self, names: list[str]) -> None:
        """Forget all but these: what the texts at hand use is what the next ones use most."""
        known = [(s, n) for s in names if s and (n := self.number.get(s)) is not None]
        ids, sizes = self._gathered(np.array([n for _, n in known], np.int64))
        self._forget()
        self._add([s for s, _ in known], ids, sizes)

    def _short(self, text: str) -> bool:
        return self.usual and vocabulary.plain(text) and not ("<|" in text and self.special and self.special.search(text))

    def _gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these entries one after another, and how many each has."""
        sizes = self.first[numbers + 1] - self.first[numbers]
        ends = np.cumsum(sizes)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[numbers] - ends + sizes, sizes)], sizes

    def _add(self, names: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.number.update(zip(names, range(len(self.number), len(self.number) + len(names))))
        self.flat = np.concatenate([self.flat, ids])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])

    def _learn(self, stretches: list[str]) -> None:
        # plain letters alone are one word
        mixed = [s for s in stretches if not s.isalpha()]
        found = list(map(vocabulary.WORD_SPLIT.findall, mixed))
        words = list(set(filter(str.isalpha, stretches)).union(*found).difference(self.number))
        for i in range(0, len(words), 20_000):
            some = words[i : i + 20_000]
            ids = np.array(self.library.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.final[ids]) + 1
            if len(ends) != len(some):
                raise ValueError("words did not keep apart")
            self._add(some, ids, np.diff(ends, prepend=0))
        several = [(s, own) for s, own in zip(mixed, found) if len(own) > 1]
        if several:
            numbers = np.fromiter((self.number[w] for _, own in several for w in own), np.int64)
            ids, sizes = self._gathered(numbers)
            begins = np.cumsum([0, *(len(own) for _, own in several)])[:-1]
            self._add([s for s, _ in several], ids, np.add.reduceat(sizes, begins))

    def of(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. NULL is like empty."""
        whole = [text or "" for text in texts.to_pylist()]
        short = np.fromiter(map(self._short, whole), bool, len(whole))
        made: list[bytes] = [b""] * len(whole)
        for row in np.flatnonzero(~short).tolist():
            made[row] = np.array(self.library.encode(whole[row], add_special_tokens=False).ids, "<u4").tobytes()
        split = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "").filter(pa.array(short))))
        coded = split.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.number) > ENTRIES_KEPT:
            self._keep(names)
        number = list(map(self.number.get, names))
        new = [s for s, n in zip(names, number) if n is None]
        if new:
            self._learn(new)
            number = [self.number[s] if n is None else n for s, n in zip(names, number)]
        number = np.array(number, np.int64)
        ids, sizes = self._gathered(number[coded.indices.to_numpy()])
        starts = np.concatenate([[0], np.cumsum(sizes)])[split.offsets.to_numpy() - split.offsets[0].as_py()] * 4
        data = ids.tobytes()
        for row, start, end in zip(np.flatnonzero(short).tolist(), starts.tolist(), starts[1:].tolist()):
            made[row] = data[start:end]
        return made


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class Packer:
    """Open windows of one task. A piece is (doc_id, start, doc_tokens, ids as bytes); `emit` gets the pieces of each full window."""

    def __init__(self, size: int, most_open: int, emit):
        self.size, self.most_open, self.emit = 4 * size, most_open, emit
        self.used: list[int] = []
        self.windows: list[list[tuple]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        while len(ids) - at >= self.size:
            self.emit([(doc_id, at // 4, total, ids[at : at + self.size])])
            at += self.size
        while at < len(ids):
            at += self._place(doc_id, at, total, ids)

    def _place(self, doc_id: int | None, at: int, total: int, ids: bytes) -> int:
        """Puts the ids from `at` on into one window, or their head where none has room, and says how many bytes that is."""
        need = len(ids) - at
        best = max((i for i, used in enumerate(self.used) if used + need <= self.size), key=self.used.__getitem__, default=None)
        if best is None and len(self.used) < self.most_open:
            best = len(self.used)
            self.used.append(0)
            self.windows.append([])
        if best is None:
            best = max(range(len(self.used)), key=self.used.__getitem__)
            need = self.size - self.used[best]
        self.windows[best].append((doc_id, at // 4, total, ids[at : at + need]))
        self.used[best] += need
        if self.used[best] == self.size:
            self.emit(self.windows[best])
            self.used[best], self.windows[best] = self.used[-1], self.windows[-1]
            self.used.pop(), self.windows.pop()
        return need

    def tail(self) -> list[tuple]:
        """Merges the open windows, fullest first, emits those that become full and gives back the pieces of the last one."""
        held: list[tuple] = []
        room = self.size
        for i in sorted(range(len(self.used)), key=self.used.__getitem__, reverse=True):
            for doc_id, start, total, ids in self.windows[i]:
                while len(ids) >= room:
                    self.emit([*held, (doc_id, start, total, ids[:room])])
                    start, ids, held, room = start + room // 4, ids[room:], [], self.size
                if ids:
                    held.append((doc_id, start, total, ids))
                    room -= len(ids)
        self.used, self.windows = [], []
        return held


def _packed(tokenizer: str, size: int, most_open: int, end_id: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), word_ids(tokenizer)
        last = np.array([end_id], "<u4").tobytes()
        rows: list[tuple] = []
        held = number = 0

        def emit(pieces: list[tuple], window: int | None = None) -> None:
            nonlocal held, number
            if window is None:
                window, number = number, number + 1
            offset = 0
            for doc_id, start, total, ids in pieces:
                rows.append((doc_id, start, len(ids) // 4, total, part, window, offset, ids))
                offset += len(ids) // 4
            held += 4 * offset

        def batch() -> pa.RecordBatch:
            nonlocal held
            made = batches.rows(_PIECE, **{name: [row[i] for row in rows] for i, name in enumerate(_PIECE.names)})
            rows.clear()
            held = 0
            return made

        packer = Packer(size, most_open, emit)
        for piece in batches.slices(parts, most=SLICE):
            for doc_id, ids in zip(piece.column("doc_id").to_pylist(), encoder.of(piece.column("text"))):
                packer.add(doc_id, ids + last)
                if held >= BATCH:
                    yield batch()
        emit(packer.tail(), -1)
        if rows:
            yield batch()

    return run


def _merged(tails: DataFrame, size: int) -> DataFrame:
    """Pieces of the tails (window -1), cut anew: they follow one another by task, windows are `size` long and powers of two at the end.

    Per task one row enters the running sum; a piece is cut by expressions, so tails stay spread over tasks.
    """
    lengths = tails.groupBy("part").agg(F.sum("length").alias("tail"))
    total = lengths.agg(F.coalesce(F.sum("tail"), F.lit(0)).alias("n")).first().n
    whole, rest = divmod(total, size)
    ends, cuts = 0, []
    while ends < rest:
        step = 1 << ((rest - ends).bit_length() - 1)
        cuts.append((ends, ends + step))
        ends += step
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.select("part", F.coalesce(F.sum("tail").over(before), F.lit(0)).alias("before"))
    placed = tails.join(starts, "part").withColumn("low", F.col("before") + F.col("offset")).withColumn("high", F.expr("low + length"))
    chunks = F.sequence(F.floor(F.col("low") / size), F.floor((F.col("high") - 1) / size))
    placed = placed.withColumn("chunk", F.explode(chunks))
    full = F.array(F.struct(F.lit(0).alias("from"), F.lit(size).alias("to")))
    short = F.array(*[F.struct(F.lit(a).alias("from"), F.lit(b).alias("to")) for a, b in cuts]) if cuts else full
    placed = placed.select("*", F.posexplode(F.when(F.col("chunk") < whole, full).otherwise(short)).alias("turn", "span"))
    a = F.greatest(F.col("low"), F.col("chunk") * size + F.col("span.from"))
    b = F.least(F.col("high"), F.col("chunk") * size + F.col("span.to"))
    placed = placed.withColumns({"a": a, "b": b}).where("a < b")
    return placed.select(
        "doc_id",
        (F.col("start") + F.col("a") - F.col("low")).alias("start"),
        (F.col("b") - F.col("a")).alias("length"),
        "doc_tokens",
        (F.lit(TAILS) + F.col("chunk") * 64 + F.col("turn")).alias("sequence_id"),
        (F.col("a") - F.col("chunk") * size - F.col("span.from")).alias("offset"),
        F.expr("substring(ids, cast(4 * (a - low) + 1 as int), cast(4 * (b - a) as int))").alias("ids"),
    )


def packed(
    docs: DataFrame,
    tokenizer: str,
    size: int = SIZE,
    end_id: int = END_ID,
    most_open: int = OPEN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids): every id of every whole text, and `end_id` after it, in one piece.

    `ids` are the piece's ids as little-endian unsigned 32-bit integers, `start` counts the ids of its document before it,
    `doc_tokens` all of them; pieces with one `sequence_id` (unique, not dense) follow each other from offset 0. A sequence holds
    `size` ids or, of those that end the tails, a power of two. NULL and empty texts are their end id alone; NULL ids stay, repeated
    rows are documents of their own; no rows give no pieces; other columns are not looked at.
    """
    if size < 1 or most_open < 1:
        raise ValueError("size and most_open must be positive")
    spark = docs.sparkSession
    folder = scratch(spark, "packing")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    made = picked.mapInArrow(_packed(tokenizer, size, most_open, end_id), _PIECES)
    made.write.option("compression", "zstd").parquet(folder)
    pieces = spark.read.schema(_PIECES).parquet(folder)
    full = pieces.where("window >= 0").select(
        "doc_id", "start", "length", "doc_tokens", (F.col("part").cast("long") * (1 << 32) + F.col("window")).alias("sequence_id"), "offset", "ids"
    )
    return full.unionByName(_merged(pieces.where("window < 0"), size))
