"""Arrow batches inside tasks: texts as bytes, bounded slices, output rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that a task works on at once. One longer text is a slice of its own.
SLICE_BYTES = 2 << 20


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `most` bytes of `column`, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """UTF-8 bytes of each text."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str | None]:
    return batch.column(column).to_pylist()


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of `schema` from lists, numpy arrays or Arrow arrays by name."""
    made = []
    for field in schema:
        values = columns[field.name]
        if isinstance(values, pa.ChunkedArray):
            values = values.combine_chunks()
        if isinstance(values, pa.Array):
            made.append(values.cast(field.type) if values.type != field.type else values)
        else:
            made.append(pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(made, schema=schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the finaliser of splitmix64, fixed constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, … within each of the consecutive groups of these lengths."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.arange(total, dtype=np.int64) - starts


class WordHashes:
    """64-bit hashes of words, remembered for the words a task has met; the memory is emptied when it grows large."""

    MOST = 400_000

    def __init__(self, seed: int = 0):
        import xxhash

        self.seed, self.known, self.one = seed, {}, xxhash.xxh3_64_intdigest

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.MOST:
            known.clear()
        one, seed = self.one, self.seed
        for word in set(words).difference(known):
            known[word] = one(word, seed)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
