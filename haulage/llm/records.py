"""Token ids as length-delimited binary records, with an offset index for reads in any order.

A record file is a row of frames:

    length      8 bytes, little-endian, bytes of the payload
    check       4 bytes, masked CRC-32 of the length field
    payload     flags (1 byte: 1 if the document has an id, 2 if ids take 4 bytes), document id (8 bytes), ids (2 or 4 bytes
                each, unsigned; 2 where the vocabulary has at most 65,536 ids)
    check       4 bytes, masked CRC-32 of the payload

A masked checksum is the CRC turned right by 15 bits plus a constant, so that a checksum over data that holds checksums
stays sound. The index file beside it holds the offset of each frame (8 bytes each), so a reader can jump to any record.

Files are written by the tasks through pyarrow's file systems, below one folder that all executors share. A task names its
files anew at each attempt, and the manifest (a Parquet table) lists those of the attempts that succeeded: files of lost or
repeated tasks are never read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulage.llm import batches, vocabulary

#: A file is closed when it holds this much, so that readers get many equal pieces.
FILE_BYTES = 16 << 20
#: Pre-tokens a task remembers before it starts its memory anew. It affects time only.
WORDS_KEPT = 500_000

_MASK = 0xA282EAD8
_APART = re.compile(f" [{vocabulary.LETTER}]+")
_MANIFEST = pa.schema(
    [("part", pa.int32()), ("piece", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("tokens", pa.int64())]
)


class CorruptRecord(ValueError):
    """A frame whose length or payload does not match its checksum, or that is cut off."""


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    """A frame of ids held in 16- or 32-bit unsigned integers."""
    flags = (doc_id is not None) + 2 * (ids.dtype.itemsize == 4)
    payload = struct.pack("<Bq", flags, doc_id or 0) + ids.tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack("<I", masked(zlib.crc32(length))), payload, struct.pack("<I", masked(zlib.crc32(payload))))
    )


def read_at(data: bytes, offset: int) -> tuple[int | None, np.ndarray, int]:
    """(document id, ids, offset of the next frame) of the frame at `offset`."""
    head = data[offset : offset + 12]
    if len(head) < 12 or struct.unpack_from("<I", head, 8)[0] != masked(zlib.crc32(head[:8])):
        raise CorruptRecord(f"frame at {offset}: length")
    start = offset + 12
    end = start + struct.unpack_from("<Q", head)[0]
    payload = data[start:end]
    if len(data) < end + 4 or struct.unpack_from("<I", data, end)[0] != masked(zlib.crc32(payload)):
        raise CorruptRecord(f"frame at {offset}: payload")
    flags, doc_id = struct.unpack_from("<Bq", payload)
    return (doc_id if flags & 1 else None), np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=9), end + 4


def read_all(data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    offset = 0
    while offset < len(data):
        doc_id, ids, offset = read_at(data, offset)
        yield doc_id, ids


class TextEncoder:
    """The tokenizers library with a memory of pre-tokens: a pre-token's ids do not depend on what stands around it."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.specials = vocabulary.specials(spec)
        step = spec.get("pre_tokenizer") or {}
        #: Only files that split this way take the short path.
        self.usual = spec.get("normalizer") is None and step.get("type") == "ByteLevel" and step.get("use_regex") and not step.get("add_prefix_space")
        self.cut = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        vocab = self.library.get_vocab()
        largest = max([*vocab.values(), *self.specials.values()], default=0)
        self.kind = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        #: Whether a token begins with a space.
        space = vocabulary.byte_letters()[ord(" ")]
        self.opens = np.zeros(largest + 1, bool)
        self.opens[[n for text, n in vocab.items() if text.startswith(space)]] = True
        self.ids: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, new: list[str]) -> None:
        """Ids of pre-tokens not yet met. Those of one space and letters keep apart when written one after another, so the
        library gets them as one text; each begins at the one of its tokens that holds the space. The others go to it one by one."""
        joined, single = [], []
        for word in new:
            (joined if _APART.fullmatch(word) else single).append(word)
        width = self.kind.itemsize
        for i in range(0, len(joined), 20_000):
            some = joined[i : i + 20_000]
            ids = np.array(self.library.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, self.kind)
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) != len(some) or starts[0]:
                raise ValueError("pre-tokens did not keep apart")
            data, cuts = ids.tobytes(), [*(starts * width).tolist(), len(ids) * width]
            self.ids.update(zip(some, [data[a:b] for a, b in zip(cuts, cuts[1:])]))
        for i in range(0, len(single), 20_000):
            some = single[i : i + 20_000]
            for word, made in zip(some, self.library.encode_batch(some, add_special_tokens=False)):
                self.ids[word] = np.array(made.ids, self.kind).tobytes()

    def encode_slice(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned integers of this vocabulary's width (`kind`)."""
        split: list[list[str] | None] = []
        for text in texts:
            if not self.usual or not vocabulary.plain(text):
                split.append(None)
            elif "<|" in text and self.cut is not None:
                split.append(
                    [w for i, p in enumerate(self.cut.split(text)) for w in ([p] if i % 2 else vocabulary.BYTE_SPLIT.findall(p))]
                )
            else:
                split.append(vocabulary.BYTE_SPLIT.findall(text))
        if len(self.ids) > WORDS_KEPT:
            self.ids.clear()
        self._learn(list(set().union(*(s for s in split if s)).difference(self.ids)))
        get = self.ids.__getitem__
        return [self._whole(t) if s is None else b"".join(map(get, s)) for t, s in zip(texts, split)]


@lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
    return TextEncoder(path)


def _open(folder: str):
    from pyarrow import fs

    if "://" not in folder and ":/" not in folder:
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def write(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode each whole text, append `end_id`, and write records in ascending id order below `folder`. Returns the manifest.

    Part `p` holds smaller ids than part `p + 1`; in a part the pieces follow each other. NULL texts are like empty ones, NULL
    ids come first, repeated rows give a record each (equal ids in the order of a hash of their texts), other columns of `docs` are not
    looked at. An empty table gives no record.
    """
    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ordered = picked.repartitionByRange(_parts(spark), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), text_encoder(tokenizer)
        system, place = _open(folder)
        system.create_dir(f"{place}/data", recursive=True)
        attempt, manifest = uuid.uuid4().hex, []
        frames: list[bytes] = []
        held = tokens = 0

        def close() -> None:
            nonlocal frames, held, tokens
            name = f"part-{part:06d}-{len(manifest):04d}-{attempt}"
            with system.open_output_stream(f"{place}/data/{name}.rec") as out:
                for one in frames:
                    out.write(one)
            offsets = np.cumsum([0, *map(len, frames)])[:-1]
            with system.open_output_stream(f"{place}/data/{name}.idx") as out:
                out.write(offsets.astype("<u8").tobytes())
            manifest.append((part, len(manifest), f"{name}.rec", len(frames), tokens))
            frames, held, tokens = [], 0, 0

        for piece in batches.slices(parts):
            ids = piece.column("doc_id").to_pylist()
            for doc_id, made in zip(ids, encoder.encode_slice(batches.strings(piece))):
                ids_of = np.append(np.frombuffer(made, encoder.kind), np.array([end_id], encoder.kind))
                frames.append(frame(doc_id, ids_of))
                held += len(frames[-1])
                tokens += len(ids_of)
                if held >= FILE_BYTES:
                    close()
        if frames:
            close()
        yield batches.rows(_MANIFEST, **{n: [m[i] for m in manifest] for i, n in enumerate(_MANIFEST.names)})

    made = ordered.mapInArrow(run, "part int, piece int, file string, records long, tokens long")
    made.write.mode("overwrite").parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(part, piece, file, records, tokens, first_token): first_token counts the ids in all files before.

    The running sum goes over parts (as many as tasks wrote) and then over the pieces of each part.
    """
    listed = spark.read.schema("part int, piece int, file string, records long, tokens long").parquet(f"{folder}/manifest")
    parts = listed.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    before = parts.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("before"))
    inside = Window.partitionBy("part").orderBy("piece")
    return (
        listed.join(before, "part")
        .withColumn("first_token", F.col("before") + F.sum("tokens").over(inside) - F.col("tokens"))
        .drop("before")
    )


def read(spark: SparkSession, folder: str, digest_only: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of each record, from the files; every checksum is verified."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
        + ([] if digest_only else [("ids", pa.list_(pa.int64()))])
    )
    listed = manifest(spark, folder).select("file", "first_token").repartition(_parts(spark), "file")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _open(folder)
        for part in parts:
            for file, start in zip(part.column("file").to_pylist(), part.column("first_token").to_pylist()):
                with system.open_input_stream(f"{place}/data/{file}") as stream:
                    data = stream.read()
                out: dict[str, list] = {n: [] for n in schema.names}
                for doc_id, ids in read_all(data):
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["n_tokens"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(ids.astype("<u4")))
                    if not digest_only:
                        out["ids"].append(ids.astype(np.int64))
                    start += len(ids)
                yield batches.rows(schema, **out)

    names = "doc_id long, start long, n_tokens long, ids_crc32 long" + ("" if digest_only else ", ids array<long>")
    return listed.mapInArrow(run, names)


def read_record(folder: str, file: str, number: int) -> tuple[int | None, np.ndarray]:
    """One record, by its number in a file, through the offset index: reads eight bytes and then the frame alone."""
    system, place = _open(folder)
    base = f"{place}/data/{file}"
    with system.open_input_file(base.removesuffix(".rec") + ".idx") as index:
        index.seek(8 * number)
        offset = struct.unpack("<Q", index.read(8))[0]
    with system.open_input_file(base) as records:
        records.seek(offset)
        head = records.read(12)
        rest = records.read(struct.unpack_from("<Q", head)[0] + 4)
    doc_id, ids, _ = read_at(head + rest, 0)
    return doc_id, ids
