"""BPE by trie, and binary records, against the tokenizers library."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from haulage.llm import bpe, packing, records
from haulage.session import scratch
from tests.llm.conftest import odd_rows

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE)


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text_is_encoded_as_by_the_library(text):
    encoder = bpe.encoder(WORD)
    library = encoder.library
    ids = library.encode(text, add_special_tokens=False).ids
    (found, decoded), = encoder.encode_slice([text])
    assert np.frombuffer(found, "<u4").tolist() == ids
    assert decoded == library.decode(ids, skip_special_tokens=False) == encoder.decode(ids)


@given(st.text(alphabet="abcdeéß÷×µªº 's!?12\n<|>endoftx", max_size=80))
@settings(max_examples=200, deadline=None)
def test_byte_level_ids_are_those_of_the_library(text):
    encoder = records.text_encoder(BYTE)
    made, = encoder.encode_slice([text])
    assert np.frombuffer(made, encoder.kind).tolist() == encoder.library.encode(text, add_special_tokens=False).ids


def test_long_words_take_time_in_proportion():
    import random
    import time

    draw, encoder = random.Random(5), bpe.encoder(WORD)
    took = {}
    for size in (50_000, 400_000):
        text = "".join(draw.choices("abcdeilnorst", k=size))
        start = time.process_time()
        (found, _), = encoder.encode_slice([text])
        took[size] = time.process_time() - start
        assert np.frombuffer(found, "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids
    encoder.forget()
    assert took[400_000] < 24 * max(took[50_000], 0.05)  # 8 times the letters; a square would be 64


def test_digests_of_odd_rows(odd, word):
    found = sorted(tuple(r) for r in bpe.digests(odd.where("doc_id IS NOT NULL"), WORD).collect())
    want = []
    for doc_id, text, *_ in odd_rows():
        ids = word.encode(text or "", add_special_tokens=False).ids
        decoded = word.decode(ids, skip_special_tokens=False).encode()
        if doc_id is not None:
            want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    assert found == sorted(want)
    assert bpe.encoded(odd, WORD).count() == len(odd_rows())


def _spark_hash(text: str) -> int:
    """xxhash64 of one text column: seed 42, signed."""
    made = xxhash.xxh64_intdigest(text.encode(), 42)
    return made - (1 << 64) if made >> 63 else made


def _expected(rows, byte):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, _spark_hash(r[1] or ""))):
        ids = [*byte.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("parts", [1, 2, 3, 4, 5, 7, 12, 40])
def test_records_come_back(spark, odd, byte, parts):
    folder = scratch(spark, "t")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        files = records.write(odd, folder, BYTE).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    found = records.read(spark, folder).collect()
    want = _expected([r[:2] for r in odd_rows()], byte)
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found], key=lambda r: r[1]) == want
    # through the index, in any order
    one = max(files, key=lambda f: f.records)
    doc_id, ids = records.read_record(folder, one.file, one.records - 1)
    assert any(r.doc_id == doc_id and r.ids == ids.tolist() for r in found)


def test_records_of_nothing(spark, nothing):
    folder = scratch(spark, "t")
    records.write(nothing, folder, BYTE)
    assert records.read(spark, folder, digest_only=True).count() == 0
    assert bpe.digests(nothing, WORD).count() == 0


@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_a_damaged_record_is_refused(kind):
    data = records.frame(7, np.arange(5, dtype=kind)) + records.frame(None, np.zeros(0, kind))
    assert [(i, x.tolist()) for i, x in records.read_all(data)] == [(7, [0, 1, 2, 3, 4]), (None, [])]
    for place in (0, 9, 14, 25, len(data) - 1):
        broken = bytearray(data)
        broken[place] ^= 1
        with pytest.raises(records.CorruptRecord):
            list(records.read_all(bytes(broken)))
    with pytest.raises(records.CorruptRecord):
        list(records.read_all(data[:-1]))


class _Watched:
    """An object whose named methods note what they were asked."""

    def __init__(self, inner, *names):
        self.inner, self.names, self.asked = inner, names, []

    def __getattr__(self, name):
        if name in self.names:
            return lambda x, **options: (self.asked.append(x), getattr(self.inner, name)(x, **options))[1]
        return getattr(self.inner, name)


def test_words_of_letters_are_learned_without_offsets(byte):
    encoder = records.TextEncoder(BYTE)
    encoder.library = _Watched(encoder.library, "encode", "encode_batch")
    texts = ["An ordinary text, with été and 12 words", "more more words\n\n of it", ""]
    made = encoder.encode_slice(texts)
    assert [np.frombuffer(m, encoder.kind).tolist() for m in made] == [byte.encode(t, add_special_tokens=False).ids for t in texts]
    assert not any(records._APART.fullmatch(x) for asked in encoder.library.asked for x in ([asked] if isinstance(asked, str) else asked))
    assert not [x for x in encoder.library.asked if isinstance(x, str)]


def test_token_lengths_are_not_counted_anew_for_each_word(word, monkeypatch):
    encoder, asked = bpe.Encoder(WORD), []
    monkeypatch.setattr(bpe.WordEncoder, "_length", lambda self, token: asked.append(token))
    text = "unbelievable unbelievably internationalisation of été's"
    (found, _), = encoder.encode_slice([text])
    assert np.frombuffer(found, "<u4").tolist() == word.encode(text, add_special_tokens=False).ids
    assert not asked


def test_words_of_letters_are_not_split(word, monkeypatch):
    encoder, split = packing.WordIds(WORD), _Watched(packing.vocabulary.WORD_SPLIT, "findall")
    monkeypatch.setattr(packing.vocabulary, "WORD_SPLIT", split)
    texts = ["Plain words and été, don't it's x2 plain", None, "ſharp words"]
    made = encoder.of(pa.array(texts, pa.string()))
    assert [np.frombuffer(m, "<u4").tolist() for m in made] == [word.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sorted(split.asked) == ["don't", "it's", "x2", "été,"]
