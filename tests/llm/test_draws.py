"""Periodic runs, importance resampling and packing against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haulage.llm import catalogue, packing, periods, resampling
from tests.llm.conftest import odd_rows, prose

WORD = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"


def plain_runs(words: list, least: int) -> list[tuple[int, int, int]]:
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            inside = any(s <= start and s + m >= start + length for s, m, _ in found)  # a smaller period holds all of it
            if length >= 2 * q and not inside:
                found.append((start, length, q))
    return sorted((r for r in found if r[1] >= least), key=lambda r: (r[0], r[2]))


def runs_of(texts: list[list], least: int) -> list[list[tuple[int, int, int]]]:
    codes, begins, ends = periods._coded(texts)
    own: list[list] = [[] for _ in texts]
    first = np.cumsum([0, *map(len, texts)])
    for start, length, period in periods.periodic(codes, ends, least) if len(codes) else []:
        row = int(np.searchsorted(first, start, side="right")) - 1
        own[row].append((start - int(first[row]), length, period))
    return [sorted(r, key=lambda r: (r[0], r[2])) for r in own]


@given(st.lists(st.text(alphabet="ab", max_size=70), max_size=4), st.sampled_from([4, 5, 7, 12]))
@settings(max_examples=300, deadline=None)
def test_runs_over_few_letters(texts, least):
    split = [[c.encode() for c in t] for t in texts]
    assert runs_of(split, least) == [plain_runs(w, least) for w in split]


def test_short_runs_beside_pairs_that_occur_once():
    texts = [[c.encode() for c in t] for t in ("aab", "ababab")]
    assert runs_of(texts, 4) == [[], [(0, 6, 2)]]


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_repetitive_sequences(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(5):
        words: list[bytes] = []
        while len(words) < rng.randint(5, 150):
            unit = [b"%d" % rng.randint(0, 3) for _ in range(rng.randint(1, 9))]
            words += unit * rng.randint(1, 6) if rng.random() < 0.8 else words[: rng.randint(0, 60)]
        texts.append(words)
    texts.append([b"x"] * rng.randint(1, 60))
    assert runs_of(texts, 12) == [plain_runs(w, 12) for w in texts]


def test_positions_keep_their_order():
    rng = random.Random(5)
    numbers = rng.sample(range(100_000), 5000)
    own = periods.Positions(numbers[0])
    for n, x in enumerate(numbers[1:], 1):
        if n % 97 == 0:
            before = sorted(numbers[:n])
            at = int(np.searchsorted(before, x))
            assert own.around(x) == (before[at - 1] if at else None, before[at] if at < n else None)
        own.add(x)
    assert list(own) == sorted(numbers) and own.size == 5000 and max(map(len, own.chunks)) <= own.CHUNK


def plain_digest(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 12)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    numbers = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *numbers, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_periods_of_odd_rows(spark, odd, nothing):
    given = [(i, t) for i, t, *_ in odd_rows() if t is None or len(t.split()) < 5000]
    # ids of edited documents, with texts of all lengths
    chosen = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    given += [(i, prose(i, n)) for n, i in enumerate(chosen)] + [(chosen[0], None), (chosen[1], " \n"), (chosen[2], "a b c d e f " * 9)]
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(3).withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit("x"))
    made = periods.digests(periods.found(periods.doubled(docs))).collect()
    assert sorted(map(str, map(tuple, made))) == sorted(str(plain_digest(i, t)) for i, t in given)
    assert periods.doubled(odd).columns == odd.columns
    assert periods.digests(periods.found(periods.doubled(odd))).count() == len(odd_rows())
    long = {r.doc_id: r for r in periods.found(odd).collect()}
    assert [tuple(r) for r in long[9].runs] == [(0, 3000, 1)] and long[9].collapsed == "tie"
    assert periods.digests(periods.found(periods.doubled(nothing))).count() == 0


def plain_resampling(rows, target, percent=5):
    def features(text):
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
        return words, [b" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]

    made = [(i, *features(t)) for i, t in rows]
    s = Counter(zlib.crc32(f) % 10000 for _, _, fs in made for f in fs)
    t = Counter(zlib.crc32(f) % 10000 for text in target for f in features(text)[1])
    total, wanted = sum(s.values()), sum(t.values())
    out = []
    for i, words, fs in made:
        buckets = [zlib.crc32(f) % 10000 for f in fs]
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (total + 10000) / ((s[b] + 1) * (wanted + 10000)))) for b in buckets)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(fs), weight, score, None, len(words)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return [tuple(r[:5]) for r in out]


@pytest.mark.parametrize("percent", [0, 5, 37, 100])
def test_resampling_of_odd_rows(spark, odd, nothing, percent):
    target = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    texts = [r.text for r in target.collect()]
    found = resampling.resampled(odd, target.withColumn("weight", F.lit(1)), percent=percent).collect()
    want = plain_resampling([r[:2] for r in odd_rows()], texts, percent)

    def tidy(rows):  # which of the rows alike in all but their rank is drawn first is open
        return sorted(map(str, rows))

    assert tidy((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found) == tidy(want)
    assert resampling.resampled(nothing, target, percent=percent).count() == 0
    assert all(r["rank"] is None for r in resampling.resampled(odd, nothing, percent=0).collect())


def test_one_text_that_fills_a_third_of_the_rows(spark):
    rows = [(7, prose(1, 30))] * 100 + [(i, prose(i, 30)) for i in range(100, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = resampling.resampled(docs, docs, percent=50).collect()
    ranks = [r["rank"] for r in found if r["rank"] is not None]
    assert sorted(ranks) == list(range(1, 151)) and len(found) == 300
    best = sorted(found, key=lambda r: (-r.score, r.doc_id))[:150]
    assert Counter(r.doc_id for r in best) == Counter(r.doc_id for r in found if r["rank"] is not None)


@given(st.lists(st.integers(-40, 40), min_size=1, max_size=60), st.data())
@settings(max_examples=15, deadline=None)
def test_cut_is_exact(spark, numbers, data):
    need = data.draw(st.integers(1, len(numbers)))
    rows = spark.createDataFrame([(n,) for n in numbers], "x long")
    x = sorted(numbers)[need - 1]
    assert resampling.cut(rows, "x", need) == (x, sum(n < x for n in numbers), sum(n <= x for n in numbers))


def whole(pieces, size):
    """Documents put together again from their pieces; fails where a piece or a sequence is not as promised."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in pieces:
        assert len(r.ids) == 4 * r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append((r.start, bytes(r.ids), r.doc_tokens))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == size or end < size and end & (end - 1) == 0
    return documents


@pytest.mark.parametrize("size, most_open, parts", [(4096, 32, 3), (64, 4, 5), (7, 2, 4), (1, 1, 2)])
def test_packing_of_odd_rows(spark, odd, nothing, size, most_open, parts):
    library = Tokenizer.from_file(WORD)
    rows = [r for r in odd_rows() if r[0] is not None and (size > 64 or len(r[1] or "") < 2000)]
    docs = odd.where(f"doc_id IS NOT NULL AND ({size} > 64 OR coalesce(length(text), 0) < 2000)").repartition(parts)
    found = whole(packing.packed(docs, WORD, size=size, most_open=most_open).collect(), size)
    want = defaultdict(list)
    for doc_id, text, *_ in rows:
        want[doc_id].append(np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
    assert found.keys() == want.keys()
    for doc_id, texts in want.items():
        if len(texts) == 1:
            assert b"".join(ids for _, ids, _ in sorted(found[doc_id])) == texts[0]
            assert {n for *_, n in found[doc_id]} == {len(texts[0]) // 4}
        assert sum(len(ids) for _, ids, _ in found[doc_id]) == sum(map(len, texts))
    if size == 4096:
        assert packing.packed(nothing, WORD).count() == 0
        assert packing.packed(odd, WORD).where("doc_id IS NULL").count() >= 2


@given(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 16), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_packer_fills_windows(lengths, size, most_open):
    full: list[list] = []
    packer = packing.Packer(size, most_open, lambda pieces: full.append(list(pieces)))
    for doc, n in enumerate(lengths):
        packer.add(doc, np.arange(n, dtype="<u4").tobytes())
        assert len(packer.windows) <= most_open
    tail = packer.tail()
    assert all(sum(len(ids) for *_, ids in pieces) == 4 * size for pieces in full)
    assert sum(len(ids) for *_, ids in tail) < 4 * size
    for doc, n in enumerate(lengths):
        own = sorted((start, ids) for pieces in [*full, tail] for d, start, total, ids in pieces if d == doc and total == n)
        assert b"".join(ids for _, ids in own) == np.arange(n, dtype="<u4").tobytes()


@given(st.text(alphabet="abcdeéß÷×µªº 's!?12\n<|>endoftx", max_size=80) | st.text(max_size=40))
@settings(max_examples=300, deadline=None)
def test_word_ids_are_those_of_the_library(text):
    encoder = packing.word_ids(WORD)
    made, = encoder.of(pa.array([text]))
    assert np.frombuffer(made, "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids


def test_packing_query_needs_no_padding(spark):
    rows = catalogue.op13_packing(spark, SMALL).collect()
    sums: dict = defaultdict(int)
    for r in rows:
        sums[r.sequence_id] += r.length
    assert sum(n < 4096 for n in sums.values()) <= 12
    assert len({r.doc_id for r in rows}) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
