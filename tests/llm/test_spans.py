"""Repeated stretches and near-duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulage.llm import anchors, batches, minhash, prints, repeats, spans
from haulage.llm.components import components
from tests.llm.conftest import odd_rows, prose


def words_removed(rows, window):
    """Rows (id, text) with unlike ids."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first: dict = {}
    for i, w in sorted(split, key=lambda r: (r[0] is not None, r[0] or 0)):
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] != i:
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def bytes_removed(rows, length):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if b[k : k + length] in seen:
                gone[k : k + length] = b"\1" * length
            else:
                seen.add(b[k : k + length])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return out


def alike(a, b):
    return sorted(map(str, a)) == sorted(map(str, b))


def once(rows):
    """One row for each id."""
    return list({r[0]: r for r in reversed(rows)}.values())


@pytest.fixture(scope="module")
def tangled():
    """Passages of all lengths around the limits, shared at shifted places, nested, repeated inside a document, in many documents."""
    rng = random.Random(5)
    pool = [prose(100 + k, n).split() for k, n in enumerate((49, 50, 51, 52, 70, 80, 95, 130, 30, 7))]
    rows = []
    for i in range(160):
        parts = []
        for _ in range(rng.randint(1, 6)):
            p = rng.choice(pool)
            start = rng.randint(0, 12)
            parts += p[start:] if rng.random() < 0.5 else p[: len(p) - start]
            parts += prose(1000 + rng.randint(0, 400), rng.randint(0, 3)).split()
        rows.append((i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("window", [50, 12])
def test_words_of_tangled_documents(spark, tangled, window, monkeypatch):
    found = anchors.removed(spark.createDataFrame(tangled, "doc_id long, text string").repartition(5), window)
    assert alike([tuple(r) for r in found.collect()], words_removed(tangled, window))


@pytest.mark.parametrize("length", [100, 24])
def test_bytes_of_tangled_documents(spark, tangled, length):
    found = repeats.removed(spark.createDataFrame(tangled, "doc_id long, text string").repartition(5), length)
    assert alike([tuple(r) for r in found.collect()], bytes_removed(tangled, length))


def test_given_documents(small, texts):
    assert alike([tuple(r) for r in anchors.removed(small).collect()], words_removed(texts, 50))
    assert alike([tuple(r) for r in repeats.removed(small).collect()], bytes_removed(texts, 100))


def test_odd_rows(spark, odd, nothing):
    rows = once([r[:2] for r in odd_rows()])
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, marks string, doc long")
    assert alike([tuple(r) for r in anchors.removed(frame).collect()], words_removed(rows, 50))
    assert alike([tuple(r) for r in repeats.removed(frame).collect()], bytes_removed(rows, 100))
    for made in (anchors.removed, repeats.removed, anchors.cleaned, repeats.cleaned, minhash.groups, prints.neighbours, prints.fingerprints):
        assert made(odd).count() == len(odd_rows())
        assert made(nothing).count() == 0
    assert repeats.cleaned(odd).columns == odd.columns


def test_equal_rows_are_one_document(spark):
    text = prose(9, 300)
    frame = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert [r.n_removed for r in repeats.removed(frame).collect()] == [0, 0]
    assert [r.n_removed for r in anchors.removed(frame).collect()] == [0, 0]


def test_cleaned_takes_each_text_once_and_keeps_the_rest(spark):
    text = " ".join(map(str, range(100, 150)))
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, text, "z"), (4, text, None)], "doc_id long, text string, source string")
    shape = []
    given, repeats.marked = repeats.marked, lambda *a, f=repeats.marked, **k: shape.append(f(*a, **k)) or shape[-1]
    try:
        made = sorted(tuple(r) for r in repeats.cleaned(docs).collect())
    finally:
        repeats.marked = given
    assert made == [(1, None, "x"), (2, "", "y"), (3, text, "z"), (4, "", None)]
    assert "string" not in [f.dataType.typeName() for f in shape[0].schema["rest"].dataType if f.name != "kept_1"]


def test_memory_of_suffix_arrays_is_that_of_a_small_block():
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 123, 160).astype(np.uint8).tobytes() for _ in range(8000)]
    n = 2 * len(texts)
    batch = batches.rows(
        spans.ROW, h=np.repeat(np.arange(len(texts)), 2), n=np.zeros(n, np.int64), doc=np.arange(n), at=np.zeros(n, np.int64),
        kind=np.full(n, repeats._SEGMENT, np.int32), more=[t for t in texts for _ in range(2)],
    )
    tracemalloc.start()
    try:
        found = sum(b.num_rows for b in repeats._resolve(repeats.Shape(100))(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == len(texts) and peak < 60e6


def test_cleaned_texts_stay_valid(spark):
    text = "é" * 200
    kept = [r.text for r in repeats.cleaned(spark.createDataFrame([(1, "a" + text), (2, "b" + text + "c")], "doc_id long, text string")).orderBy("doc_id").collect()]
    assert kept[1] == "bc" and kept[0].startswith("aé")


def test_suffix_array_finds_all_maximal_repeats():
    rng = random.Random(3)
    segments = ["".join(rng.choice("ab") for _ in range(rng.randint(5, 40))).encode() for _ in range(12)]
    least = 5
    array = repeats.SuffixArray(segments, np.zeros(len(segments), np.int64), least)
    bounds = np.cumsum([0, *map(len, segments)])
    whole = b"".join(segments)
    found = {whole[p[0] : p[0] + n]: sorted(p.tolist()) for n, p in array.repeats(least)}
    want: dict = {}
    for s, segment in enumerate(segments):
        for i in range(len(segment)):
            for j in range(i + least, len(segment) + 1):
                want.setdefault(segment[i:j], []).append((int(bounds[s]) + i, segment[i - 1 : i] if i else None, segment[j : j + 1] or None))
    for text, places in list(want.items()):
        lefts, rights = {p[1] for p in places}, {p[2] for p in places}
        if len(places) < 2 or (len(lefts) == 1 and None not in lefts) or (len(rights) == 1 and None not in rights):
            del want[text]
    assert found == {t: sorted(p[0] for p in places) for t, places in want.items()}


def _exact(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()}
    above = {i: i for i in sets}

    def top(i):
        return i if above[i] == i else top(above[i])

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                above[high] = low
    return sorted((i, len(sets[i]), top(i), top(i) == i) for i in ids)


@pytest.mark.parametrize("words, percent, block", [(3, 85, 512), (5, 80, 512), (5, 80, 7)])
def test_groups_are_those_of_all_pairs(spark, small, texts, words, percent, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(11)
    base = prose(77, 150).split()
    rows = list(texts)
    for i in range(300):  # a large group of near copies, many of them too far from the first
        copy = list(base)
        for _ in range(rng.randint(0, 12)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randint(0, 30)}"
        rows.append((10_000 + i, " ".join(copy)))
    found = minhash.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), words, percent)
    assert sorted(tuple(r) for r in found.collect()) == _exact(rows, words, percent)


def test_texts_go_out_once_for_a_centre(spark):
    """Members that are linked to the centre meet nobody else; a loose one meets all, and no two others meet for it."""
    members = spark.range(1, 4000).select(F.lit(0).cast("long").alias("centre"), F.col("id").alias("doc"))
    stars = minhash._stars(members).cache()
    assert stars.count() == 3999 + 8 and not stars.where("mark").count()
    every = members.unionByName(spark.range(1).select(F.col("id").alias("centre"), F.col("id").alias("doc"))).withColumn("text", F.lit(""))
    met = lambda loose: minhash._meetings(every.withColumn("mark", F.expr(loose)))
    assert not met("false").count()
    some = met("doc % 2000 = 7").cache()
    assert some.count() == 2 * 9 + 3998
    pairs = some.where("mark").alias("x").join(some.alias("y"), "cell").select("x.doc", F.col("y.doc").alias("other")).distinct()
    assert pairs.count() == 2 * 4000
    assert met("doc > 0").count() == 3999 * 9 + 8


def test_copies_by_the_thousand_and_ids_with_several_texts(spark):
    one, two, three = prose(31, 60), prose(32, 60), prose(33, 60)
    rows = [(i, one) for i in range(100, 3100)] + [(i, "") for i in range(5000, 6000)] + [(7000, two), (7001, two), (7001, three), (7002, three), (7002, three)]
    found = minhash.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 5, 80).distinct().collect()
    parts = {(r.doc_id, r.component_id, r.kept) for r in found}
    want = {(i, 100, i == 100) for i in range(100, 3100)} | {(i, i, True) for i in range(5000, 6000)}
    assert parts == want | {(i, 7000, i == 7000) for i in (7000, 7001, 7002)}


def test_groups_where_the_smallest_of_each_bucket_is_a_stranger(spark, monkeypatch):
    """Bands of one row: strangers with smaller ids share nearly every bucket of two near copies, a dozen of them each."""
    monkeypatch.setattr(minhash, "rows_for", lambda percent: 1)
    monkeypatch.setattr(minhash, "bands_for", lambda percent: 384)
    rng, rows = random.Random(4), []
    for pair in range(3):
        stock = [f"w{pair}x{k}" for k in range(100)]
        rows += [(1000 * pair + i, " ".join(rng.sample(stock, 15) + [f"own{pair}x{i}x{k}" for k in range(15)])) for i in range(150)]
        rows += [(1000 * pair + 900 + i, " ".join(stock[5 * i :] + [f"new{pair}x{i}x{k}" for k in range(5 * i)])) for i in range(2)]
    found = minhash.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 1, 85)
    want = _exact(rows, 1, 85)
    assert sum(not kept for *_, kept in want) == 3
    assert sorted(tuple(r) for r in found.collect()) == want


def test_cells_settle_all_near_pairs():
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, 2**64, (5, 6), dtype=np.uint64)
    bits = np.concatenate([kinds[rng.integers(0, 5, 80)], rng.integers(0, 2**64, (40, 6), dtype=np.uint64)])
    for row in bits[:80]:  # up to 120 bits of 384 turned
        for at in rng.integers(0, 384, rng.integers(0, 120)):
            row[at // 64] ^= np.uint64(1 << int(at % 64))
    ids = rng.permutation(120)
    groups: dict = {}
    for centre, doc in minhash._settle(ids, bits, 134, 65):
        groups.setdefault(centre, {centre}).add(doc)
    apart = np.bitwise_count(bits[:, None] ^ bits[None]).sum(axis=2)
    for i, j in zip(*np.nonzero(np.triu(apart <= 65, 1))):
        assert any({ids[i], ids[j]} <= g for g in groups.values())


def test_sketch_coordinates_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(1)
    shared, own = rng.integers(0, 2**63, 60, dtype=np.uint64), rng.integers(0, 2**63, 40, dtype=np.uint64)
    a, b = np.concatenate([shared, own[:20]]), np.concatenate([shared, own[20:]])
    made = minhash.sketches(np.concatenate([a, b, a[:1]]), np.repeat([0, 1, 2], [80, 80, 1]), 3, 512)
    assert (made != np.iinfo(np.uint64).max).all()
    assert abs((made[0] == made[1]).mean() - 0.6) < 0.1


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 160)]
    found = dict(map(tuple, components(spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")).collect()))
    assert Counter(found.values()) == {0: 41, 100: 60}


def test_prefix_hashes_compare_spans():
    one, two = "xx" + "hello world" + "a", "hello world" + "b"
    a, b = (prints.Prefixes(prints.points(t)) for t in (one, two))
    assert prints.common(a, 2, b, 0) == 11 and prints.common(a, 0, b, 0) == 0 and prints.common(a, 14, b, 0) == 0
    assert prints.equal(a, 2, b, 0, 11) and not prints.equal(a, 2, b, 0, 12)
    assert a.spans(3)[2] == b.spans(3)[0]


def test_fingerprints(spark, small, texts):
    found = {r.doc_id: r for r in prints.neighbours(small).collect()}
    order = sorted(texts, reverse=True)
    for n, (i, t) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        cut = len(t) // 3
        changed = t[: len(t) - cut] + following[:cut]
        assert (found[i].n_chars, found[i].edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert found[i].edited_fingerprint == prints.fingerprint(prints.points(changed))
        assert found[i].near_next == prints.likeness(found[i].fingerprint, prints.fingerprint(prints.points(following)))
    prints_of = {}
    for i, t in texts:
        assert prints_of.setdefault(found[i].fingerprint, t) == t
    long = [r for r in found.values() if r.n_chars > 200]
    assert np.mean([r.near_edited for r in long]) > 0.4 and np.median([r.near_next for r in long]) < 0.05
    alone = prints.neighbours(spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.near_next) for r in alone] == [(3, 1.0)]


def test_near_copies_on_either_side_of_the_short_length_are_alike(spark):
    text = prose(8, 60)
    of = lambda n: prints.fingerprint(prints.points(text[:n]))
    for m, n in ((47, 48), (40, 60), (47, 71)):
        assert prints.likeness(of(m), of(n)) == prints.likeness(of(n), of(m)) > 0.4
    assert prints.likeness(of(47), of(110)) > 0.1
    other = prints.fingerprint(prints.points(text[200:260]))
    assert prints.likeness(of(40), other) < 0.3
    rows = [(2, text[:60]), (1, "")]  # the next document is empty: 40 of 60 code points stay
    found = prints.neighbours(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert next(r.near_edited for r in found if r.doc_id == 2) > 0.4


def test_hot_anchors_are_spread(spark, monkeypatch):
    """One passage in every document, each time between other words: more contexts than a slice groups."""
    passage = prose(50, 55)
    rows = [(i, f"{prose(2000 + i, 40)} {passage} {prose(4000 + i, 40)}") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert alike([tuple(r) for r in anchors.removed(frame).collect()], words_removed(rows, 50))
    assert alike([tuple(r) for r in repeats.removed(frame).collect()], bytes_removed(rows, 100))
    counts = np.zeros(0, np.int64)
    assert spans.covered(3, counts, counts).tolist() == [False] * 3
