"""Language and quality models, vector search, mixing, the queries and the pipeline."""

from __future__ import annotations

import itertools
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from haulage.llm import catalogue, language, mixture, neighbours, quality
from tests import oracle
from tests.llm.conftest import SMALL, odd_rows, prose

PIECES = public_tokenizers.path("piece_bpe_32k.model")
MIDDLE = "/root/testdata/sf0.01"


def test_probability_is_the_sum_over_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "▁ab"]
    rng = np.random.default_rng(2)
    model = language.Model(["x", "y"], pieces, rng.random((len(pieces), 2)), rng.random((256, 2)), np.zeros(2), 3)
    table = dict(zip(pieces, model.probs))

    def all_ways(text):
        if not text:
            return np.ones(2)
        total = sum((table[text[:n]] * all_ways(text[n:]) for n in range(1, len(text) + 1) if text[:n] in table), np.zeros(2))
        if text[0] not in table:
            spelt = math.prod(model.single[b] for b in text[0].encode())
            total = total + spelt * all_ways(text[1:])
        return total

    words = ["a", "ab", "abba", "babab", "aéb", "漢a", "ab" * 40]
    known = language.WordScores(model)
    known.learn(set(words))
    for word in words:
        alone = known.lattice.log_probability(word)
        assert np.allclose(known.total([word]), alone)
        if len(word) < 10:
            assert np.allclose(alone, np.log(all_ways("▁" + word)))
            probs, single = {p: v[0] for p, v in table.items()}, [v[0] for v in model.single]
            uses = language.expected(word, probs, single, 3)
            covered = sum(n * (len(p) if isinstance(p, str) else 1) for p, n in uses.items())
            assert math.isclose(covered, len(word) + 1, rel_tol=1e-9)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    found = catalogue.op1_language(spark, MIDDLE).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out and language.LETTERS.search(r.text)]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_a_rare_language_is_learned_among_many_documents(spark):
    common = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the house of number "), F.col("id"), F.lit(" is old")).alias("text"), F.lit("en").alias("lang"))
    few = spark.createDataFrame([(50_000 + i, f"żółty dom numer {i} jest stary", "pl") for i in range(4)], "doc_id long, text string, lang string")
    model = language.learn(common.unionByName(few), PIECES, rounds=1, most=100)
    assert model.languages == ["en", "pl"]
    assert np.allclose(np.exp(model.prior), [20_000 / 20_004, 4 / 20_004], rtol=0.5)
    assert {r.lang_pred for r in language.predict(few, model).collect()} == {"pl"}


def test_languages_of_odd_rows(spark, odd, nothing):
    found = language.identified(spark, odd, PIECES).collect()
    assert len(found) == len(odd_rows())
    by_id = {r.doc_id: r for r in found}
    assert {by_id[i].lang_pred for i in (5, 6, 7)} == {"und"} and by_id[6].score == 0
    assert language.identified(spark, nothing, PIECES).count() == 0
    untaught = language.learn(odd.withColumn("lang", F.lit(None).cast("string")), PIECES)
    assert {r.lang_pred for r in language.predict(odd, untaught).collect()} == {"und"}


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    found = catalogue.op3_quality(spark, MIDDLE).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.94


def test_quality_with_little_to_learn_from(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    marks = spark.createDataFrame([(i, i % 2) for i in range(1, 15)] + [(3, None), (None, 1), (4, 7)], "doc_id long, quality int")
    for labels in (none, marks, marks.where("quality = 1")):
        found = quality.judged(spark, odd, labels).collect()
        assert len(found) == len(odd_rows()) and all(0 <= r.score <= 1 for r in found)
        assert quality.judged(spark, nothing, labels).count() == 0


def _vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype("float32").tolist()) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(160)]  # a large group of equal vectors
    rows += [(None, rows[1][1]), (601, None), (602, [0.0] * 8), (603, [math.nan] * 8), (604, [1.0] * 7 + [None]), (605, [1.0]), (650, [math.inf] * 8), (50, rows[50][1])]
    return rows, spark.createDataFrame([(*r, "e") for r in rows], "vec_id long, embedding array<float>, score string")


def test_nearest_vectors(spark):
    rows, frame = _vectors(spark)
    sound = {i: np.array(v, float) for i, v in rows if i is not None and i < 600}
    names = np.array(sorted(sound))
    every = np.stack([sound[i] for i in names])
    hits = total = 0
    found: dict = {}
    for r in neighbours.nearest(frame).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {i for i in sound if i % 50 == 0}
    for query, got in found.items():
        score = every @ sound[query] / (np.linalg.norm(every, axis=1) * np.linalg.norm(sound[query]))
        others = names != query
        best = names[others][np.lexsort((names[others], -np.round(score[others], 12)))][:5].tolist()
        got = sorted(got)
        assert [g[0] for g in got] == [1, 2, 3, 4, 5] and all(abs(dict(zip(names, score))[v] - s) < 1e-12 for _, v, s in got)
        hits, total = hits + len(set(best) & {v for _, v, _ in got}), total + 5
        if query == 0 or query >= 400:
            assert [v for _, v, _ in got] == best
    assert hits / total >= 0.9


def test_few_or_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], kind)
    assert [(r["rank"], r.vec_id) for r in neighbours.nearest(three).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert neighbours.nearest(three.limit(0)).count() == 0


def test_vector_recall(spark):
    rows = spark.read.parquet(f"{MIDDLE}/embeddings.parquet").collect()
    names, every = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    every /= np.linalg.norm(every, axis=1, keepdims=True)
    found: dict = {}
    for r in catalogue.op2_permutations(spark, MIDDLE).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for query, got in found.items():
        score = every @ every[names == query][0]
        score[names == query] = -2
        hits += len(got & set(names[np.argsort(-score)[:5]].tolist()))
    assert hits / (5 * len(found)) >= 0.9


def test_inverse_of_integrated_schedules(spark):
    for schedule in (*mixture.SCHEDULES, ((0.0, 1.0), (0.3, 5.0), (0.3, 0.0), (0.6, 0.0), (1.0, 2.0))):
        whole = mixture.integral(schedule)
        shares = [0.0, 0.1, 0.25, 0.5, 0.77, 0.999, 1.0]
        frame = spark.createDataFrame([(s,) for s in shares], "s double")
        times = [r.t for r in frame.select(mixture.inverse(schedule, F.col("s")).alias("t")).collect()]
        assert times == sorted(times)
        for share, time in zip(shares, times):
            grid = np.linspace(0, time, 200_001)
            done = np.trapezoid(np.interp(grid, [t for t, _ in schedule], [w for _, w in schedule]), grid) if time else 0.0
            assert abs(done / whole - share) < 2e-3


def _levels(sizes, weights, wanted):
    """Targets by sharing the excess again and again."""
    target, free = dict.fromkeys(sizes, 0.0), set(sizes)
    left = wanted
    while free:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if weights[s] * level > 2 * sizes[s]}
        for s in over or free:
            target[s] = 2.0 * sizes[s] if over else weights[s] * level
        if not over:
            break
        left -= sum(target[s] for s in over)
        free -= over
    return target


def test_mixture_of_odd_rows(spark, odd, nothing):
    found = mixture.assigned(odd).select("doc_id", "source", "size", "source_size", "target", "taken", "position").collect()
    assert len(found) == len(odd_rows())
    sizes: dict = {}
    for _, text, _, source, *_ in odd_rows():
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), itertools.cycle([3.0, 1.0, 2.0])))
    target = _levels(sizes, weights, 1.5 * sum(sizes.values()))
    taken: dict = {}
    for r in found:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source])
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)
    assert mixture.assigned(nothing).count() == 0 and mixture.curriculum(nothing).count() == 0


def test_curriculum_repeats_and_orders_documents(spark, small, odd):
    out = mixture.curriculum(small)
    assert out.columns == small.columns and mixture.curriculum(odd).columns == odd.columns
    rows = [tuple(r) for r in out.select("doc_id").collect()]
    assert rows == [tuple(r) for r in mixture.curriculum(small.repartition(7)).select("doc_id").collect()]
    want = {r.doc_id: r.rounds + (2 * r.part >= r.size and r.part > 0) for r in mixture.assigned(small).collect()}
    assert all(sum(1 for (i,) in rows if i == doc) == n for doc, n in want.items())


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_matches_its_statement(spark, name):
    db = oracle.database(SMALL)
    frame = catalogue.QUERIES[name](spark, SMALL)
    names = ", ".join(sorted(frame.columns))
    ours = sorted(map(str, frame.select(*sorted(frame.columns)).collect()))
    theirs = db.sql(catalogue.ORACLE[name]).project(names)
    row = type(frame.first())
    assert ours == sorted(str(row(**dict(zip(sorted(frame.columns), r)))) for r in theirs.fetchall())


def test_all_operators_have_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in catalogue.QUERIES) == list(range(1, 14))
    assert set(catalogue.QUERIES) | {"pipeline"} <= set(driver.queries())


def test_pipeline_stages(spark, odd, nothing):
    labels = f"{SMALL}/labels.parquet"
    assert spark.read.parquet(labels).count()
    for start in (odd, nothing):
        docs = start
        for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
            made = stage(spark, docs, SMALL)
            if n < len(corpus_pipeline.STAGES) - 1:
                assert made.columns == start.columns, name
            docs = spark.createDataFrame(made.collect(), made.schema)
        assert start is odd or docs.count() == 0


def test_pipeline_keeps_one_of_each_group_and_good_documents(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.keep_good(spark, docs, MIDDLE).collect()}
    good, bad = ({i for i, q in labels.items() if q == v} for v in (1, 0))
    assert len(good - kept) / len(good) < 0.03 and len(bad & kept) / len(bad) < 0.15
    once = [r.doc_id for r in corpus_pipeline.keep_one(spark, docs.unionByName(docs.limit(20)), MIDDLE).collect()]
    assert len(once) == len(set(once))
    texts = {r.doc_id: r.text for r in docs.collect()}
    first: dict = {}
    for i in sorted(texts):
        first.setdefault(texts[i], i)
    assert set(once) <= set(first.values())


def test_pipeline_runs(spark):
    made = corpus_pipeline.run(spark, SMALL)
    assert made.columns == ["doc_id", "n_tokens", "ids", "decoded"] and made.count() > 100


def test_pipeline_keeps_unlike_texts_of_one_id_and_drops_copies_without_id(spark):
    one, two, near = prose(1, 200), prose(2, 200), prose(1, 199)
    rows = [(1, one), (1, two), (1, two), (2, one), (3, near), (4, prose(4, 100)), (None, two), (None, prose(5, 60)), (None, prose(5, 60)), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.keep_one(spark, docs, SMALL)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    twos = [f for f in found if f[1] == two]
    assert len(twos) == 1 and twos[0][0] in (1, None)
    assert sorted((f for f in found if f[1] != two), key=str) == sorted([(2, one), (4, prose(4, 100)), (None, prose(5, 60)), (5, None), (6, "")], key=str)


def test_very_small_and_large_vectors_have_neighbours(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 8))
    scale = np.array([1e-200, 1.0, 1e200])[np.arange(120) % 3]
    rows = [(n, [float(x) for x in v * s]) for n, (v, s) in enumerate(zip(base, scale))]
    found = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    hits = 0
    for q in {r.query_id for r in found}:
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert all(r.score == r.score and abs(r.score - unit[q] @ unit[r.vec_id]) < 1e-9 for r in own) and len(own) == 5
        best = [int(i) for i in np.argsort(-(unit @ unit[q])) if i != q][:5]
        hits += len(set(best) & {r.vec_id for r in own})
    assert hits >= 13


def test_number_signs_are_no_letters():
    assert language.words("½ ② 5 Ⅷ") == [] and language.words("a²b ½c Été") == ["a", "b", "c", "été"]
