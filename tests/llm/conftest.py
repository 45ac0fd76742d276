from __future__ import annotations

import random

import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, doc string, th long, marks string, kind int, h long, "
    "size string, score string, target string, kept string, rest string, part string, n string, taken string, place int"
)
EXTRA = ("x", 1, "m", 2, 3, "s", "0.5", "t", "k", "r", "p", "n", "y", 4)


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    stems = ["ham", "tor", "vel", "ine", "qua", "lor", "sed", "mun", "pra", "dol", "eth", "ova"]
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 4))) for _ in range(words))


def odd_rows() -> list[tuple]:
    """NULLs in every column, empty, short and very long texts, ties, repeated rows, one id with two texts, unusual characters."""
    one, two = prose(1, 180), prose(2, 220)
    texts = [
        (1, one, "en", "b"),
        (2, one, "en", "a"),
        (3, one + " " + two, "de", "a"),
        (4, two.replace("ham", "HAM", 1), None, None),
        (5, "", "en", "a"),
        (6, None, "en", "a"),
        (7, " \t\n ", "fr", ""),
        (8, "word", "fr", "c"),
        (8, "word", "fr", "c"),
        (9, "tie " * 3000, "fr", "c"),
        (10, "x" * 150_000, "de", "c"),
        (11, prose(3, 20_000), "de", "a"),
        (12, "İ ΑΣ ﬁ \x1c漢字　é <|endoftext|> <|startoftext|>don't \x00\x85½²👩‍👩‍👧", "de", "d"),
        (12, "another text with the same id", None, "d"),
        (None, one, "en", "a"),
        (None, None, None, None),
        (13, two[:-5], "en", "e"),
        (14, "é" * 120 + " " + one[:400] + "ß" * 90, "fr", "e"),
        (15, "a b", "en", "e"),
    ]
    return [(i, t, lang, source, None if t is None else len(t), *EXTRA) for i, t, lang, source in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(small):
    return sorted((r.doc_id, r.text) for r in small.select("doc_id", "text").collect())
