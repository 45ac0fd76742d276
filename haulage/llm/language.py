"""Language identification by unigram piece models whose score sums over all segmentations.

A word is a run of letters, in lower case, with the word mark before it. Under a language's model its probability is the sum,
over every way to cut it into pieces of a fixed public vocabulary, of the product of the piece probabilities: a forward pass
over the word's characters. Pieces do not cross words, so a text's log likelihood is the sum over its words, and equal words
are computed once per task. A character that the vocabulary lacks is spelt by its byte pieces.

The piece probabilities of each language come from expectation maximisation over the words of the learning rows: the
expected count of a piece over all segmentations (forward and backward) is its new weight. What is held by the driver and by
every task is a table of pieces by languages, bounded by the vocabulary.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm import batches
from haulage.session import scratch

LETTERS = re.compile(r"[^\W\d_]+")
MARK = "▁"
#: Learning rows per language, about: chosen by a hash of id and text (the documented bound of this fit). Scoring covers all rows.
LEARNED_DOCUMENTS = 4_000
ROUNDS = 3
#: More languages than this would make the model table too large to hand to every task.
MOST_LANGUAGES = 500
WORDS_KEPT = 300_000
_FLOOR = 0.05  # added to each expected count


@dataclass
class Model:
    """Piece probabilities, pieces by languages; `single` holds those of the 256 byte pieces."""

    languages: list[str]
    pieces: list[str]
    probs: np.ndarray
    single: np.ndarray
    prior: np.ndarray
    longest: int


def vocabulary(path: str) -> dict[str, int]:
    """Pieces of a sentencepiece file made of lower-case letters and the word mark, with their ids; and byte pieces by name."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = {}
    for n in range(model.get_piece_size()):
        piece = model.id_to_piece(n)
        body = piece.removeprefix(MARK)
        if model.is_byte(n) or (body == "" and piece) or (body.isalpha() and body == body.lower()):
            kept[piece] = n
    return kept


def words(text: str) -> list[str]:
    """Runs of letters. Number signs like ½ or ² pass the pattern, but are no letters: they part words."""
    found = LETTERS.findall(text.lower())
    if found and not "".join(found).isalpha():
        found = [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]
    return found


class Lattice:
    """Forward and backward passes over the segmentations of one word. Rows of alpha are rescaled, so long words don't underflow."""

    def __init__(self, model: Model):
        self.pieces, self.single = dict(zip(model.pieces, model.probs)), list(model.single)
        self.longest, self.ones = model.longest, np.ones(len(model.languages))

    def edges(self, word: str) -> tuple[str, list[list[tuple[int, object, np.ndarray]]]]:
        """Per end position: (start, piece or byte values, probabilities)."""
        text, get = MARK + word, self.pieces.get
        into: list = [[]]
        for end in range(1, len(text) + 1):
            found = []
            for start in range(max(0, end - self.longest), end):
                piece = text[start:end]
                p = get(piece)
                if p is not None:
                    found.append((start, piece, p))
            if not found or found[-1][0] != end - 1:
                spelt = text[end - 1].encode("utf-8", "surrogatepass")
                p = self.ones
                for byte in spelt:
                    p = p * self.single[byte]
                found.append((end - 1, spelt, p))
            into.append(found)
        return text, into

    def forward(self, into) -> tuple[list[np.ndarray], list[float]]:
        alpha, scale = [self.ones], [0.0]
        for found in into[1:]:
            top = max(scale[start] for start, _, _ in found)
            total = 0.0
            for start, _, p in found:
                part = alpha[start] * p
                total = total + (part if scale[start] == top else part * math.exp(scale[start] - top))
            size = float(total.max())
            if size < 1e-100 or len(alpha) > 60:
                size = size or 1e-300
                total, top = total / size, top + math.log(size)
            alpha.append(total)
            scale.append(top)
        return alpha, scale

    def log_probability(self, word: str) -> np.ndarray:
        """Log of the sum over all segmentations, per language."""
        alpha, scale = self.forward(self.edges(word)[1])
        return np.log(np.maximum(alpha[-1], 1e-300)) + scale[-1]


class WordScores:
    """Log probabilities of words, a row of the matrix for each word met.

    The pieces of all new words are found in a trie of pieces; then the forward pass goes over all these words together, one
    step for each end position and piece length. Long words, and words with characters that have no piece, go one by one.
    """

    LONGEST = 32  # letters: up to here the product of the least piece probabilities does not underflow

    def __init__(self, model: Model):
        self.lattice, self.probs = Lattice(model), model.probs
        self.trie: dict = {}
        for n, piece in enumerate(model.pieces):
            node = self.trie
            for letter in piece:
                node = node.setdefault(letter, {})
            node[""] = n
        self.rows: dict[str, int] = {}
        self.matrix = np.zeros((1024, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        if len(self.rows) > WORDS_KEPT:
            self.rows.clear()
        new = list(words.difference(self.rows))
        while len(self.matrix) < len(self.rows) + len(new):
            self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
        trie, base, slow = self.trie, len(self.rows), []
        codes: list[int] = []
        add = codes.append
        for w, word in enumerate(new):
            self.rows[word] = base + w
            text = MARK + word
            size = len(text)
            if size > self.LONGEST:
                slow.append(w)
                continue
            for start in range(size):
                node, end = trie, start
                while end < size:
                    node = node.get(text[end])
                    if node is None:
                        break
                    end += 1
                    if "" in node:
                        add((end << 56) | ((end - start) << 48) | (w << 20) | node[""])
                if end == start or "" not in trie[text[start]]:
                    slow.append(w)
                    break
        steps = np.sort(np.array(codes, np.int64))
        alpha = np.zeros((len(new), self.LONGEST + 1, self.matrix.shape[1]))
        alpha[:, 0] = 1.0
        cuts = np.flatnonzero(np.diff(steps >> 48)) + 1
        for some in np.split(steps, cuts) if len(steps) else ():
            end, length = int(some[0] >> 56), int(some[0] >> 48) & 255
            w, piece = (some >> 20) & 0xFFFFFFF, some & 0xFFFFF
            alpha[w, end] += alpha[w, end - length] * self.probs[piece]
        last = np.minimum(np.fromiter(map(len, new), np.int64, len(new)) + 1, self.LONGEST)
        self.matrix[base : base + len(new)] = np.log(np.maximum(alpha[np.arange(len(new)), last], 1e-300))
        for w in slow:
            self.matrix[base + w] = self.lattice.log_probability(new[w])

    def total(self, words: list[str]) -> np.ndarray:
        return self.matrix[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))].sum(axis=0)


def expected(word: str, probs: dict[str, float], single: list[float], longest: int) -> dict[object, float]:
    """Expected number of uses of each piece in a word, in one language. Byte values stand for characters without a piece."""
    text = MARK + word
    n = len(text)
    into: list[list[tuple[int, object, float]]] = [[]]
    forward = [1.0] + [0.0] * n
    scale = [0.0] * (n + 1)  # log factors taken out of `forward`, so that long words do not underflow
    get = probs.get
    for end in range(1, n + 1):
        found, total = [], 0.0
        for start in range(end - longest if end > longest else 0, end):
            piece = text[start:end]
            p = get(piece)
            if p is not None:
                found.append((start, piece, p))
        if not found or found[-1][0] != end - 1:
            spelt = text[end - 1].encode("utf-8", "surrogatepass")
            found.append((end - 1, spelt, math.prod(single[b] for b in spelt)))
        top = scale[end - 1]
        for start, _, p in found:
            part = forward[start] * p
            total += part if scale[start] == top else part * math.exp(scale[start] - top)
        if total < 1e-120:
            top += math.log(total or 5e-324)
            total = 1.0
        forward[end], scale[end] = total, top
        into.append(found)
    # share[end]: probability that a cut lies there; a piece's share is the part of it that came through that piece
    share = [0.0] * n + [1.0]
    uses: dict[object, float] = {}
    for end in range(n, 0, -1):
        here = share[end]
        if here < 1e-12:
            continue
        base, top = forward[end], scale[end]
        for start, piece, p in into[end]:
            part = here * forward[start] * p / base
            if scale[start] != top:
                part *= math.exp(scale[start] - top)
            share[start] += part
            uses[piece] = uses.get(piece, 0.0) + part
    return uses


def learn(rows: DataFrame, path: str, rounds: int = ROUNDS, most: int = LEARNED_DOCUMENTS) -> Model:
    """Fit piece probabilities on (doc_id, text, lang); rows with a NULL or empty text or a NULL lang are not used.

    Of each language about `most` rows are used, chosen by a hash of id and text (the documented bound of this fit); all, if there
    are fewer, so that a rare language is learned however large the table is. The prior is each language's share of all usable
    rows. Words are counted per language by Spark and each round of expectation maximisation is a job over the counts.
    """
    spark = rows.sparkSession
    usable = rows.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r.lang: r["count"] for r in usable.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "lang", "text"), 1) / F.lit(2.0**63)
    large = {lang: most / n for lang, n in sizes.items() if n > most}
    if large:
        limits = F.create_map(*(F.lit(x) for pair in large.items() for x in pair))
        chosen = usable.where(draw < F.coalesce(F.try_element_at(limits, F.col("lang")), F.lit(1.0)))
    else:
        chosen = usable
    kept = scratch(spark, "language-words")
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(parts):
            found: Counter = Counter()
            docs: Counter = Counter()
            for text, lang in zip(batches.strings(part), batches.strings(part, "lang")):
                own = words(text)
                if own:
                    docs[lang] += 1
                    found.update((lang, w) for w in own)
            keys = [*found, *((lang, None) for lang in docs)]
            yield batches.rows(
                schema,
                lang=[k for k, _ in keys],
                word=[w for _, w in keys],
                n=[found.get(k, 0) for k in keys],
                docs=[docs[k] if w is None else 0 for k, w in keys],
            )

    counted = chosen.mapInArrow(count, "lang string, word string, n long, docs long")
    counted.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).write.parquet(kept)
    table = spark.read.schema("lang string, word string, n long, docs long").parquet(kept)
    heads = {r.lang: r.docs for r in table.where("word IS NULL").select("lang", "docs").collect()}
    languages = sorted(heads)
    ids = vocabulary(path)
    if not languages:
        return Model([], [], np.zeros((0, 0)), np.zeros((256, 0)), np.zeros(0), 1)
    longest = max(map(len, ids))
    bytes_of = {f"<0x{b:02X}>": b for b in range(256)}
    pieces = [p for p in ids if p not in bytes_of]
    probs, single = (np.full((n, len(languages)), 1.0 / (len(pieces) + 256)) for n in (len(pieces), 256))
    counts = table.where("word IS NOT NULL").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    for _ in range(rounds):
        probs, single = _round(counts, languages, pieces, probs, single, longest)
    # a language's learning rows stand for all its rows
    weight = np.array([heads[x] * max(1.0, sizes[x] / most) for x in languages])
    prior = np.log(weight / weight.sum())
    return Model(languages, pieces, probs, single, prior, longest)


def _round(counts: DataFrame, languages: list[str], pieces: list[str], probs: np.ndarray, single: np.ndarray, longest: int):
    """One round of expectation maximisation. What comes back to the driver is one row per language and used piece."""
    number = {x: n for n, x in enumerate(languages)}
    given = counts.sparkSession.sparkContext.broadcast((pieces, probs, single))
    schema = pa.schema([("lang", pa.string()), ("piece", pa.binary()), ("byte", pa.bool_()), ("n", pa.float64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table, table_of_bytes = given.value
        of = {x: (dict(zip(names, table[:, n].tolist())), table_of_bytes[:, n].tolist()) for x, n in number.items()}
        found: dict = {}
        for part in parts:
            for lang, word, n in zip(part.column("lang").to_pylist(), part.column("word").to_pylist(), part.column("n").to_pylist()):
                for piece, share in expected(word, *of[lang], longest).items():
                    for key in [piece] if isinstance(piece, str) else [bytes([b]) for b in piece]:
                        found[lang, key] = found.get((lang, key), 0.0) + n * share
        keys = list(found)
        yield batches.rows(
            schema,
            lang=[k for k, _ in keys],
            piece=[p.encode() if isinstance(p, str) else p for _, p in keys],
            byte=[not isinstance(p, str) for _, p in keys],
            n=[found[k] for k in keys],
        )

    summed = counts.mapInArrow(run, "lang string, piece binary, byte boolean, n double").groupBy("lang", "piece", "byte").agg(F.sum("n").alias("n"))
    weight, byte_weight = np.full_like(probs, _FLOOR), np.full_like(single, _FLOOR)
    place = {p: n for n, p in enumerate(pieces)}
    for row in summed.collect():
        column = number[row.lang]
        if row.byte:
            byte_weight[row.piece[0], column] += round(row.n, 6)
        else:
            weight[place[bytes(row.piece).decode()], column] += round(row.n, 6)
    given.unpersist()
    total = weight.sum(axis=0) + byte_weight.sum(axis=0)
    return weight / total, byte_weight / total


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, lang_pred, score) and the columns in `keep`: the likeliest learned language of each whole text and its posterior probability.

    `und` with score 0 for texts that are NULL or hold no letter, and for every text when nothing was learned. Ties go to the
    language that sorts first. Rows, repeated ones too, stay as they are.
    """
    spark = docs.sparkSession
    given = spark.sparkContext.broadcast(model)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keep, F.col(text_col).cast("string").alias("text"))
    kinds = ", ".join(f"{name} {kind}" for name, kind in picked.select(*keep).dtypes)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Model = given.value
        known = WordScores(fitted)
        for part in batches.slices(parts):
            split = [words(t) if t and fitted.languages else [] for t in batches.strings(part)]
            known.learn(set().union(*split))
            names, scores = [], []
            for own in split:
                if not own:
                    names.append("und")
                    scores.append(0.0)
                    continue
                total = fitted.prior + known.total(own)
                best = int(total.argmax())
                names.append(fitted.languages[best])
                scores.append(float(1.0 / np.exp(total - total[best]).sum()))
            columns = {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}
            left = [part.column(n) for n in ("doc_id", *keep)]
            yield pa.RecordBatch.from_arrays([*left, *columns.values()], names=["doc_id", *keep, *columns])

    return picked.mapInArrow(run, "doc_id long, " + (kinds + ", " if keep else "") + "lang_pred string, score double")


def identified(spark: SparkSession, docs: DataFrame, path: str, folds: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learn from rows whose CRC-32 of the id's digits leaves another remainder than `held`."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds
    model = learn(docs.where(fold != held), path)
    return predict(docs.withColumn("held_out", fold == held), model, keep=("held_out",))
