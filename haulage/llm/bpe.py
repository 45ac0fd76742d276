"""BPE encoding by a trie of distinct words, and decoding.

The distinct words of a slice of documents are put into a trie, which is walked depth first. The state of a node is the
last token of the encoding of its prefix: the token t ending there whose text encodes to itself and which may stand after
the last token of the prefix before t (two tokens may be neighbours when encoding their joint text gives just these two).
Exactly one token does. A shared prefix is therefore encoded once, and a word's ids follow by stepping back from its end.

Word ends are symbols of their own (`x</w>`), so a word adds one last state, taken from the states of its prefix.
"""

from __future__ import annotations

import gc
import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.llm import batches, vocabulary

#: Words and token pairs a task remembers before it starts its memory anew. It affects time only.
WORDS_KEPT, PAIRS_KEPT = 150_000, 300_000

DIGEST = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


class Trie:
    """Distinct words by their prefixes: each node maps a character to a node; "" marks the end of a word."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, word: str) -> None:
        node = self.root
        for letter in word:
            nxt = node.get(letter)
            if nxt is None:
                nxt = node[letter] = {}
            node = nxt
        node[""] = True


class WordEncoder:
    """BPE of single words over a vocabulary with merges and an end-of-word mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        self.rank = {pair: n for n, pair in enumerate(merges)}
        ids = self.ids
        self.joined = {(ids[a], ids[b]): n for n, (a, b) in enumerate(merges)}
        #: Per token the merge that makes it (-1: a symbol) and its two parts.
        self.formed, self.left, self.right = [[-1] * (max(ids.values()) + 1) for _ in range(3)]
        for n, (a, b) in enumerate(merges):
            token = ids[a + b]
            if self.formed[token] < 0:
                self.formed[token], self.left[token], self.right[token] = n, ids[a], ids[b]
        self.texts = {n: t for t, n in self.ids.items()} | {n: t for t, n in vocabulary.specials(spec).items()}
        #: Letters of each token, without the end mark.
        self.lengths = {n: self._length(n) for n in self.texts}
        #: Tokens that encode to themselves, by their letters from the last to the first: without and with the end mark.
        self.inner, self.final = {}, {}
        for text, token in self.ids.items():
            marked = bool(self.end) and text.endswith(self.end) and text != self.end
            if self._itself(token):
                node = self.final if marked or not self.end else self.inner
                for letter in reversed(text[: len(text) - len(self.end)] if marked else text):
                    node = node.setdefault(letter, {})
                node[""] = token
        self.pairs: dict[tuple[int, int], bool] = {}

    def _symbols(self, token: int) -> tuple[str, ...]:
        """A token's text as BPE starts on it: characters, the last with the end mark if the token has it."""
        text = self.texts[token]
        if self.end and text.endswith(self.end):
            body = text[: -len(self.end)]
            return (*body[:-1], body[-1:] + self.end)
        return tuple(text)

    def _merge(self, symbols: tuple[str, ...]) -> list[str]:
        """Plain BPE: merge the pair of lowest rank, leftmost first, until none is left. Used on short token pairs only."""
        parts = list(symbols)
        rank = self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get((parts[i], parts[i + 1]))
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _itself(self, token: int) -> bool:
        return len(self._merge(self._symbols(token))) == 1

    def _neighbours(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(left, right)
        return known

    def _apart(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of two tokens.

        Goes back in time: undo the later of the merges that made the two pieces at the border, and ask whether the pieces
        then touching would have been merged first. Of two merges of one rank the left one comes first.
        """
        formed, joined = self.formed, self.joined
        next_a = next_b = len(joined)
        while True:
            crossing = joined.get((a, b))
            if crossing is not None and crossing < next_a and crossing <= next_b:
                return False
            made_a, made_b = formed[a], formed[b]
            if made_a < 0 and made_b < 0:
                return True
            if made_a >= made_b:
                next_a, a = made_a, self.right[a]
            else:
                next_b, b = made_b, self.left[b]

    def _last(self, path: list[str], states: list[int], ended: bool) -> int:
        """The last token of the encoding of the letters `path`, given those of its shorter prefixes (states[i]: of path[:i])."""
        node, start, found = self.final if ended or not self.end else self.inner, len(path), []
        for letter in reversed(path):
            node = node.get(letter)
            if node is None:
                break
            start -= 1
            token = node.get("")
            if token is not None:
                found.append((start, token))
        known = self.pairs
        while found:
            start, token = found.pop()
            if not start:
                return token
            apart = known.get((states[start], token))
            if apart or (apart is None and self._neighbours(states[start], token)):
                return token
        raise ValueError(f"no token ends {''.join(path[-20:])!r}: the vocabulary lacks a symbol")

    def encode(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Each distinct word with its ids, in the order of the trie."""
        trie = Trie()
        for word in words:
            trie.add(word)
        # `path` holds the letters down to the node at hand, `states` their last tokens: one of each for the whole walk
        path: list[str] = []
        states = [0]
        stack = [(0, "", trie.root)]
        lengths = self.lengths
        while stack:
            depth, letter, node = stack.pop()
            if depth:
                del path[depth - 1 :], states[depth:]
                path.append(letter)
                if len(node) > ("" in node):
                    states.append(self._last(path, states, False))
            if "" in node and depth:
                token = self._last(path, states, True)
                found, at = [token], depth - lengths[token]
                while at > 0:
                    token = states[at]
                    found.append(token)
                    at -= lengths[token]
                found.reverse()
                yield "".join(path), found
            stack.extend((depth + 1, below, nxt) for below, nxt in node.items() if below)

    def _length(self, token: int) -> int:
        text = self.texts[token]
        return len(text) - len(self.end) if self.end and text.endswith(self.end) else len(text)


class Encoder:
    """Texts to ids and back, as the tokenizers library does with the same file, without added special tokens."""

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer

        self.words = WordEncoder(path)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            self.specials = vocabulary.specials(json.load(file))
        self.cut = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        letters = vocabulary.byte_letters()
        self.high = {n: "".join(letters[b] for b in chr(n).encode()) for n in range(0x80, 0x2100) if not 0xD800 <= n < 0xE000}
        self.low = {n: letters[n] for n in range(0x80)}
        self.table = self.low | self.high
        self.packed = {n: n.to_bytes(4, "little") for n in self.words.texts}
        self.ids: dict[str, bytes] = {}
        self.spelt: dict[str, str] = {}

    def _split(self, text: str) -> list[str]:
        """Pre-tokens, written in the vocabulary's byte letters."""
        if vocabulary.plain(text):
            found = vocabulary.WORD_SPLIT.findall(text.lower())
            if text.isascii():
                return found
            table = self.table
            return [w if w.isascii() else w.translate(table) for w in found]
        tidy = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(tidy)]

    def split(self, text: str) -> list[str]:
        """Pre-tokens and, under their own names, special tokens that stand in the text."""
        if self.cut is None or "<|" not in text:
            return self._split(text)
        parts = self.cut.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self._split(part))]

    def learn(self, words: set[str]) -> None:
        """Encode the words not yet known. Words of special tokens are known by name."""
        if len(self.ids) > WORDS_KEPT:
            self.ids.clear()
            self.spelt.clear()
        for word, token in self.specials.items():
            self.ids[word] = np.array([token], "<u4").tobytes()
            self.spelt[word] = word
        texts, packed = self.words.texts, self.packed
        gc.disable()  # a trie is many small dictionaries without cycles
        for word, ids in self.words.encode(words.difference(self.ids)):
            self.ids[word] = b"".join([packed[n] for n in ids])
            self.spelt[word] = " ".join([texts[n] for n in ids])
        gc.enable()

    def forget(self) -> None:
        """At the end of a task: idle workers must not hold the memory that later stages need."""
        self.ids.clear()
        self.spelt.clear()
        self.words.pairs.clear()

    def encode_slice(self, texts: list[str | None]) -> Iterator[tuple[bytes, str]]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text, of each text. NULL is like empty."""
        split = [self.split(t) if t else [] for t in texts]
        self.learn(set().union(*split))
        for words in split:
            yield b"".join(map(self.ids.__getitem__, words)), " ".join(map(self.spelt.__getitem__, words))

    def decode(self, ids: Iterable[int]) -> str:
        """Token texts joined by a space: what the library's decode does for a file without a decoder; unknown ids are left out."""
        return " ".join([self.words.texts[n] for n in ids if n in self.words.texts])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): the ids of each whole text and the text decoded from them, one row per row of `docs`.

    NULL and empty texts give an empty list and an empty string; repeated rows and NULL ids stay as they are; other columns
    of `docs` are not looked at.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for part in batches.slices(parts):
            made = list(enc.encode_slice(batches.strings(part)))
            ids = [np.frombuffer(i, "<u4").astype(np.int32) for i, _ in made]
            yield batches.rows(schema, doc_id=part.column("doc_id"), ids=ids, decoded=[d for _, d in made])
        enc.forget()

    return _picked(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what `encoded` gives, without moving the ids out of the task."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for part in batches.slices(parts):
            n, one, two = [], [], []
            for ids, decoded in enc.encode_slice(batches.strings(part)):
                n.append(len(ids) // 4)
                one.append(hashlib.sha256(ids).hexdigest())
                two.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield batches.rows(DIGEST, doc_id=part.column("doc_id"), n_tokens=n, ids_sha256=one, decoded_sha256=two)
        enc.forget()

    return _picked(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
