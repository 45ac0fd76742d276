"""Splitting texts as the public byte-level tokenizers do; unusual texts go through the tokenizers library itself."""

from __future__ import annotations

import re

#: Characters whose class (letter, digit, white space, other) and lower case are the same in every Unicode version.
_PLAIN = "\t-\r -~À-ÖØ-öø-įı-ſ–—‘’“”…€"
LETTER = "A-Za-zÀ-ÖØ-öø-įı-ſ"
ODD = re.compile(f"[^{_PLAIN}]")

# The split patterns of the two tokenizers, over plain characters.
BYTE_SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[0-9]+| ?[^\s{LETTER}0-9]+|\s+(?!\S)|\s+"
)
WORD_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[0-9]|[^\s{LETTER}0-9]+")


def plain(text: str) -> bool:
    return text.isascii() and text.isprintable() or ODD.search(text) is None


def byte_letters() -> list[str]:
    """The printable stand-in of each byte value in byte-level vocabularies: printable Latin-1 stands for itself,
    the others follow from U+0100 on in order."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(others)) for b in range(256)]


def specials(tokenizer_json: dict) -> dict[str, int]:
    return {t["content"]: t["id"] for t in tokenizer_json.get("added_tokens", [])}
