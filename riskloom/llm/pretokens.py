"""Pre-tokens of byte-level BPE, as the two tokenizer libraries split them."""

from __future__ import annotations

import base64
import unicodedata
from functools import cache

import regex
import tiktoken

_BEYOND = regex.compile(r"[^\x00-՗]")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Splitter:
    """The matches of ``pattern``; its letters and numbers are those of the tokenizer libraries.

    Characters that only the installed ``regex`` knows as letters or numbers, being newer than the
    libraries' tables, are found out by asking the library, once, and taken out of the classes of
    the pattern wherever a text has one of them.
    """

    def __init__(self, pattern: str):
        self._plain = self._exact = regex.compile(pattern)
        self._newer = None
        if out := _newer():
            self._newer = regex.compile(f"[{out}]")
            exact = pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{out}])")
            for kind in (r"\p{L}", r"\p{N}"):
                exact = exact.replace(f"?{kind}+", f"?(?:(?![{out}]){kind})+")
            self._exact = regex.compile(exact)

    def __call__(self, text: str) -> list[str]:
        rare = _BEYOND.search(text) and self._newer and self._newer.search(text)
        return (self._exact if rare else self._plain).findall(text)


@cache
def _newer() -> str:
    """Ranges of characters that ``regex`` takes for letters or numbers and the library does not."""
    one_byte = {bytes([i]): i for i in range(256)}
    known = tiktoken.Encoding("letters", pat_str=r"[\p{L}\p{N}]", mergeable_ranks=one_byte, special_tokens={})
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    # what the older table of the standard library has, all have
    odd = [
        ord(c)
        for c in regex.findall(r"[\p{L}\p{N}]", every)
        if unicodedata.category(c) == "Cn" and not known.encode_ordinary(c)
    ]
    ranges: list[list[int]] = []
    for i, point in enumerate(odd):
        if i == 0 or odd[i - 1] != point - 1:
            ranges.append([point, point])
        ranges[-1][1] = point
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)
