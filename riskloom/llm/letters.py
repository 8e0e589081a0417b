"""Texts as arrays of code points, folded to lower-case letters, zeros and spaces."""

from __future__ import annotations

import sys
from functools import cache

import numpy as np

SPACE, ZERO, FEED = 0x20, 0x30, 0x0A


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def as_text(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


@cache
def fold_table(digits: bool) -> np.ndarray:
    """For every code point: a letter in lower case (itself, if that is several characters), a
    digit as 0 if ``digits``, and a space for all else."""
    table = np.full(sys.maxunicode + 1, SPACE, np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha() or (digits and c.isalnum() and not c.isdecimal()):
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
        elif digits and c.isdecimal():
            table[i] = ZERO
    return table


def single_spaces(points: np.ndarray) -> np.ndarray:
    """No space at the start, at the end, or beside a space or line feed."""
    blank = points == SPACE
    edge = blank | (points == FEED)
    drop = blank.copy()
    drop[1:] &= edge[:-1]
    points, edge, blank = points[~drop], edge[~drop], blank[~drop]
    drop = blank.copy()
    drop[:-1] &= edge[1:]
    if drop.size:
        drop[-1] = blank[-1]
    return points[~drop]
