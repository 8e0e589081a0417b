"""SimHash fingerprints as sums of bits over word or shingle hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

#: Upper case to lower case, all else as it is.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SEED = 42
#: Hashes whose bits are spread out at a time.
STEP = 1 << 16


def shingle_hashes(words: list[bytes], width: int) -> Iterator[list[int]]:
    """XXH64 of every run of ``width`` words, in bounded lists; of all words if there are fewer."""
    if not words:
        return
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        yield [digest(b" ".join(words), SEED)]
        return
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - width + 1].tolist()
    stops = ends[width - 1 :].tolist()
    for k in range(0, len(starts), STEP):
        yield [digest(line[i:j], SEED) for i, j in zip(starts[k : k + STEP], stops[k : k + STEP])]


def fingerprint(hashes: Iterator[list[int]]) -> int:
    """Unsigned 64 bits, each set if it is set in over half of the hashes; no hashes give zero."""
    votes, n = np.zeros(64, np.int64), 0
    for part in hashes:
        bits = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(part)
    out = np.packbits(2 * votes > n, bitorder="little").view("<u8")[0]
    return int(out)


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of differing bits."""
    return np.bitwise_count(x ^ y)
