"""Fuzzy line dedup: one occurrence of each group of near-equal lines stays.

Lines are normalised and get a SimHash over their runs of GRAM characters, each counted as often
as it occurs. Fingerprints within LINK_BITS bits share at least two of five blocks
(pigeonhole), so they are compared where a pair of blocks is equal. Those tied together there are a
group; groups get their normalised texts, and two lines are linked if also their edit similarity
is at least MIN_SIMILARITY. Of each connected set of links the first occurrence, by doc_id and line
number, stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import meeting
from riskloom.llm.common import pick, settle, small_batches
from riskloom.llm.components import components
from riskloom.llm.letters import FEED, as_text, codes, fold_table, single_spaces
from riskloom.llm.meeting import STEP, dealt, ordered, tied
from riskloom.llm.simhash import apart

LINK_BITS = 3
MIN_SIMILARITY = 0.8
#: Characters from which, and edits up to which, the way by diagonals is taken.
LONG, FEW_EDITS = 4096, 64
#: Characters that must agree where a walk goes on, and most that it skips at a time.
PROBE, SKIP = 12, 48
#: Characters of a block that is set against the other text, and such blocks worked on at a time.
BLOCK, LANES = 64, 4096
#: Turns in which the blocks of a text are taken.
TURNS = 3
#: Characters from which blocks are tried before the distance.
BLOCKED = 192
#: Characters of pairs whose blocks are set against each other at a time, and pairs that may wait for it.
TOLD, WAITING = 1 << 23, 1 << 17
#: Lines that one call verifies, as texts take longer than fingerprints.
VERIFIED = 2_000
#: Lines of their own that can each be more than one in so many.
HEAVY_KEYS = 1000
#: Widths of the blocks; of five, at most three hold a differing bit.
BLOCKS = (13, 13, 13, 13, 12)
PAIRS = list(combinations(range(len(BLOCKS)), 2))
#: Bits of a size, and the mark of a fingerprint that several lines have.
SIZE, SHARED = (1 << 31) - 1, 1 << 62
#: Factors that hash the place of a group.
PLACE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: Characters of a run, and the factor that hashes them.
GRAM = 4
MIX = np.uint32(0x9E3779B1)
#: Runs whose bits are added up at a time: as many as a byte can count.
ADD = 255
#: Such pieces of lines added up at a time.
TOGETHER = 64
#: Characters taken at a time.
CHUNK = 1 << 18
#: Characters of lines that are handed on at a time.
BATCH = 1 << 21


def normalised(text: str) -> list[str]:
    """The lines of a text in lower case, digits as 0, with single spaces for all that is no
    letter or digit, and none at the ends."""
    points = codes(text)
    folded = np.where(points == FEED, np.uint32(FEED), np.take(fold_table(True), points))
    return as_text(single_spaces(folded)).split("\n")


def _run_bits() -> np.ndarray:
    """For each of 2^16 hashed runs, its 64 random bits as 64 bytes of 0 or 1 in 8 words."""
    bits = np.random.default_rng(42).integers(0, 2, (1 << 16, 64), dtype=np.uint8)
    return bits.view(np.uint64)


class LinePrints:
    """SimHash of lines over runs of GRAM characters, each as often as it occurs."""

    def __init__(self) -> None:
        self.table = _run_bits()

    def of(self, lines: list[str]) -> np.ndarray:
        """Unsigned 64 bits for each line; an empty line gives zero."""
        out = np.zeros(len(lines), np.uint64)
        k = 0
        while k < len(lines):
            size, n = 0, k
            while n < len(lines) and (n == k or size + len(lines[n]) < CHUNK):
                size += len(lines[n]) + GRAM
                n += 1
            out[k:n] = self._some(lines[k:n])
            k = n
        return out

    def _some(self, lines: list[str]) -> np.ndarray:
        # each line is closed by line feeds, so that it has as many runs as characters
        close = "\n" * (GRAM - 1)
        points = codes(close.join(lines) + close)
        runs = np.zeros(points.size - GRAM + 1, np.uint32)
        for k in range(GRAM):
            runs = runs * MIX + points[k : k + runs.size]
        runs = (runs * MIX) >> np.uint32(16)
        size = np.fromiter(map(len, lines), np.int64, len(lines))
        start = np.cumsum(size + GRAM - 1) - size - GRAM + 1
        # pieces of at most ADD runs, each of one line
        per = -(-size // ADD)
        owner = np.repeat(np.arange(len(lines)), per)
        votes = np.zeros((len(lines), 64), np.int64)
        if not owner.size:
            return np.zeros(len(lines), np.uint64)
        nth = np.arange(owner.size) - np.repeat(np.cumsum(per) - per, per)
        begin = start[owner] + nth * ADD
        stop = np.minimum(begin + ADD, start[owner] + size[owner])
        sums = np.empty((owner.size, 8), np.uint64)
        for i in range(0, owner.size, TOGETHER):
            lo, hi = begin[i], stop[min(i + TOGETHER, owner.size) - 1]
            rows = np.take(self.table, runs[lo:hi], axis=0)
            # what lies between two lines, if anything, is added up by itself and left out
            edges = np.stack([begin[i : i + TOGETHER], stop[i : i + TOGETHER]], axis=1).ravel()[:-1] - lo
            keep = np.ones(edges.size, bool)
            keep[1:-1:2] = edges[1:-1:2] != edges[2::2]
            inside = np.arange(edges.size)[keep] % 2 == 0
            sums[i : i + TOGETHER] = np.add.reduceat(rows, edges[keep], axis=0)[inside]
        some = np.flatnonzero(per)
        ones = sums.view(np.uint8).reshape(-1, 64).astype(np.int64)
        votes[some] = np.add.reduceat(ones, (np.cumsum(per) - per)[some], axis=0)
        return np.packbits(2 * votes > size[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _key(line: str) -> bytes:
    return xxhash.xxh3_64_digest(line.encode("utf-8", "surrogatepass"))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, key, fp, size) of all lines that are not blank once normalised."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text_hash long, line_no int, key binary, fp long, size int"

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = LinePrints()
        for b in it:
            rows, at, lines, size = [], [], [], 0
            for i, text in enumerate(b.column(2)):
                for k, line in enumerate(normalised(text.as_py() or "")):
                    if line:
                        rows.append(i)
                        at.append(k)
                        lines.append(line)
                        size += len(line)
                if size > BATCH or (lines and i + 1 == b.num_rows):
                    yield pa.RecordBatch.from_arrays(
                        [
                            b.column(0).take(pa.array(rows)),
                            b.column(1).take(pa.array(rows)),
                            pa.array(at, pa.int32()),
                            pa.array([_key(x) for x in lines], pa.binary()),
                            pa.array(prints.of(lines).view(np.int64)),
                            pa.array(map(len, lines), pa.int32()),
                        ],
                        names=["doc_id", "text_hash", "line_no", "key", "fp", "size"],
                    )
                    rows, at, lines, size = [], [], [], 0

    return docs.mapInArrow(batch, schema)


def joined_batches(fn):
    """``fn`` with its many small batches put together."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pile, n = [], 0
        for b in fn(it):
            pile.append(b)
            n += b.num_rows
            if n >= 20_000:
                yield from pa.Table.from_batches(pile).combine_chunks().to_batches()
                pile, n = [], 0
        if pile:
            yield from pa.Table.from_batches(pile).combine_chunks().to_batches()

    return run


def _texts_of(docs: DataFrame) -> DataFrame:
    """(key, line) of all lines that are not blank once normalised."""

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for text in b.column(0):
                lines = {x for x in normalised(text.as_py() or "") if x}
                if lines:
                    some = list(lines)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([_key(x) for x in some], pa.binary()), pa.array(some, pa.string())],
                        names=["key", "line"],
                    )

    return docs.select("text").mapInArrow(joined_batches(batch), "key binary, line string")


def _block_pairs(fps: DataFrame, crowds: list[list[int]]) -> DataFrame:
    """(key, crowd, home, fp, sizes): each fingerprint at each pair of its blocks; ``crowd`` if both have a
    value named in ``crowds``, a list per block."""
    blocks = list(zip(_blocks(), BLOCKS, crowds))
    at = [
        F.struct(
            F.lit(n << 26).bitwiseOR(F.shiftleft(x, w)).bitwiseOR(y).alias("key"),
            (x.isin(many) & y.isin(more) if many and more else F.lit(False)).alias("crowd"),
        )
        for n, ((x, _, many), (y, w, more)) in enumerate(combinations(blocks, 2))
    ]
    visits = fps.select("fp", "sizes", F.explode(F.array(*at)).alias("at"))
    return visits.select("at.key", "at.crowd", F.lit(True).alias("home"), "fp", "sizes")


def _blocks() -> list[Column]:
    """The blocks of a fingerprint."""
    start = np.cumsum((0, *BLOCKS)).tolist()
    return [
        F.shiftrightunsigned("fp", k).bitwiseAND(F.lit((1 << width) - 1).cast("long")) for k, width in zip(start, BLOCKS)
    ]


def _first_masks() -> np.ndarray:
    """For each pair of blocks the bits of every block that must differ if this is the first pair of equal ones."""
    start = np.cumsum((0, *BLOCKS)).tolist()
    out = np.zeros((16, len(BLOCKS) - 2), np.uint64)
    for n, (i, j) in enumerate(PAIRS):
        for m, k in enumerate(k for k in range(j) if k != i):
            out[n, m] = ((1 << BLOCKS[k]) - 1) << start[k]
    return out


MUST_DIFFER = _first_masks()


def first_pair(differ: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Whether, of the pairs of blocks in which no bits of ``differ`` are set, ``pair`` is the first."""
    masks = MUST_DIFFER[pair]
    return ((differ[..., None] & masks != 0) | (masks == 0)).all(axis=-1)


def _meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """(fp, component) of the fingerprints that are tied to another, or stand for several lines, in the
    squares of a cell. Of all pairs of blocks that two fingerprints share, they are tied in the first."""
    at, fp, sizes = pdf["key"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64), pdf["sizes"].to_numpy()
    home = pdf["home"].to_numpy() if "home" in pdf else np.ones(len(pdf), bool)
    spot = np.zeros(len(pdf), np.int64)
    if "row" in pdf:
        spot += pdf["row"].to_numpy().astype(np.int64) << 31 | pdf["column"].to_numpy()
    order = np.lexsort((~home, fp, spot, at))
    at, fp, sizes, home, spot = (x[order] for x in (at, fp, sizes, home, spot))
    new = np.r_[True, (at[1:] != at[:-1]) | (spot[1:] != spot[:-1])]
    keep = new | np.r_[True, fp[1:] != fp[:-1]]
    at, fp, sizes, home, spot, new = (x[keep] for x in (at, fp, sizes, home, spot, new))
    pair, low, high = at >> 26, sizes >> 31 & SIZE, sizes & SIZE

    def fits(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        near = (MIN_SIMILARITY * low[i] <= high[j]) & (MIN_SIMILARITY * low[j] <= high[i])
        near[near] = first_pair((fp[i] ^ fp[j])[near], pair[i][near])
        return near

    root = tied(np.r_[np.flatnonzero(new), at.size], fp, home, LINK_BITS, fits)
    several = np.bincount(root, minlength=root.size)[root] > 1
    lone = ~several & (sizes >> 62 > 0) & (pair == 0)
    spot[lone] = 0
    place = (at.view(np.uint64) * PLACE[0] ^ spot.view(np.uint64) * PLACE[1] ^ fp[root]) * PLACE[1]
    place = (place ^ place >> np.uint64(29)) * PLACE[0]
    rows = several | lone
    component = place.view(np.int64) & ~15 | pair
    return pd.DataFrame({"fp": fp[rows].view(np.int64), "component": component[rows]})


def fingerprint_groups(fps: DataFrame) -> DataFrame:
    """(fp, component): groups in which any two lines meet whose fingerprints are within LINK_BITS.

    ``fps`` has a row (fp, sizes) for each fingerprint: SHARED if several lines have it, and the lowest
    and highest size of its lines. A fingerprint is in a group for each pair of its blocks at most, where
    it is tied to others that the sizes let be similar. The number of that pair is ``component & 15``;
    a pair of lines is to be looked at where it is the first in which their fingerprints agree. All
    links taken together would join most long lines of a language, if there are many, in one group.

    Fingerprints that share a pair of blocks meet in one call. Only where both blocks have values of
    more than SQUARE fingerprints can the pair have so many; those are counted and dealt out.
    """
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), x.alias("value")) for n, x in enumerate(_blocks())]))
    counts = fps.select(each.alias("at")).groupBy("at.n", "at.value").agg(F.count(F.lit(1)).alias("rows"))
    crowds: list[list[int]] = [[] for _ in BLOCKS]  # a block has at most 2^13 values
    for r in counts.where(F.col("rows") > meeting.SQUARE).collect():
        crowds[r.n].append(r.value)
    visits = _block_pairs(fps, crowds)
    cells = max(1, -(-fps.count() * len(PAIRS) // meeting.CALL))
    cell = F.pmod(F.xxhash64("key"), F.lit(cells)).cast("long").alias("cell")
    schema = "fp long, component long"
    groups = visits.where(~F.col("crowd")).select("key", "fp", "sizes", cell).groupBy("cell").applyInPandas(_meet, schema)
    if sum(map(bool, crowds)) < 2:
        return groups
    crowd = dealt(visits.where("crowd").drop("crowd"), ["key"], "fp", ["fp", "sizes"])
    return groups.unionByName(crowd.groupBy("cell").applyInPandas(_meet, schema).distinct())


def _alike(a: str, i: int, b: str, j: int) -> int:
    """How many characters from a[i] and b[j] on are the same."""
    n, step = 0, 32
    while (x := a[i + n : i + n + step]) == (y := b[j + n : j + n + step]) and x:
        n, step = n + len(x), step * 2
    low, high = 0, min(len(x), len(y))
    while low < high:  # the first difference lies in these two
        mid = (low + high + 1) // 2
        low, high = (mid, high) if x[low:mid] == y[low:mid] else (low, mid - 1)
    return n + low


def few_edits(a: str, b: str, most: int) -> int | None:
    """Edit distance if it is at most ``most``: how far so many edits reach on each diagonal."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None
    reach = {0: _alike(a, 0, b, 0)}
    for edits in range(most + 1):
        if reach.get(m - n, -1) >= n:
            return edits
        further = {}
        for k in range(max(-n, -edits - 1), min(m, edits + 1) + 1):
            i = max(reach.get(k, -2) + 1, reach.get(k - 1, -1), reach.get(k + 1, -2) + 1)
            i = min(i, n, m - k)
            further[k] = i + _alike(a, i, b, i + k) if i >= max(0, -k) else -1
        reach = further
    return None


def middles(a: str, b: str) -> tuple[str, str]:
    """What is left of two texts without their common beginning and end."""
    n = _alike(a, 0, b, 0)
    a, b = a[n:], b[n:]
    n = _alike(a[::-1], 0, b[::-1], 0)
    return a[: len(a) - n], b[: len(b) - n]


def within(a: str, b: str, most: int) -> bool:
    """Whether one walk through both texts, a few characters skipped where they differ, needs at most
    ``most`` edits. The walk need not be the best one: a no leaves the edit distance open."""
    i = j = edits = 0
    while True:
        n = _alike(a, i, b, j)
        i, j = i + n, j + n
        rest = len(a) - i + len(b) - j
        if i == len(a) or j == len(b):
            return edits + rest <= most
        best, to = SKIP + 1, None
        for skip in range(min(SKIP, len(a) - i) + 1):
            if skip >= best:
                break
            at = b.find(a[i + skip : i + skip + PROBE], j, j + best - 1 + PROBE)
            if at >= 0 and max(skip, at - j) < best:
                best, to = max(skip, at - j), (i + skip, at)
        if to is None or (edits := edits + best) > most:
            return False
        i, j = to


def distance(a: str, b: str) -> int:
    """Edit distance: by diagonals if it is small for long texts, else by bit vectors over the middle that differs."""
    a, b = middles(a, b)
    if not a or not b:
        return len(a) + len(b)
    if max(len(a), len(b)) > LONG and (few := few_edits(a, b, FEW_EDITS)) is not None:
        return few
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full, last, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    plus, minus = full, 0
    for c in b:
        same = places.get(c, 0)
        diagonal = (((same & plus) + plus) ^ plus) | same | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        score += bool(up & last) - bool(down & last)
        up = (up << 1 | 1) & full
        plus = (down << 1 & full) | (full & ~(diagonal | up))
        minus = up & diagonal
    return score


def _edits(longer: int) -> int:
    """Edits within which a walk proves texts similar."""
    return int((1 - MIN_SIMILARITY) * longer * (1 - 1e-9))


def close(a: str, b: str) -> bool:
    """Whether a walk proves two texts similar; a no leaves it open."""
    return within(*middles(a, b), _edits(max(len(a), len(b))))


def far_apart(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Whether blocks prove two texts not to be similar; a no leaves it open.

    Blocks of the first text are set against the stretch of the second that they can stand against
    if so few edits lead from text to text. What edits they need at least, added up, is no more than the
    distance. Characters are taken modulo 64, which can only lower it. All blocks go through the bit
    vectors of Myers' search at once.
    """
    proved = np.zeros(len(pairs), bool)
    if not pairs:
        return proved
    n, m = (np.fromiter((len(p[k]) for p in pairs), np.int64, len(pairs)) for k in (0, 1))
    chars = [(codes("".join(p[k] for p in pairs)) & np.uint32(63)).astype(np.uint8) for k in (0, 1)]
    first, second = np.cumsum(n) - n, np.cumsum(m) - m
    allowed = ((1 - MIN_SIMILARITY) * np.maximum(n, m)).astype(np.int64) + 1
    # as many edits as the texts are shifted at a place stand before it, or bring the ends back after it
    low, high = (m - n - allowed) // 2, (m - n + allowed + 1) // 2
    per = n // BLOCK
    owner = np.repeat(np.arange(n.size), per)
    start = (np.arange(owner.size) - np.repeat(np.cumsum(per) - per, per)) * BLOCK
    order = np.argsort((high - low)[owner], kind="stable")
    least = np.zeros(owner.size, np.int64)
    # unlike texts need so many edits that a part of the blocks tells of most
    turn = (start[order] // BLOCK % TURNS).astype(np.int64)
    for n_th in range(TURNS):
        proved = np.bincount(owner, least, n.size) > allowed
        now = order[(turn == n_th) & ~proved[owner[order]]]
        _set_against(now, owner, start, first, second, low, high, m, chars, least)
    return np.bincount(owner, least, n.size) > allowed


def _set_against(order, owner, start, first, second, low, high, m, chars, least) -> None:
    """Puts into ``least`` the edits that each block of ``order`` needs at least."""
    for k in range(0, order.size, LANES):
        lanes = order[k : k + LANES]
        own, at = owner[lanes], start[lanes]
        row, equal = np.arange(lanes.size), np.zeros((lanes.size, 65), np.uint64)
        for i in range(BLOCK):
            equal[row, chars[0][first[own] + at + i]] |= np.uint64(1 << i)
        plus, minus = np.full(lanes.size, ~np.uint64(0)), np.zeros(lanes.size, np.uint64)
        score, best = np.full(lanes.size, BLOCK), np.full(lanes.size, BLOCK)
        place, one, top = at + low[own], np.uint64(1), np.uint64(BLOCK - 1)
        for _ in range(BLOCK + int((high - low)[own].max())):
            inside = (place >= 0) & (place < m[own])
            c = np.where(inside, chars[1][np.where(inside, second[own] + place, 0)], 64)
            same = equal[row, c]
            across = (((same & plus) + plus) ^ plus) | same
            up, down = minus | ~(across | plus), plus & across
            score += (up >> top).astype(np.int64) - (down >> top).astype(np.int64)
            np.minimum(best, score, out=best)
            up, down, same = up << one, down << one, same | minus
            plus, minus = down | ~(same | up), up & same
            place += 1
        least[lanes] = best


def similar(a: str, b: str) -> bool:
    """Edit similarity, one minus distance over the longer length, is at least MIN_SIMILARITY."""
    longer, shorter = max(len(a), len(b)), min(len(a), len(b))
    if longer == 0 or shorter < MIN_SIMILARITY * longer:
        return longer == 0
    # a walk that needs few enough edits proves it; else the distance tells
    return close(a, b) or 1 - distance(a, b) / longer >= MIN_SIMILARITY


def _verify(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) of line keys, verified on their texts, that span what all such links span.

    Of a pair, the higher key is at home in the square that looks at it, and the group is that of the
    first pair of blocks in which they agree.
    """
    links: list[tuple[bytes, bytes]] = []
    pdf, cuts = ordered(pdf, ["component"])
    fp, home = pdf["fp"].to_numpy().view(np.uint64), pdf["home"].to_numpy()
    keys, lines = pdf["key"].to_list(), pdf["line"].to_list()
    number = np.frombuffer(b"".join(keys), ">u8").astype(np.uint64)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    ties = _Ties(number)
    left: list[tuple[int, int]] = []
    for i, j in zip(cuts, cuts[1:]):
        seats = i + np.flatnonzero(home[i:j])
        # a single square has only those at home
        here = i + np.flatnonzero(~home[i:j]) if seats.size < j - i else seats
        if seats.size:
            pair = pdf["component"].iat[i] & 15
            for k in range(0, here.size, step := max(1, STEP // seats.size)):
                some = here[k : k + step]
                near = apart(fp[some, None], fp[None, seats]) <= LINK_BITS
                near &= number[some, None] < number[None, seats]
                v, m = np.nonzero(near)
                near[v, m] = first_pair(fp[some[v]] ^ fp[seats[m]], pair)
                left += _walked(some, seats, near, ties, size, lines)
                if len(left) > WAITING:
                    _measured(left, ties, size, lines)
                    left.clear()
    _measured(left, ties, size, lines)
    links = [(keys[v], keys[m]) for v, m in ties.links]
    return pd.DataFrame(links, columns=["a", "b"], dtype=object)


class _Ties:
    """Links found so far, and for each row which group of tied lines it is in."""

    def __init__(self, number: np.ndarray) -> None:
        # rows of one line are one from the start, whatever their squares
        _, self.root = np.unique(number, return_inverse=True)
        self.links: list[tuple[int, int]] = []

    def tie(self, v: int, m: int) -> None:
        self.links.append((v, m))
        self.root[self.root == self.root[v]] = self.root[m]

    def apart(self, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        return [(v, m) for v, m in pairs if self.root[v] != self.root[m]]


def _walked(some, seats, near, ties, size, lines) -> list[tuple[int, int]]:
    """Ties pairs of ``near`` that walks prove similar, as many as span them all; gives those left open."""
    left = []
    root = ties.root
    for v, row in zip(some[near.any(axis=1)].tolist(), near[near.any(axis=1)]):
        mates = seats[row]
        mates = mates[np.minimum(size[mates], size[v]) >= MIN_SIMILARITY * np.maximum(size[mates], size[v])]
        # only partners that are not in the same group yet are worth a look at their texts
        while (mates := mates[root[mates] != root[v]]).size:
            m, mates = int(mates[0]), mates[1:]
            if close(lines[v], lines[m]):
                ties.tie(v, m)
            else:
                left.append((v, m))
    return left


def _measured(left, ties, size, lines) -> None:
    """Ties those of the pairs that are similar: what walks leave open goes by blocks, of many pairs
    at a time, and, where they do not tell, by the distance."""
    at = 0
    while at < len(left):
        some, chars = [], 0
        while at < len(left) and chars < TOLD:
            some.append(left[at])
            chars += int(size[left[at][0]] + size[left[at][1]])
            at += 1
        some = ties.apart(some)
        long = [p for p in some if size[p[0]] >= BLOCKED]
        far = {p for p, no in zip(long, far_apart([(lines[v], lines[m]) for v, m in long])) if no}
        for v, m in some:
            if (v, m) not in far and ties.root[v] != ties.root[m]:
                if 1 - distance(lines[v], lines[m]) / max(size[v], size[m]) >= MIN_SIMILARITY:
                    ties.tie(v, m)


def line_groups(distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, component): the groups of linked lines, for the lines that have a link.

    ``distinct`` has a row (key, fp, size) for each line.
    """
    several = F.when(F.count(F.lit(1)) > 1, SHARED).otherwise(0)
    bounds = F.shiftleft(F.min("size").cast("long"), 31).bitwiseOR(F.max("size").cast("long"))
    fps = settle(distinct.groupBy("fp").agg(several.bitwiseOR(bounds).alias("sizes")), "fps")
    # fingerprints with a partner, or with several lines of their own, have texts to compare
    groups = settle(distinct.join(fingerprint_groups(fps), "fp").select("key", "fp", "component"), "groups")
    texts = settle(_texts_of(docs).join(groups.select("key").distinct(), "key").dropDuplicates(["key"]), "texts")
    cells = dealt(groups.withColumn("home", F.lit(True)), ["component"], "key", ["key", "fp"], call=VERIFIED)
    # a text goes along with its line only now, once for each square that the line is in
    cells = cells.join(texts, "key")
    return components(cells.groupBy("cell").applyInPandas(_verify, "a binary, b binary")).select(
        F.col("node").alias("key"), "component"
    )


def line_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, text, carry..., n_lines, n_removed, removed): one row per row of ``docs``.

    Lines end at line feeds and are compared normalised (see ``normalised``). Lines that are
    blank then are never removed. Of each connected group of lines the one with the lowest doc_id
    and line number stays, as it was written; ``removed`` lists the numbers (from 0) of the lines
    that go, ``text`` is the rest. A null text stays null with no lines; an empty text is one blank
    line. Rows that repeat both id and text count as one document, and each gets its result; of
    rows with equal id and unlike text the one with the lower text hash comes first. Null ids
    come first. Columns named in ``carry`` come along, but for names that the result has itself, which
    are an error; others stay out of it. An empty table gives no rows.
    """
    if clash := {c.lower() for c in carry} & {"doc_id", "text", "n_lines", "n_removed", "removed"}:
        raise ValueError(f"names of the result: {sorted(clash)}")
    own = pick(docs, doc_id=doc_id, text=text, **{f"_{c}": c for c in carry})
    small_batches(docs.sparkSession)
    own = own.withColumn("text_hash", F.xxhash64("text"))
    carried = [F.col(f"_{c}").alias(c) for c in carry]
    lines = settle(lines_of(own.select("doc_id", "text_hash", "text")), "lines")
    each = lines.groupBy("key").agg(F.first("fp").alias("fp"), F.first("size").alias("size"), F.count(F.lit(1)).alias("n"))
    distinct = settle(each, "distinct")
    groups = line_groups(distinct.select("key", "fp", "size"), own)
    component = F.coalesce("component", "key").alias("component")
    # a line that stands alone needs no look at where it stands
    several = distinct.join(groups, "key", "left").where("n > 1 OR component IS NOT NULL").select("key", "n", component)
    several = settle(several, "several")
    # lines that stand very often are no more than HEAVY_KEYS, and are sent to the others
    often = F.col("n") > F.lit(lines.count() // HEAVY_KEYS)
    heavy = F.broadcast(several.where(often).select("key", "component"))
    stands = lines.drop("fp", "size")
    seldom = stands.join(heavy.select("key"), "key", "left_anti").join(several.where(~often).drop("n"), "key")
    places = settle(
        stands.join(heavy, "key").unionByName(seldom)
        .select("component", "doc_id", "text_hash", "line_no"),
        "places",
    )
    # all lines of a group go but the first, and a place is of one group only
    stays = places.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash", "line_no")).alias("at"))
    marks = places.select("doc_id", "text_hash", "line_no", F.lit(None).cast("int").alias("stay")).unionByName(
        stays.select("at.doc_id", "at.text_hash", F.lit(None).cast("int").alias("line_no"), F.col("at.line_no").alias("stay"))
    )
    gone = (
        marks.groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.array_except(F.collect_set("line_no"), F.collect_set("stay"))).alias("removed"))
        .where(F.size("removed") > 0)
    )
    found = own.alias("d").join(
        gone.alias("g"),
        F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.text_hash") == F.col("g.text_hash")),
        "left",
    )
    none = F.array().cast("array<int>")
    # a column of its own that is read twice, so that a text is split once and not for each of its lines
    parts = F.when(F.col("removed").isNotNull(), F.split("text", "\n", -1))
    found = found.select("d.*", "g.removed").withColumn("parts", parts)
    numbers = F.sequence(F.lit(0), F.array_size("parts") - 1)
    kept = F.transform(F.array_except(numbers, "removed"), lambda i: F.get("parts", i))
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return found.select(
        "doc_id",
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        *carried,
        F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", none).alias("removed"),
    )

