"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

P(word | before) = P(class | before) * P(word | class). A word's class is the number of bits of its
count in the training texts; class 0 is the one unseen word, and the end of a text has a class of
its own. The class comes from a softmax over hashed features of what stands before: the last word,
the last two, and the last but one (a skip). Within a class, words are the leaves of a binary tree:
first a half of the shards, then a half of a shard's words, down to the one word. Each turn has a
probability of its own, from the counts below both branches and from weights of the same features,
hashed together with the node; so P(word | class, before) sums to one over the words of a class.

The weights are trained by distributed gradient updates, each over its stretch of every batch, so
that each text is learned from once: every task sums the observed and the expected features of its
texts, chunks of these sums are added up in two steps, and each weight is moved by its scaled
gradient. Training and scoring work on steps of tokens with numpy, touching only features that
occur; the ways to words are found for the words of some steps at a time.

Words are counted over all training texts by one global exchange (see ``exchange``). Tables sent to
all tasks have at most BUCKETS * CLASSES weights per kind of feature, INNER weights for the turns,
whatever the data, and a row per shard.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import settle
from riskloom.llm.exchange import Exchange, packed, unpack_places, unpack_words, unpacked
from riskloom.llm.simhash import FOLD

#: No word is empty, so this can stand for the end of a text.
END = b""
#: Bits of counts that are told apart, and one class more for the end.
END_CLASS = 32
CLASSES = 33
BUCKETS = 1 << 12
#: Kinds of features: last word, last two words, last but one.
KINDS = 3
#: Updates, and so stretches of a batch.
ROUNDS = 4
RATE = 1.0
#: Weight of no change, in occurrences of a feature.
DAMPING = 2.0
#: Weights of the turns within classes.
INNER = 1 << 20
#: Tokens worked on at a time: few enough that what they need stays in a core's cache.
STEP = 1 << 13
#: Such steps whose first, second and further turns are taken together.
STEPS = 4
#: Such parts for which the ways to their words are found at once, and words of these at a time.
PARTS, WORDS = 32, 1 << 13
#: Rows of weights that are added up together.
CHUNK = 1 << 9
#: Weights of turns that are added up together.
INNER_CHUNK = 1 << 14
#: Tasks whose sums are added up first.
FAN = 32

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_START = np.uint64(0x27D4EB2F)


def tokens(text: bytes) -> list[bytes]:
    """Runs without white space (space, \\t to \\r), A-Z lower-cased, and the end."""
    return [*text.translate(FOLD).split(), END]


def classes_of(counts: np.ndarray) -> np.ndarray:
    """Number of bits of each count, up to END_CLASS - 1."""
    bits = np.zeros(counts.shape, np.int64)
    nonzero = counts > 0
    bits[nonzero] = np.floor(np.log2(counts[nonzero].astype(np.float64))).astype(np.int64) + 1
    return np.minimum(bits, END_CLASS - 1)


@dataclass
class Totals:
    """Of the training texts: tokens, distinct tokens, and each class's sum of count + 1."""

    tokens: int
    distinct: int
    mass: np.ndarray

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the add-one estimate."""
        return np.log10(counts + 1.0) - math.log10(self.tokens + self.distinct + 1)

    def within(self, counts: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its class."""
        alone = (cls == 0) | (cls == END_CLASS)
        return np.where(alone, 0.0, np.log10(counts + 1.0) - np.log10(np.where(alone, 1.0, self.mass[cls])))


@dataclass
class Paths:
    """Ways from the top of a tree to some leaves, one after another, as many turns as ``sizes`` says.

    A turn has the hash of its node in the upper 31 bits, then one whether it goes right; the lower
    half is, as a float, the log of the mass on the way taken over that of the other.
    """

    sizes: np.ndarray
    turns: np.ndarray

    @staticmethod
    def of(leaf: np.ndarray, begin: np.ndarray, end: np.ndarray, salt: np.ndarray, below) -> "Paths":
        """To leaves of trees over ``begin`` to ``end``, of which both halves of any part are a branch.

        ``below`` gives the mass before places, for the leaves of these numbers. A branch without
        mass is no turn.
        """
        owner, turns = [], []
        at = np.flatnonzero(end - begin > 1)
        first, lo, hi = begin[at], begin[at], end[at]
        under, upto = below(lo, at), below(hi, at)
        goal, start = leaf[at], salt[at].astype(np.uint64) * _MIX[1]
        while at.size:
            mid = (lo + hi) // 2
            right, middle = goal >= mid, below(mid, at)
            left, rest = middle - under, upto - middle
            node = ((lo - first).astype(np.uint64) << np.uint64(32)) + (hi - first).astype(np.uint64)
            node = (node + np.uint64(1)) * _MIX[0] ^ start
            node = (node ^ node >> np.uint64(29)) * _MIX[2] >> np.uint64(33)
            node <<= np.uint64(33)
            node |= right.astype(np.uint64) << np.uint64(32)
            two = (left > 0) & (rest > 0)
            if two.all():
                two = slice(None)
            odds = np.log((rest[two] / left[two]).astype(np.float32))
            np.negative(odds, out=odds, where=~right[two])
            owner.append(at[two])
            turns.append(node[two] | odds.view(np.uint32))
            lo, hi = np.where(right, mid, lo), np.where(right, hi, mid)
            under, upto = np.where(right, middle, under), np.where(right, upto, middle)
            if (more := hi - lo > 1).all():
                continue
            at, first, lo, hi, under, upto, goal, start = (
                x[more] for x in (at, first, lo, hi, under, upto, goal, start)
            )
        if not owner:
            return Paths(np.zeros(leaf.size, np.int64), np.empty(0, np.uint64))
        # numbers of 16 bits are sorted by counting
        who = np.concatenate(owner).astype(np.uint16 if leaf.size <= 1 << 16 else np.int64)
        order = np.argsort(who, kind="stable")
        return Paths(np.bincount(who, minlength=leaf.size), np.concatenate(turns)[order])

    @cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def seats(self, which: np.ndarray) -> np.ndarray:
        """Where the turns of these paths stand."""
        starts, sizes = self.starts[which], self.sizes[which]
        return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())

    def take(self, which: np.ndarray) -> "Paths":
        return Paths(self.sizes[which], self.turns[self.seats(which)])

    def after(self, top: "Paths") -> "Paths":
        """Each of these paths behind the one of ``top``."""
        n = self.sizes.size
        both = Paths.joined([top, self])
        return Paths(top.sizes + self.sizes, both.turns[both.seats(np.arange(2 * n).reshape(2, n).T.ravel())])

    @staticmethod
    def joined(some: list["Paths"]) -> "Paths":
        return Paths(np.concatenate([x.sizes for x in some]), np.concatenate([x.turns for x in some]))


def ranked(total: dict[bytes, int]) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """Leaves of the seen words of a shard, in order of their counts and so class by class; and the
    counts that occur with the number of words that have them."""
    seen = sorted((n, w) for w, n in total.items() if n and w != END)
    values, often = np.unique(np.array([n for n, _ in seen], np.uint64), return_counts=True)
    return {w: k for k, (_, w) in enumerate(seen)}, values, often.astype(np.uint32)


class Forest:
    """The trees of the shards that answered a batch, below those of the classes over all shards.

    ``shards`` and ``sizes`` are the shard and the number of runs of each reply, ``values`` and
    ``often`` the counts and numbers of words of the runs; ``masses`` has a row for each shard.
    """

    def __init__(self, shards: np.ndarray, sizes: np.ndarray, values: np.ndarray, often: np.ndarray, masses: np.ndarray):
        self.shards, self.height = shards, len(masses)
        tree = np.repeat(np.arange(shards.size), sizes) * CLASSES + classes_of(values.astype(np.int64))
        stop = np.cumsum(often.astype(np.int64))
        self.place, self.mass = np.r_[0, stop], np.r_[0.0, np.cumsum(often * (values + 1.0))]
        # the runs of a tree stand together, and so do those of a reply
        first = np.flatnonzero(np.diff(tree, prepend=-1))
        self.begin = np.zeros(shards.size * CLASSES, np.int64)
        self.end = self.begin.copy()
        self.begin[tree[first]], self.end[tree[first]] = self.place[first], self.place[np.r_[first[1:], tree.size]]
        self.before = self.place[np.cumsum(sizes) - sizes]
        self.below = np.concatenate([np.zeros((1, CLASSES)), np.cumsum(masses, axis=0)])

    def paths(self, cls: np.ndarray, reply: np.ndarray, leaf: np.ndarray) -> Paths:
        """From the top of their classes to words that are the given leaves of the shard of a reply."""
        which = reply * CLASSES + cls
        salt = (self.shards[reply].astype(np.int64) + 1) * CLASSES + cls
        own = Paths.of(
            self.before[reply] + leaf,
            self.begin[which],
            self.end[which],
            salt,
            lambda x, at: np.interp(x, self.place, self.mass),
        )
        # from the top of a class to the shard, once for all words of both
        met, back = np.unique(which, return_inverse=True)
        shard, c = self.shards[met // CLASSES].astype(np.int64), met % CLASSES
        tops = Paths.of(
            shard, np.zeros_like(shard), np.full_like(shard, self.height), c, lambda x, at: self.below[x, c[at]]
        )
        return own.after(tops.take(back))


def _counted(made: Exchange) -> DataFrame:
    """(batch, places, counts, hashes, leaves, values, often, shard, tokens, distinct, mass): replies to
    batches, and one row per shard, with batch -1, that has the totals."""

    def count_shard(rows: pa.Table) -> pa.Table:
        # distinct words of the shard, numbered as they come
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        parts, shard = [], rows["shard"][0].as_py()
        for r in range(rows.num_rows):
            words = unpack_words(rows["b"][r].as_py(), rows["c"][r].as_py())
            at = np.fromiter(map(number.__getitem__, words), np.uint32, len(words))
            parts.append((r, at))
        seen = np.zeros(len(number), np.uint64)
        for r, at in parts:
            # a batch has a word once
            seen[at] += unpacked(rows["d"][r].as_py(), "<u4")
        total = dict(zip(number, seen.tolist()))
        (leaf, *runs), out = ranked(total), []
        runs = [packed(x) for x in runs]
        hashes = np.fromiter(map(xxhash.xxh32_intdigest, number), np.uint32, len(number))
        leaves = np.fromiter((leaf.get(w, 0) for w in number), np.uint32, len(number))
        for r, at in parts:
            replies = [packed(x[at]) for x in (seen, hashes, leaves)]
            out.append((rows["batch"][r].as_py(), rows["a"][r].as_py(), *replies, *runs, shard, None, None, None))
        counts = np.array([n for w, n in total.items() if w != END and n], np.int64)
        mass = np.bincount(classes_of(counts), counts + 1.0, CLASSES)
        tokens = counts.sum() + total.get(END, 0)
        distinct = counts.size + (total.get(END, 0) > 0)
        out.append((-1, *[None] * 6, shard, int(tokens), int(distinct), mass.tolist()))
        kinds = [pa.int64(), *[pa.binary()] * 6, pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float64())]
        names = ["batch", "places", "counts", "hashes", "leaves", "values", "often", "shard", "tokens", "distinct", "mass"]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    schema = (
        "batch long, places binary, counts binary, hashes binary, leaves binary, values binary, often binary, "
        "shard int, tokens long, distinct long, mass array<double>"
    )
    return settle(made.tokens.groupBy("shard").applyInArrow(count_shard, schema), "counts")


def _totals(counted: DataFrame) -> Totals:
    stats = counted.where("batch = -1")
    sums = stats.agg(F.sum("tokens"), F.sum("distinct")).first()
    mass = np.zeros(CLASSES)
    for r in stats.select(F.posexplode("mass")).groupBy("pos").agg(F.sum("col").alias("m")).collect():
        mass[r.pos] = r.m
    return Totals(sums[0] or 0, sums[1] or 0, mass)


def _masses(counted: DataFrame) -> np.ndarray:
    """Each class's sum of count + 1, a row for each shard."""
    found = counted.where("batch = -1").select("shard", "mass").collect()
    out = np.zeros((max((r.shard for r in found), default=0) + 1, CLASSES))
    for r in found:
        out[r.shard] = r.mass
    return out


#: What a reply has for its places, and its shard's runs.
COLUMNS = (
    ("places", unpack_places),
    ("counts", lambda x: unpacked(x, "<u8")),
    ("hashes", lambda x: unpacked(x, "<u4")),
    ("leaves", lambda x: unpacked(x, "<u4")),
    ("values", lambda x: unpacked(x, "<u8")),
    ("often", lambda x: unpacked(x, "<u4")),
)


def _corpus(made: Exchange, counted: DataFrame) -> DataFrame:
    """A row per batch: its documents, with count, hash, reply and leaf for each place, and the runs
    of counts of the replies."""
    kind = made.id_type

    def assemble(key: tuple, documents: pa.Table, answers: pa.Table) -> pa.Table:
        parts = [
            tuple(f(answers[k][r].as_py()) for k, f in COLUMNS) for r in range(answers.num_rows)
        ]
        n = sum(len(p[0]) for p in parts)
        counts, hashes = np.zeros(n, np.uint64), np.zeros(n, np.uint32)
        leaves, reply = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        for k, (place, c, h, leaf, _, _) in enumerate(parts):
            counts[place], hashes[place], leaves[place], reply[place] = c, h, leaf, k
        shards = np.array(answers["shard"].to_pylist(), np.uint32)
        sizes = np.array([len(p[4]) for p in parts], np.uint32)
        values = np.concatenate([np.empty(0, np.uint64), *(p[4] for p in parts)])
        often = np.concatenate([np.empty(0, np.uint32), *(p[5] for p in parts)])
        rows = documents.num_rows
        out = documents.select(["ids", "flags", "counts", "a"])
        more = {"c": counts, "h": hashes, "l": leaves, "p": reply, "k": shards, "s": sizes, "v": values, "n": often}
        for name, column in more.items():
            out = out.append_column(name, pa.array([packed(column)] * rows, pa.binary()))
        return out

    documents = made.documents.select("batch", "ids", "flags", "counts", "a")
    replies = counted.where("batch >= 0").drop("tokens", "distinct", "mass")
    return settle(
        documents.groupBy("batch")
        .cogroup(replies.groupBy("batch"))
        .applyInArrow(
            assemble,
            f"ids array<{kind}>, flags array<boolean>, counts array<int>, a binary, c binary, h binary, "
            "l binary, p binary, k binary, s binary, v binary, n binary",
        ),
        "corpus",
    )


#: Columns of the corpus that a batch is made of.
READ = ("flags", "counts", "a", "c", "h", "l", "p", "k", "s", "v", "n")


class Batch:
    """The tokens of one batch of texts, with their features and the columns of their classes."""

    def __init__(self, row: dict, columns: np.ndarray):
        self.flags = np.array(row["flags"], bool)
        self.sizes = np.array(row["counts"], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.sequence = unpacked(row["a"], "<u4")
        self.counts = unpacked(row["c"], "<u8").astype(np.int64)
        # every text closes with the end, so its place is that of any last token
        self.cls = classes_of(self.counts)
        if self.sequence.size:
            self.cls[self.sequence[self.starts + self.sizes - 1]] = END_CLASS
        self.column = columns[self.cls]
        self.hashes = unpacked(row["h"], "<u4").astype(np.uint64)
        self.learn = np.repeat(self.flags, self.sizes)
        # whether a token is the first or second of its text, or a later one
        self.nth = np.full(self.sequence.size, 2, np.uint8)
        self.nth[self.starts[self.sizes > 1] + 1] = 1
        self.nth[self.starts] = 0
        self.row = row

    @cached_property
    def leaf(self) -> np.ndarray:
        return unpacked(self.row["l"], "<u4")

    @cached_property
    def reply(self) -> np.ndarray:
        return unpacked(self.row["p"], "<u4")

    def parts(self, turn: tuple[int, int] = (0, 1), steps: int = 1) -> Iterator[tuple[int, int]]:
        """Begin and end of at most so many STEPs of tokens each, for the given one of so many stretches."""
        nth, of = turn
        n = self.sequence.size
        lo, hi = n * nth // of, n * (nth + 1) // of
        for k in range(lo, hi, steps * STEP):
            yield k, min(k + steps * STEP, hi)

    def contexts(self, lo: int, hi: int) -> np.ndarray:
        """Hashes of the features, KINDS by tokens from ``lo`` to ``hi``."""
        at, nth = np.arange(lo, hi), self.nth[lo:hi]
        last, second = (self.hashes[np.take(self.sequence, at - k, mode="wrap")] for k in (1, 2))
        last, second = np.where(nth > 0, last, _START), np.where(nth > 1, second, _START)
        return np.stack(
            [
                last * _MIX[0],
                (last * _MIX[1] + (second + np.uint64(1)) * _MIX[2]) * _MIX[0],
                (second + np.uint64(7)) * _MIX[1],
            ]
        )

    def features(self, lo: int, hi: int) -> np.ndarray:
        """Buckets, KINDS by tokens from ``lo`` to ``hi``."""
        return (self.contexts(lo, hi) >> np.uint64(64 - int(math.log2(BUCKETS)))).astype(np.uint16)

    def learned(self, turn: tuple[int, int] = (0, 1)) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Features and columns of the tokens of flagged texts, in parts."""
        for lo, hi in self.parts(turn):
            learn = self.learn[lo:hi]
            yield self.features(lo, hi)[:, learn], self.column[self.sequence[lo:hi]][learn]

    def paths(self, forest: Forest, places: np.ndarray) -> Paths:
        """For these places; unseen words and the end are alone in their class, and have no way to go."""
        cls, found = self.cls[places], []
        for k in range(0, max(1, places.size), WORDS):
            some = np.flatnonzero((cls[k : k + WORDS] != END_CLASS) & (cls[k : k + WORDS] != 0)) + k
            at = places[some]
            ways = forest.paths(cls[some], self.reply[at].astype(np.int64), self.leaf[at].astype(np.int64))
            sizes = np.zeros(min(WORDS, places.size - k), np.int64)
            sizes[some - k] = ways.sizes
            found.append(Paths(sizes, ways.turns))
        return Paths.joined(found)

    def turned(self, weights: Weights, some: np.ndarray, turn: tuple[int, int] = (0, 1)) -> Iterator[tuple]:
        """Of parts of the tokens that ``some`` marks, all first turns, then all second ones and so on:
        the numbers of the tokens that have one, which one it is, the seats of the turns' weights by
        kind, their direction and their probability."""
        shards, sizes, often = (unpacked(self.row[n], "<u4").astype(np.int64) for n in "ksn")
        forest = Forest(shards, sizes, unpacked(self.row["v"], "<u8"), often, weights.masses)
        inner = weights.inner
        shift = np.uint64(64 - int(math.log2(inner.size)))
        kinds = np.arange(KINDS, dtype=np.uint64)[:, None]
        parts = list(self.parts(turn, STEPS))
        for k in range(0, len(parts), PARTS):
            # the ways to the words of some parts at a time
            here = slice(parts[k][0], parts[min(k + PARTS, len(parts)) - 1][1])
            met = np.zeros(self.cls.size, bool)
            met[self.sequence[here][some[here]]] = True
            places = np.flatnonzero(met)
            # words of a tree one after another
            places = places[np.lexsort((self.leaf[places], self.reply[places]))]
            paths = self.paths(forest, places)
            seat = np.empty(self.cls.size, np.int64)
            seat[places] = np.arange(places.size)
            for lo, hi in parts[k : k + PARTS]:
                which = np.flatnonzero(some[lo:hi])
                own = seat[self.sequence[lo:hi][which]]
                # longest ways first, so that the tokens with an nth turn stand together
                sizes = paths.sizes[own].astype(np.uint16)
                order = np.argsort(~sizes, kind="stable")
                which, at = which[order], paths.starts[own[order]]
                # shifts work on context and node apart, as the two are mixed by xor
                contexts = self.contexts(lo, hi)[:, which] + kinds
                contexts ^= contexts >> np.uint64(31)
                which += lo
                for nth, n in enumerate((which.size - np.cumsum(np.bincount(sizes)))[:-1].tolist()):
                    turns = np.take(paths.turns, at[:n] + nth)
                    halves = turns.view(np.uint32)
                    odds = halves[::2].copy().view(np.float32)
                    way = (halves[1::2] & np.uint32(1)).astype(np.float32)
                    way += way
                    way -= np.float32(1)
                    turns >>= np.uint64(33)
                    turns *= _MIX[1]
                    turns ^= turns >> np.uint64(31)
                    seats, x = [], np.zeros(n, np.float32)
                    for context in contexts:
                        mixed = context[:n] ^ turns
                        mixed *= _MIX[2]
                        mixed >>= shift
                        seats.append(mixed.view(np.int64))
                        x += np.take(inner, seats[-1])
                    x *= way
                    x += odds
                    np.clip(x, -60, 60, out=x)
                    p = np.exp(np.negative(x, out=x), out=x)
                    p += np.float32(1)
                    yield which[:n], nth, seats, way, np.divide(np.float32(1), p, out=p)

    def within(self, weights: Weights) -> np.ndarray:
        """log10 of P(word | class, before) of each token."""
        out = np.zeros(self.sequence.size)
        for at, _, _, _, p in self.turned(weights, np.ones(out.size, bool)):
            out[at] += np.log(p)
        out /= math.log(10)
        return out


def columns_of(mass: np.ndarray) -> np.ndarray:
    """Column of each class in the weights: classes up to the highest that occurs, then the end."""
    top = int(np.flatnonzero(mass[:END_CLASS]).max(initial=1))
    columns = np.minimum(np.arange(CLASSES), top)
    columns[END_CLASS] = top + 1
    return columns


@dataclass
class Weights:
    """By kind of feature, bucket and column; one of each column for all; and those of the turns.

    ``masses`` has the mass of each class in each shard, from which the odds of turns come.
    """

    table: np.ndarray
    bias: np.ndarray
    columns: np.ndarray
    inner: np.ndarray = field(default_factory=lambda: np.zeros(INNER, np.float32))
    masses: np.ndarray = field(default_factory=lambda: np.zeros((1, CLASSES)))

    def softmax(self, features: np.ndarray) -> np.ndarray:
        """Probability of each column, for tokens that have one bucket of each kind."""
        p = self._raised(features)
        p /= np.einsum("ij->i", p)[:, None]
        return p

    def share(self, features: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Probability of one column for each token."""
        p = self._raised(features)
        return p[np.arange(column.size), column] / np.einsum("ij->i", p)

    @cached_property
    def factors(self) -> np.ndarray | None:
        """e to the weights of each bucket less their greatest, so that tokens need products only; the
        bias is in the first kind. None where a product might be too small for a float."""
        table = self.table.copy()
        table[0] += self.bias
        table -= table.max(axis=2, keepdims=True)
        return np.exp(table, out=table) if table.min(axis=(1, 2)).sum() > -80 else None

    def _raised(self, features: np.ndarray) -> np.ndarray:
        if self.factors is not None:
            p = np.take(self.factors[0], features[0], axis=0)
            for k in range(1, KINDS):
                p *= np.take(self.factors[k], features[k], axis=0)
            return p
        p = np.take(self.table[0], features[0], axis=0)
        for k in range(1, KINDS):
            p += np.take(self.table[k], features[k], axis=0)
        p += self.bias
        p -= p.max(axis=1, keepdims=True)
        return np.exp(p, out=p)

    def moved(self, observed: np.ndarray, expected: np.ndarray, slope: np.ndarray, curve: np.ndarray) -> "Weights":
        """After one update by these sums."""
        step = RATE / (KINDS + 1) * (observed - expected) / ((observed + expected) / 2 + DAMPING)
        return replace(
            self,
            table=self.table + step[:-1].reshape(self.table.shape).astype(np.float32),
            bias=self.bias + (step[-1] * (KINDS + 1)).astype(np.float32),
            inner=self.inner + (RATE / KINDS * slope / (curve + DAMPING)).astype(np.float32),
        )


def _batches(rows: Iterable[dict | Batch], columns: np.ndarray) -> Iterator[Batch]:
    return (row if isinstance(row, Batch) else Batch(row, columns) for row in rows)


def _observed(rows: Iterable[dict | Batch], columns: np.ndarray, turn: tuple[int, int] = (0, 1)) -> np.ndarray:
    """How often each feature stands before each column; the last row, the bias, counts all.

    A word seen once counts half as the unseen word, which it was before it came.
    """
    width = int(columns.max()) + 1
    out = np.zeros((KINDS * BUCKETS + 1) * width)
    for batch in _batches(rows, columns):
        found = list(batch.learned(turn))
        if not found:
            continue
        features, column = (np.concatenate(x, axis=-1) for x in zip(*found))
        for kind in range(KINDS):
            at = (kind * BUCKETS + features[kind].astype(np.int64)) * width + column
            out += np.bincount(at, minlength=out.size)
        out[-width:] += np.bincount(column, minlength=width)
    out = out.reshape(-1, width)
    once = out[:, 1] / 2
    out[:, 0], out[:, 1] = once, once
    return out


def _expected(rows: Iterable[dict | Batch], weights: Weights, turn: tuple[int, int] = (0, 1)) -> np.ndarray:
    """The same, as the weights would have it."""
    width = weights.bias.size
    # two columns in one pass: one as the real part, the next as the other
    out = np.zeros(((width + 1) // 2, KINDS * BUCKETS + 1), np.complex128)
    for batch in _batches(rows, weights.columns):
        for some, column in batch.learned(turn):
            some = some.astype(np.int64)
            shares = np.zeros((column.size, 2 * len(out)))
            shares[:, :width] = weights.softmax(some)
            for total, share in zip(out, np.ascontiguousarray(shares.view(np.complex128).T)):
                for kind in range(KINDS):
                    np.add.at(total[kind * BUCKETS :][:BUCKETS], some[kind], share)
                total[-1] += share.sum()
    return np.ascontiguousarray(out.T).view(np.float64)[:, :width]


def _slopes(rows: Iterable[dict], weights: Weights, turn: tuple[int, int] = (0, 1)) -> np.ndarray:
    """Of each weight of the turns, the slope of the log probability and its curvature."""
    out = np.zeros(weights.inner.size, np.complex128)
    for row in rows:
        batch = Batch(row, weights.columns)
        for _, _, seats, way, p in batch.turned(weights, batch.learn, turn):
            # both sums in one pass: the slope as the real part, the curvature as the other
            both = np.empty(p.size, np.complex128)
            both.real, both.imag = way * (1 - p), p * (1 - p)
            for s in seats:
                np.add.at(out, s, both)
    return out.view(np.float64).reshape(-1, 2)


def _short(sums: np.ndarray) -> bytes:
    """Sums in 15 bits behind the point, compressed: most are zero after few texts."""
    bits = np.ascontiguousarray(sums).view(np.uint32)
    return packed(((bits + np.uint32(0x80)) & np.uint32(0xFFFFFF00)).ravel())


def _summed(
    texts: DataFrame, sums_of, width: int, height: int = KINDS * BUCKETS + 1, chunk: int = CHUNK
) -> np.ndarray:
    """What ``sums_of`` makes of each task's rows, added up by chunks of weights: first those of
    FAN tasks each, then all."""
    schema = "chunk int, part int, sums binary"

    def parts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() // FAN
        sums = sums_of(row for b in it for row in b.to_pylist()).astype(np.float32)
        for k in range(0, len(sums), chunk):
            if sums[k : k + chunk].any():
                yield pa.RecordBatch.from_pylist(
                    [{"chunk": k, "part": part, "sums": _short(sums[k : k + chunk])}],
                    pa.schema([("chunk", pa.int32()), ("part", pa.int32()), ("sums", pa.binary())]),
                )

    def add(rows: pa.Table) -> pa.Table:
        total = 0
        for x in rows["sums"]:
            total = total + unpacked(x.as_py(), "<f4").astype(np.float64)
        sums = pa.array([_short(total.astype(np.float32))], pa.binary())
        return rows.slice(0, 1).select(["chunk", "part"]).append_column("sums", sums)

    found = texts.mapInArrow(parts, schema)
    for keys in (("chunk", "part"), ("chunk",)):
        found = found.groupBy(*keys).applyInArrow(add, schema)
    out = np.zeros((height, width))
    for r in found.collect():
        part = unpacked(r.sums, "<f4").reshape(-1, width)
        out[r.chunk : r.chunk + len(part)] = part
    return out


def train(corpus: DataFrame, masses: np.ndarray, rounds: int = ROUNDS) -> Weights:
    """Weights after so many gradient updates, each over its stretch of every batch of documents."""
    columns = columns_of(masses.sum(axis=0))
    width = int(columns.max()) + 1
    weights = Weights(
        np.zeros((KINDS, BUCKETS, width), np.float32), np.zeros(width, np.float32), columns, masses=masses
    )
    sc = corpus.sparkSession.sparkContext
    texts = corpus.select("flags", "counts", "a", "c", "h")
    ways = corpus.select(*READ)
    for nth in range(rounds):
        shared, turn = sc.broadcast(weights), (nth, rounds)

        def both(rows: Iterator[dict], shared=shared, turn=turn) -> np.ndarray:
            out = np.zeros((KINDS * BUCKETS + 1, 2 * width))
            for batch in _batches(rows, columns):
                out[:, :width] += _observed([batch], columns, turn)
                out[:, width:] += _expected([batch], shared.value, turn)
            return out

        def slopes(rows: Iterator[dict], shared=shared, turn=turn) -> np.ndarray:
            return _slopes(rows, shared.value, turn)

        observed, expected = np.split(_summed(texts, both, 2 * width), 2, axis=1)
        slope, curve = _summed(ways, slopes, 2, weights.inner.size, INNER_CHUNK).T
        weights = weights.moved(observed, expected, slope, curve)
        shared.unpersist()
    return weights


def lm_scores(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score): one row per row of ``docs``.

    ``training`` is a condition on the column doc_id for documents to learn from. Null and empty texts
    have one token, the end. Without training texts every token is the one unseen word: the base
    score is 0 and classes are equally likely. Null ids and repeated rows each count and get their
    row; an empty table gives none.
    """
    made = Exchange(docs, doc_id, text, lambda: tokens, training)
    counted = _counted(made)
    totals = _totals(counted)
    corpus = _corpus(made, counted)
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((train(corpus, _masses(counted)), totals))
    kind = made.id_type

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, totals = shared.value
        for b in it:
            for r in range(b.num_rows):
                row = {n: b.column(n)[r].as_py() for n in READ}
                batch = Batch(row, weights.columns)
                sequence = batch.sequence
                sums = [
                    np.add.reduceat((batch.counts > 0)[sequence], batch.starts, dtype=np.int64),
                    np.add.reduceat(totals.base(batch.counts)[sequence], batch.starts),
                ]
                model = batch.within(weights)
                for lo, hi in batch.parts():
                    share = weights.share(batch.features(lo, hi), batch.column[sequence[lo:hi]])
                    # far below what training can reach, so that no text is impossible
                    model[lo:hi] += np.log10(np.maximum(share.astype(np.float64), 1e-30))
                sums.append(np.add.reduceat(model, batch.starts))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("ids")[r].values,
                        pa.array(batch.sizes),
                        pa.array(sums[0]),
                        pa.array(np.full(batch.sizes.size, totals.tokens, np.int64)),
                        pa.array(sums[1]),
                        pa.array(sums[2]),
                    ],
                    names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return corpus.mapInArrow(
        score, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
