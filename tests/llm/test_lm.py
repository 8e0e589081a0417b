"""The language model against a plain version of itself, word by word, and against differences."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskloom.llm import exchange, maxent
from riskloom.llm.exchange import packed

ALL = (1 << 64) - 1
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
START = 0x27D4EB2F
SHARD = 400
END = b""


def slow_scores(data, learn, rounds):
    """Scores of texts that make one batch, with weights in dictionaries and sums in loops."""
    texts = [(t or "").encode().lower().split() + [END] for _, t in data]
    flags = [learn(d) for d, _ in data]
    shards = max(1, -(-sum(len((t or "").encode()) for _, t in data) // SHARD))
    count = Counter(w for words, flag in zip(texts, flags) if flag for w in words)
    cls = {w: 32 if w == END else count[w].bit_length() for words in texts for w in words}
    trees = defaultdict(list)
    for w in sorted(w for w in count if w != END):
        trees[cls[w], xxhash.xxh64_intdigest(w) % shards].append(w)
    for words in trees.values():
        words.sort(key=lambda w: (count[w], w))
    mass = {k: [count[w] + 1 for w in words] for k, words in trees.items()}
    top = max((c for c, _ in trees), default=1)
    column = lambda w: top + 1 if w == END else min(cls[w], top)

    def walk(leaf, weights, salt):
        out, lo, hi = [], 0, len(weights)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            left, rest = sum(weights[lo:mid]), sum(weights[mid:hi])
            node = (((lo << 32) + hi + 1) * MIX[0] ^ salt * MIX[1]) & ALL
            node = ((node ^ node >> 29) * MIX[2] & ALL) >> 33
            right = leaf >= mid
            if left and rest:
                out.append((node, 1 if right else -1, math.log(rest / left)))
            lo, hi = (mid, hi) if right else (lo, mid)
        return out

    def way(w):
        c, shard = cls[w], xxhash.xxh64_intdigest(w) % shards
        if c in (0, 32):
            return []
        over = walk(shard, [sum(mass.get((c, s), [])) for s in range(shards)], c)
        return over + walk(trees[c, shard].index(w), mass[c, shard], (shard + 1) * 33 + c)

    ways = {w: way(w) for w in cls}
    tokens = []
    for words, flag in zip(texts, flags):
        for k, w in enumerate(words):
            last = xxhash.xxh32_intdigest(words[k - 1]) if k > 0 else START
            second = xxhash.xxh32_intdigest(words[k - 2]) if k > 1 else START
            before = last * MIX[0], (last * MIX[1] + (second + 1) * MIX[2]) * MIX[0], (second + 7) * MIX[1]
            tokens.append((w, [x & ALL for x in before], flag))
    shift = 64 - int(math.log2(maxent.INNER))
    table, inner, bias = defaultdict(lambda: np.zeros(top + 2)), defaultdict(float), np.zeros(top + 2)

    def features(before):
        return [(kind, x >> 52) for kind, x in enumerate(before)]

    def classes(before):
        x = bias + sum(table[f] for f in features(before))
        p = np.exp(x - x.max())
        return p / p.sum()

    def turns(w, before):
        for node, to, odd in ways[w]:
            seats = []
            for kind, x in enumerate(before):
                m = (x + kind & ALL) ^ (node * MIX[1] & ALL)
                seats.append(((m ^ m >> 31) * MIX[2] & ALL) >> shift)
            yield seats, to, 1 / (1 + math.exp(-to * (odd + sum(inner[s] for s in seats))))

    for nth in range(rounds):
        n = len(tokens)
        seen, thought = defaultdict(lambda: np.zeros(top + 2)), defaultdict(lambda: np.zeros(top + 2))
        slope, curve = defaultdict(float), defaultdict(float)
        for w, before, flag in tokens[n * nth // rounds : n * (nth + 1) // rounds]:
            if not flag:
                continue
            p, own = classes(before), np.zeros(top + 2)
            own[column(w)] = 1
            if column(w) == 1:
                own[:2] = 0.5
            for f in [*features(before), "bias"]:
                seen[f] += own
                thought[f] += p
            for seats, to, q in turns(w, before):
                for s in seats:
                    slope[s] += to * (1 - q)
                    curve[s] += q * (1 - q)
        for f in seen:
            step = (seen[f] - thought[f]) / ((seen[f] + thought[f]) / 2 + maxent.DAMPING)
            if f == "bias":
                bias = bias + step
            else:
                table[f] = table[f] + step / 4
        for s in slope:
            inner[s] += slope[s] / 3 / (curve[s] + maxent.DAMPING)
    at, out = 0, []
    for words in texts:
        score = 0.0
        for w, before, _ in tokens[at : at + len(words)]:
            score += math.log10(classes(before)[column(w)]) + sum(math.log10(q) for _, _, q in turns(w, before))
        out.append(score)
        at += len(words)
    return out


def test_lm_scores_by_a_plain_model(spark, monkeypatch):
    """Whole scores, with words of several classes and shards, unseen ones, null and empty texts."""
    monkeypatch.setattr(exchange, "SHARD_BYTES", SHARD)
    r = random.Random(16)
    names = ["".join(r.choice("ABab.é") for _ in range(r.randrange(1, 5))) for _ in range(80)]
    data = [(i, " ".join(names[min(r.randrange(80), r.randrange(80))] for _ in range(r.randrange(30)))) for i in range(60)]
    data += [(60, None), (61, ""), (62, "new words é a"), (63, "ab")]
    df = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    got = {x.doc_id: x.score for x in maxent.lm_scores(df, F.col("doc_id") % 4 != 1).collect()}
    want = slow_scores(data, lambda d: d % 4 != 1, maxent.ROUNDS)
    assert [got[d] for d, _ in data] == pytest.approx(want, rel=1e-4)


def test_lm_slopes_are_differences(monkeypatch):
    """Slope and curvature of a turn's weight, by moving it a little either way."""
    counts = {b"%d" % i: n for i, n in enumerate([1, 1, 3, 2, 2, 3, 3, 2, 3, 3, 5, 6, 7, 7])}
    leaf, values, often = maxent.ranked(counts)
    cls = maxent.classes_of(values.astype(int))
    masses = np.bincount(cls, often * (values + 1.0), maxent.CLASSES)[None]
    r = np.random.default_rng(17)
    sequence = np.r_[r.integers(0, 14, 40), 14, r.integers(0, 14, 30), 14].astype(np.uint32)
    small = {"a": sequence, "h": range(15), "l": [*leaf.values(), 0], "p": [0] * 15, "k": [0], "s": [values.size], "n": often}
    small["l"] = [leaf[w] for w in counts] + [0]
    row = {n: packed(np.array(x, np.uint32)) for n, x in small.items()}
    row |= {"c": packed(np.array([*counts.values(), 1], np.uint64)), "v": packed(values)}
    row |= {"flags": [True, False], "counts": [41, 31]}
    columns = np.arange(maxent.CLASSES)

    def made(inner):
        return maxent.Weights(None, None, columns, inner.astype(np.float32), masses)

    def loss(inner):
        return maxent.Batch(row, columns).within(made(inner))[:41].sum() * math.log(10)

    inner, h = r.normal(size=1 << 12) / 4, 0.25
    slope, curve = maxent._slopes([row], made(inner)).T
    assert np.allclose(sum(maxent._slopes([row], made(inner), (k, 3)) for k in range(3)).T, [slope, curve])
    # however few tokens, steps and words are taken at a time
    whole = maxent.Batch(row, columns).within(made(inner))
    with monkeypatch.context() as few:
        for name, value in (("STEP", 7), ("PARTS", 3), ("WORDS", 4)):
            few.setattr(maxent, name, value)
        assert np.allclose(maxent._slopes([row], made(inner)).T, [slope, curve])
        assert np.allclose(maxent.Batch(row, columns).within(made(inner)), whole)
    met = np.flatnonzero(curve)
    assert met.size > 100
    for s in [*r.choice(met, 25), *r.choice(np.flatnonzero(curve == 0), 3)]:
        up, down = inner.copy(), inner.copy()
        up[s] += h
        down[s] -= h
        up, down, here = loss(up), loss(down), loss(inner)
        assert (up - down) / (2 * h) == pytest.approx(slope[s], abs=0.02 + 0.01 * abs(slope[s]))
        assert (2 * here - up - down) / h**2 == pytest.approx(curve[s], abs=0.02 + 0.05 * curve[s])


def test_sums_over_columns_and_turns():
    """Softmax and slopes against plain sums, one token after another."""
    r = np.random.default_rng(9)
    w = maxent.Weights(r.normal(0, 3, (3, maxent.BUCKETS, 7)).astype(np.float32), r.normal(size=7).astype(np.float32), np.arange(7))
    some = r.integers(0, maxent.BUCKETS, (3, 50))
    raw = np.exp(sum(w.table[k][some[k]].astype(float) for k in range(3)) + w.bias)
    assert np.allclose(w.softmax(some), raw / raw.sum(axis=1, keepdims=True), atol=1e-5)
    assert np.allclose(w.share(some, some[0] % 7), (raw / raw.sum(axis=1, keepdims=True))[np.arange(50), some[0] % 7], atol=1e-5)
    # two tokens at one seat: slope way * (1 - p), curvature p * (1 - p)
    way, p = np.array([1, -1], np.float32), np.array([0.25, 0.5], np.float32)

    class Two:
        learn = None

        def turned(self, *_):
            yield np.arange(2), np.ones(2, int), [np.array([5, 5]), np.array([6, 7])], way, p

    before, maxent.Batch = maxent.Batch, lambda row, columns: Two()
    try:
        got = maxent._slopes([{}], w)
    finally:
        maxent.Batch = before
    assert got.shape == (maxent.INNER, 2) and np.allclose(got[5:8], [[0.25, 0.4375], [0.75, 0.1875], [-0.5, 0.25]])


def test_softmax_takes_products(monkeypatch):
    """However many tokens, no more exponentials than weights; weights too far apart for products too."""
    r = np.random.default_rng(23)
    some = r.integers(0, maxent.BUCKETS, (3, 60_000))
    taken, exp = [], np.exp
    for spread, most in ((1, maxent.KINDS * maxent.BUCKETS * 6), (40, some[0].size * 6)):
        table = r.normal(0, spread, (3, maxent.BUCKETS, 6)).astype(np.float32)
        w = maxent.Weights(table, r.normal(size=6).astype(np.float32), np.arange(6))
        raw = sum(w.table[k][some[k]].astype(float) for k in range(3)) + w.bias
        raw = exp(raw - raw.max(axis=1, keepdims=True))
        raw /= raw.sum(axis=1, keepdims=True)
        with monkeypatch.context() as counted:
            counted.setattr(np, "exp", lambda x, *a, **b: taken.append(x.size) or exp(x, *a, **b))
            p, share = w.softmax(some), w.share(some, some[0] % 6)
        assert np.allclose(p, raw, atol=1e-5) and np.allclose(share, raw[np.arange(60_000), some[0] % 6], atol=1e-5)
        assert sum(taken) == (most if spread == 1 else 2 * most)
        assert (w.factors is None) == (spread == 40)
        taken.clear()
