"""SimHash near-duplicates, meeting squares and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from riskloom.llm import components as rounds
from riskloom.llm import meeting, near_dedup
from riskloom.llm.components import components


def brute_components(nodes, links):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[max(top(a), top(b))] = min(top(a), top(b))
    return {n: top(n) for n in nodes}


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    r = random.Random(seed)
    n = 300
    links = [(r.randrange(n), r.randrange(n)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    links += [(500, i) for i in range(501, 560)] + [(7, 7)]
    got = components(spark.createDataFrame(links, "a long, b long"))
    want = brute_components({x for p in links for x in p}, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {(x.node, x.component) for x in got.collect()} == {(x, want[x]) for x in linked}


@pytest.mark.parametrize("most", [30, 500_000])
def test_components_of_bytes(spark, monkeypatch, most):
    """A long chain takes no rounds where a task can hold its links, and rounds where not."""
    monkeypatch.setattr(rounds, "LINKS", most)
    written, settle = [], rounds.settle
    monkeypatch.setattr(rounds, "settle", lambda df, tag: written.append(tag) or settle(df, tag))
    links = [(i, i + 1) for i in range(90)] + [(i, i - 1) for i in range(201, 300)] + [(7, 7)]
    named = [(bytes([a % 251, a // 251]), bytes([b % 251, b // 251])) for a, b in links]
    got = components(spark.createDataFrame(named, "a binary, b binary"))
    want = brute_components({x for p in named for x in p}, named)
    assert {(bytes(x.node), bytes(x.component)) for x in got.collect()} == set(want.items())
    assert (len(written) == 2) == (most > 30)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_anchors_are_complete():
    r = np.random.default_rng(3)
    x = r.integers(0, 1 << 31, 500, dtype=np.uint64)
    y = x ^ (np.uint64(1) << r.integers(0, 31, 500, dtype=np.uint64))
    for a, b in ((x, y), (y, x), (x, x)):
        home, _ = near_dedup.anchors(a)
        own, more = near_dedup.anchors(b)
        visits = [{int(h)} for h in own]
        for rows, at in more:
            for i, v in zip(rows, at):
                visits[i].add(int(v))
        assert all(int(h) in v for h, v in zip(home, visits))


def near_prints(seed):
    r = random.Random(seed)
    out = []
    for _ in range(40):
        base = r.getrandbits(64)
        out.append(base)
        for _ in range(r.randrange(6)):
            for k in r.sample(range(64), r.randrange(6)):
                base ^= 1 << k
            out.append(base)
    return sorted(set(out))


@pytest.mark.parametrize("square", [3, 20_000])
def test_links_span_all_links(spark, monkeypatch, square):
    monkeypatch.setattr(meeting, "SQUARE", square)
    fps = near_prints(5)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = near_dedup.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    want = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    assert all(((x.a ^ x.b) & (2**64 - 1)).bit_count() <= 3 for x in links)
    assert brute_components(signed, [(x.a, x.b) for x in links]) == brute_components(signed, want)


TEXTS = [
    "one two three four five six seven eight nine ten " * 8,
    "ONE two three four five six seven eight nine ten " * 8,
    "one two three four five six seven eight nine ten " * 8 + "eleven",
    "something else altogether é \x1c here\n" * 30,
    "",
    None,
    "   \t",
    "word",
    "two words",
    "x " * 30_000,
]


def test_near_duplicates(rows):
    data = [(i * 3 + 2, t, "clash") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], "c"), (2, TEXTS[0], "c")]
    got = near_dedup.near_duplicates(rows(data, "doc_id long, text string, component_id string")).collect()
    prints = [brute_print(t) for _, t, _ in data]
    n = range(len(data))
    groups = brute_components(n, [(i, j) for i in n for j in n if (prints[i] ^ prints[j]).bit_count() <= 3])
    low = {}
    for i in n:
        ids = [data[j][0] for j in n if groups[j] == groups[i] and data[j][0] is not None]
        low[i] = min(ids, default=None)
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted(((data[i][0], f"{prints[i]:016x}", low[i]) for i in n), key=key)


def test_empty_table(rows):
    empty = rows([], "doc_id long, text string")
    assert near_dedup.near_duplicates(empty).count() == 0
    assert near_dedup.drop_copies(empty).count() == 0


def test_drop_copies_keeps_one(rows):
    data = [(5, TEXTS[0], 1), (3, TEXTS[1], 2), (3, TEXTS[1], 3), (None, TEXTS[2], 4), (9, TEXTS[3], 5), (None, "lonely one", 6)]
    kept = near_dedup.drop_copies(rows(data, "doc_id long, text string, other int")).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["3", "9", "None"]
    assert [r.other for r in kept if r.doc_id is None] == [6]


def test_drop_copies_keeps_columns_of_any_name(rows):
    data = [(1, TEXTS[0], 7, "a", 0), (2, TEXTS[0], 8, "b", 1), (3, "lonely one", 9, None, 2)]
    df = rows(data, "doc_id long, text string, _row int, component string, fp int")
    kept = near_dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect())) == [data[0], data[2]]
