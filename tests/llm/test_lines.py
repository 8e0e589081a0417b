"""Line dedup against a brute-force version."""

import random

import numpy as np
import pandas as pd
import pytest

from riskloom.llm import line_dedup, meeting
from riskloom.llm.line_dedup import GRAM, LinePrints, distance, normalised, similar


def slow_print(table, line):
    bits = table.view(np.uint8).reshape(-1, 64)
    votes, text = np.zeros(64, int), line + "\n" * (GRAM - 1)
    for i in range(len(line)):
        h = 0
        for c in text[i : i + GRAM]:
            h = (h * 0x9E3779B1 + ord(c)) & 0xFFFFFFFF
        votes += bits[(h * 0x9E3779B1 & 0xFFFFFFFF) >> 16]
    return sum(1 << k for k in range(64) if 2 * votes[k] > len(line))


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_prints():
    r, prints = random.Random(4), LinePrints()
    sizes = [0, 1, 2, 5, 50, 254, 255, 256, 300, 511, 700]
    lines = ["".join(r.choice("abcde é𝄞") for _ in range(r.choice(sizes))) for _ in range(400)]
    assert [int(x) for x in prints.of(lines)] == [slow_print(prints.table, x) for x in lines]


@pytest.mark.parametrize("few", [-1, 1, 3, 64])
def test_distance(monkeypatch, few):
    monkeypatch.setattr(line_dedup, "FEW_EDITS", few)
    monkeypatch.setattr(line_dedup, "LONG", 0)
    r = random.Random(5)
    for _ in range(2000):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(11))) for _ in range(2))
        assert distance(a, b) == slow_distance(a, b)


def test_walk_proves():
    """A walk never finds fewer edits than there are, and similarity is that of the plain distance."""
    r, proved = random.Random(6), 0
    for n in range(600):
        a = "".join(r.choice("ab" if n % 2 else "abcdefgh ") for _ in range(r.randrange(120)))
        b = list(a)
        for _ in range(r.randrange(1 + len(a) // 4)):
            k = r.randrange(len(b) + 1)
            b[k : k + r.randrange(3)] = r.choices("ab xy", k=r.randrange(3))
        b = "".join(b)
        d, long = slow_distance(a, b), max(len(a), len(b))
        assert distance(a, b) == d and sum(map(len, line_dedup.middles(a, b))) <= len(a) + len(b)
        for most in (d - 1, d, d + 3, long):
            yes = line_dedup.within(a, b, most)
            proved += yes
            assert not (yes and d > most)
        assert similar(a, b) == (long == 0 or 1 - d / long >= 0.8)
    assert proved > 600


def test_blocks_prove():
    """Blocks never part similar lines, and part lines of the same syllables in another order."""
    r, parted = random.Random(7), 0
    syllables = ["".join(r.choice("abcdefghéñ") for _ in range(r.randrange(1, 4))) for _ in range(40)]
    pairs = []
    for n in range(300):
        a = "".join(r.choice([*syllables, " "]) for _ in range(r.choice([60, 130, 400])))
        b = list(a if n % 3 else "".join(r.choice([*syllables, " "]) for _ in range(len(a) // 2)))
        for _ in range(int(len(b) * r.choice([0, 0.02, 0.1, 0.2, 0.25]))):
            k = r.randrange(len(b) + 1)
            b[k : k + r.randrange(2)] = r.choices("abc ", k=r.randrange(2))
        if n % 5 == 0:
            b = b[len(b) // 6 :]
        pairs.append((a, "".join(b)))
    pairs += [("", ""), ("a" * 64, ""), ("", "b" * 200)]
    for (a, b), far in zip(pairs, line_dedup.far_apart(pairs)):
        parted += far
        assert not (far and 1 - slow_distance(a, b) / max(len(a), len(b), 1) >= 0.8)
    assert parted > 60
    assert line_dedup.far_apart([]).size == 0


def test_pairs_are_looked_at_once(monkeypatch):
    """Unlike lines of one fingerprint: each pair is compared once, and blocks spare the long ones the distance."""
    r, seen, measured = random.Random(8), [], []
    lines = ["".join(r.choice("abcdefghij ") for _ in range(200 + i % 3)) for i in range(20)] + ["q" * 50, "w" * 51]
    walk, far = line_dedup.within, line_dedup.distance
    monkeypatch.setattr(line_dedup, "within", lambda a, b, n: seen.append((a, b)) or walk(a, b, n))
    monkeypatch.setattr(line_dedup, "distance", lambda a, b: measured.append((a, b)) or far(a, b))
    rows = {"component": 0, "row": 0, "column": 0, "home": True, "fp": np.int64(5), "line": lines}
    pdf = pd.DataFrame({**rows, "key": [line_dedup._key(x) for x in lines]})
    assert line_dedup._verify(pdf).empty
    assert len(seen) <= 20 * 19 // 2 + 1 and len(measured) <= 1


def test_a_text_is_split_once(rows):
    """Not once more for each of its lines, which takes a time that grows with their square."""
    found = line_dedup.line_dedup(rows([(1, "a line\na line\nb")], "doc_id long, text string"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert found.first().text == "a line\nb"


def test_normalised():
    assert normalised(" Ab,  cD_7!\n\n--\nÉß 42 ½") == ["ab cd 0", "", "", "éß 00 ½"]


def brute(docs):
    """Numbers of the lines that go, per document."""
    prints = LinePrints()
    lines = [(d, k, x) for d, t in docs for k, x in enumerate(normalised(t or "")) if x]
    fps = prints.of([x for _, _, x in lines])
    up = list(range(len(lines)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(lines)):
        for j in range(i):
            if (int(fps[i]) ^ int(fps[j])).bit_count() <= 3 and similar(lines[i][2], lines[j][2]):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    first = {}
    for i, (d, k, _) in enumerate(lines):
        first[top(i)] = min(first.get(top(i), (d, k)), (d, k))
    gone = {d: [] for d, _ in docs}
    for i, (d, k, _) in enumerate(lines):
        if first[top(i)] != (d, k):
            gone[d].append(k)
    return gone


def corpus(seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 9))) for _ in range(300)]
    pool = [" ".join(r.choice(words) for _ in range(r.choice([1, 3, 30, 60]))) for _ in range(60)]
    docs = []
    for i in range(60):
        text = []
        for _ in range(r.randrange(1, 9)):
            line = r.choice(pool)
            if r.random() < 0.5:
                at = r.randrange(len(line) + 1)
                line = line[:at] + r.choice(["!", "x", "", " 7"]) + line[at + r.randrange(2) :]
            text.append(r.choice([line, line, line.upper(), ""]))
        docs.append((i, "\n".join(text)))
    return docs


@pytest.mark.parametrize("square", [4, 20_000])
def test_line_dedup(rows, monkeypatch, square):
    monkeypatch.setattr(meeting, "SQUARE", square)
    docs = corpus(6)
    want = brute(docs)
    got = {r.doc_id: r for r in line_dedup.line_dedup(rows(docs, "doc_id long, text string")).collect()}
    assert {d: r.removed for d, r in got.items()} == want
    assert any(want.values())
    for d, text in docs:
        lines = text.split("\n")
        assert got[d].text == "\n".join(x for k, x in enumerate(lines) if k not in want[d])
        assert (got[d].n_lines, got[d].n_removed) == (len(lines), len(want[d]))


def test_edges(rows):
    line = "the same line stands here more than once and is long enough"
    data = [
        (None, line, "a"),
        (1, None, "b"),
        (2, "", "c"),
        (3, "\n\n", "d"),
        (4, f"{line}\nown words of four", "e"),
        (5, "own words of five", "f"),
        (5, "own words of five", "g"),
        (6, "y " * 40_000, "h"),
    ]
    df = rows(data, "doc_id long, text string, tag string").selectExpr("*", "tag AS n_lines", "tag AS key", "1 AS stay")
    got = line_dedup.line_dedup(df, carry=("tag",)).withColumnsRenamed({"n_lines": "n", "n_removed": "gone"})
    got = got.select("doc_id", "text", "tag", "n", "gone", "removed").collect()
    with pytest.raises(ValueError):
        line_dedup.line_dedup(df, carry=("n_lines",))
    by = {r.tag: r for r in got}
    assert by["a"].gone == 0 and by["e"].text == "own words of four"
    assert (by["b"].text, by["b"].n) == (None, 0)
    assert (by["c"].text, by["c"].n, by["d"].text, by["d"].gone) == ("", 1, "\n\n", 0)
    assert by["f"][3:] == by["g"][3:] and by["f"].gone == 0 and by["h"].gone == 0


def test_a_line_of_a_third_of_all_documents(rows, monkeypatch):
    monkeypatch.setattr(line_dedup, "HEAVY_KEYS", 5)
    line = "this line stands in very many documents and is long enough"
    docs = [(i, f"{line}\nwords of number {i} alone {'abcdefghij'[i % 10] * 9}\n{line if i % 2 else ''}") for i in range(40)]
    got = {r.doc_id: r.removed for r in line_dedup.line_dedup(rows(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs)


def test_empty_table(rows):
    assert line_dedup.line_dedup(rows([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("square", [4, 20_000])
def test_a_pair_meets_in_one_group(spark, monkeypatch, square):
    """Fingerprints within 3 bits meet in the group of the first pair of blocks in which they agree,
    and what is tied to others only there, or cannot be similar by its size, is in no larger group."""
    monkeypatch.setattr(meeting, "SQUARE", square)
    r = random.Random(9)
    # a chain of steps of 2 bits: all links taken together tie it to one
    chain = [r.getrandbits(64)]
    for k in range(300):
        chain.append(chain[-1] ^ 1 << (7 * k) % 64 ^ 1 << (7 * k + 31) % 64)
    prints = sorted({*chain, *(chain[0] ^ 1 << k for k in range(64)), *(r.getrandbits(64) for _ in range(200))})
    size = {x: 100 + 40 * (n % 2) for n, x in enumerate(prints)}
    own = {x for n, x in enumerate(prints) if n % 9 == 0}
    signed = [(x - (x >> 63 << 64), (x in own) << 62 | size[x] << 31 | size[x]) for x in prints]
    found = line_dedup.fingerprint_groups(spark.createDataFrame(signed, "fp long, sizes long")).collect()
    groups = {}
    for x in found:
        groups.setdefault(x.component, set()).add(x.fp % 2**64)
    blocks = lambda x: [x >> k & (1 << w) - 1 for k, w in zip((0, 13, 26, 39, 52), line_dedup.BLOCKS)]
    near = 0
    for i, x in enumerate(prints):
        for y in prints[: i + 1]:
            if (x ^ y).bit_count() <= 3 and size[x] == size[y] and (x != y or x in own):
                near += x != y
                same = [a == b for a, b in zip(blocks(x), blocks(y))]
                first = next(n for n, (a, b) in enumerate(line_dedup.PAIRS) if same[a] and same[b])
                assert any({x, y} <= g for c, g in groups.items() if c & 15 == first)
    assert near > 300 and max(map(len, groups.values())) < 100
    for g in groups.values():
        assert len({size[x] for x in g}) == 1
