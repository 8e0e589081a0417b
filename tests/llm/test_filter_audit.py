"""The audit of filters against brute force over all orders."""

import random
import re
from itertools import permutations

import numpy as np
import pytest

from riskloom.llm import filter_audit

DOCS = "doc_id long, text string, source string, part string, A string, copies int"
LABELS = "doc_id long, quality int, toxic int, A string"


def failing(data):
    """(part, id, failed filters) of each row."""
    out = []
    for doc_id, text, source, *_ in data:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = ""
        found += "A" * (len(words) < 50)
        found += "B" * (100 * len(set(words)) < 65 * len(words))
        found += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text))
        found += "D" * bool(re.search(r"[#$%&*|]", text))
        smaller = [d for d, t, *_ in data if (t or "") == text and None not in (d, doc_id) and d < doc_id]
        out.append((source or "", doc_id, found + "E" * bool(smaller)))
    return out


def brute(data, labels):
    rows = failing(data)
    good = {d for d, q, *_ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t, *_ in labels if t == 1 and d is not None}
    out = []
    for part in {p for p, *_ in rows}:
        own = [(d, f) for p, d, f in rows if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        made = []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                fails = sum(f in x[1] for x in own)
                alone = sum(x[1] == f for x in own)
                made.append((part, "".join(order), step, len(left), len(gone), fails - len(gone), alone, sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)))
        out += [(*m, shapley[m[1][m[2] - 1]]) for m in made]
    return sorted(out)


def documents(seed, n):
    r = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "é", "\xa0", "$", "x|y", "delta", "中", "#"]
    data = []
    for i in range(n):
        chosen = words[: r.randrange(1, len(words))] if i % 3 else [f"w{k}" for k in range(200)]
        text = r.choice([" ", "\n"]).join(r.choice(chosen) for _ in range(r.randrange(90)))
        data.append((i if i % 11 else None, text, r.choice(["s1", "s2", None, ""]), "p", "x", 7))
    copies = [(d, data[r.randrange(5)][1], s, *rest) for d, _, s, *rest in data[: n // 2]]
    return [*data, *copies, *[data[1]] * 4, (900, None, "s3", "", "", 0), (901, "", "s3", "", "", 0)]


@pytest.mark.parametrize("range_rows", [1 << 16, 7])
def test_against_brute_force(rows, monkeypatch, range_rows):
    monkeypatch.setattr(filter_audit, "RANGE_ROWS", range_rows)
    data = documents(1, 80)
    labels = [(i, i % 2, i % 3, "y") for i in range(0, 80, 2)] + [(4, 1, 1, "y"), (4, 1, None, "y"), (None, 1, 1, "y")]
    got = filter_audit.filter_audit(rows(data, DOCS), rows(labels, LABELS))
    assert sorted(map(tuple, got.collect())) == brute(data, labels)


def test_other_filters_and_parts(rows):
    data = [(i, i % 3, i % 2 == 0, None if i % 5 == 0 else i % 3 == 0) for i in range(30)]
    df = rows(data, "key long, shard long, even boolean, third boolean")
    got = filter_audit.audit(df, ["even", "third"], [], part="shard", doc_id="key")
    found = {(r.part, r.filter_order, r.step): r.removed for r in got.collect()}
    for shard in range(3):
        own = [(e, bool(t)) for _, s, e, t in data if s == shard]
        assert found[shard, "eventhird", 1] == sum(e for e, _ in own)
        assert found[shard, "eventhird", 2] == sum(t and not e for e, t in own)
    with pytest.raises(ValueError):
        filter_audit.audit(df, [], [])


def test_lists():
    r = np.random.default_rng(2)
    for _ in range(200):
        a, b = (np.unique(r.integers(0, 60, r.integers(0, 50))) for _ in range(2))
        assert filter_audit.union(a, b).tolist() == sorted({*a.tolist()} | {*b.tolist()})
        assert filter_audit.difference(a, b).tolist() == sorted({*a.tolist()} - {*b.tolist()})


def test_empty_tables(rows):
    none = filter_audit.filter_audit(rows([], DOCS), rows([], LABELS))
    assert none.count() == 0
    one = filter_audit.filter_audit(rows([(1, "x", None, "", "", 0)], DOCS), rows([], LABELS)).collect()
    assert len(one) == 600 and {r.good_lost for r in one} == {0} and {r.part for r in one} == {""}
