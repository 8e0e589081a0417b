"""Benchmark search and top-k search against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import decontaminate, topk

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_hits(docs, items):
    windows = {}
    for name, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(name)
    out = []
    for d, text in docs:
        w, hit, found = WORD.findall((text or "").translate(LOWER)), set(), set()
        for window, names in windows.items():
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
                    found |= {str(x) for x in names if x is not None}
        mark = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(d), len(w), len(hit), len(found), mark, bool(hit)))
    return sorted(out)


def benchmark_case(seed):
    r = random.Random(seed)
    words = ["a", "B", "c", "é", "İ", "42", "d-e", "x_y"]
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(i, line(r.choice([0, 1, 2, 4, 9, 10, 11, 25]))) for i in range(12)]
    items += [(100, None), (None, line(14)), (3, line(12)), (5, items[5][1])]
    docs = []
    for i in range(60):
        parts = [line(r.randrange(30))]
        if r.random() < 0.6:
            parts.insert(r.randrange(2), r.choice(items)[1] or "")
        docs.append((i if i % 10 else None, " \n".join(parts)))
    return [*docs, (70, None), (71, ""), (72, line(3000)), docs[1]], items


@pytest.mark.parametrize("piece,table", [(1 << 20, 500_000), (40, 500_000), (1 << 20, 30)])
def test_contamination(rows, monkeypatch, piece, table):
    monkeypatch.setattr(decontaminate, "PIECE", piece)
    monkeypatch.setattr(decontaminate, "TABLE_WINDOWS", table)
    docs, items = benchmark_case(7)
    left = rows([(d, t, 1) for d, t in docs], "doc_id long, text string, n_hit int")
    right = rows([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = decontaminate.contamination(left, right).collect()
    want = slow_hits(docs, items)
    assert sorted((str(r.doc_id), *r[1:6]) for r in got) == want
    kept = decontaminate.decontaminate(left, right)
    assert kept.columns == left.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(d for d, *_, bad in want if not bad)


def test_no_items_or_documents(rows):
    docs, items = rows([(1, "a b")], "doc_id long, text string"), rows([], "item_id long, text string")
    assert [r.contaminated for r in decontaminate.contamination(docs, items).collect()] == [False]
    assert decontaminate.decontaminate(docs, items).count() == 1
    assert decontaminate.contamination(rows([], "doc_id long, text string"), items).count() == 0


def slow_top(data, k):
    good = []
    for d, v in data:
        if d is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((d, [math.floor(256 * x) for x in v]))
    out = set()
    for q, a in good:
        if q % 50 == 0:
            found = [(-sum(x * y for x, y in zip(a, b)), d) for d, b in good if d != q]
            out |= {(q, n + 1, d, -s) for n, (s, d) in enumerate(sorted(found)[:k])}
    return out


@pytest.mark.parametrize("square", [(20_000, 2_000), (30, 2)])
@pytest.mark.parametrize("kind", ["spread", "clustered", "copies"])
def test_top_k(rows, monkeypatch, square, kind):
    monkeypatch.setattr(topk, "DATA_SQUARE", square[0])
    monkeypatch.setattr(topk, "QUERY_SQUARE", square[1])
    monkeypatch.setattr(topk, "PIVOTS", 4)
    r = random.Random(8)
    centres = [[r.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    data = []
    for i in range(0, 1500, 5):
        c = r.choice(centres)
        v = [r.gauss(0, 1) for _ in range(6)]
        if kind == "clustered":
            v = [3 * x + 0.05 * y for x, y in zip(c, v)]
        if kind == "copies" and i % 3:
            v = centres[0]
        data.append((i, v))
    data += [(2000, None), (2050, [1.0, None]), (2100, [math.nan] * 6), (2150, [math.inf] * 6), (2200, [0.5]), (2250, []), (None, [1.0] * 6)]
    df = rows([(d, v, 0) for d, v in data], "vec_id long, embedding array<double>, score int")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, k=5)
    assert {tuple(x) for x in got.collect()} == slow_top(data, 5)


@pytest.mark.parametrize("often", [7, 50])
def test_an_id_on_a_third_of_the_rows(rows, monkeypatch, often):
    """Summaries stay small, and the bound holds, be the id a candidate or a query."""
    r, seen, reach = random.Random(9), [], topk.Cells.reach

    def watched(self, k, radius, closest):
        out = reach(self, k, radius, closest)
        seen.append((max(map(len, closest.values())), max(np.ptp(x, axis=1).max() for x in out.values())))
        return out

    monkeypatch.setattr(topk.Cells, "reach", watched)
    data = [(often if i % 3 == 0 else i, [r.gauss(0, 1) for _ in range(6)]) for i in range(600)]
    df = rows(data, "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, k=5)
    assert {tuple(x) for x in got.collect()} == slow_top(data, 5)
    assert seen[0][0] <= 6 and math.isfinite(seen[0][1])


def test_few_rows(rows):
    schema = "vec_id long, embedding array<float>"
    one = F.col("vec_id") % 50 == 0
    assert topk.top_k(rows([], schema), one).count() == 0
    assert topk.top_k(rows([(1, [1.0])], schema), one).count() == 0
    assert topk.top_k(rows([(0, [1.0])], schema), one).count() == 0
    assert [tuple(x) for x in topk.top_k(rows([(0, [1.0]), (1, [1e30])], schema), one).collect()] == [(0, 1, 1, 2**63 - 1)]
