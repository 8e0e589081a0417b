"""Phrases and collocations against counting by hand."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from riskloom.llm import phrases

SCHEMA = "doc_id long, lang string, text string, phrase string, n long, batch long"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_counts(data, max_words):
    counts, total = Counter(), Counter()
    for _, lang, text, *_ in data:
        lang = "und" if lang is None else lang
        total[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    return counts, total


def brute(data, min_count, max_words, top):
    counts, total = brute_counts(data, max_words)
    frequent = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= min_count}
    out = []
    for lang in total:
        rows = []
        for (own, w), a in frequent.items():
            if own != lang:
                continue
            longer = [
                b
                for (other, v), b in frequent.items()
                if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))
            ]
            if any(100 * b >= 50 * a for b in longer):
                continue
            cuts = [(counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w))]
            score, k = min((1000000 * a * a // (x * y), k) for k, (x, y) in enumerate(cuts))
            rows.append((-score, -a, " ".join(w).encode(), *cuts[k]))
        for rank, (score, a, phrase, x, y) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, x, y, total[lang], -score))
    return sorted(out)


def documents(seed, n):
    r = random.Random(seed)
    words = ["a", "B", "new", "York", "é", "\xa0", "\x1c", "𝄞", "\x00", "city"]
    gaps = [" ", " ", " ", "\t", "  ", ".", ", ", "\n", "\r", "; "]
    data = []
    for i in range(n):
        text = "".join(r.choice(words[: r.randrange(1, len(words))]) + r.choice(gaps) for _ in range(r.randrange(40)))
        data.append((i if i % 9 else None, r.choice(["en", "de", "und", None]), text, "x", 1, 2))
    data += [data[0]] * 3
    return [*data, (1, "en", None, None, None, None), (2, "fr", "", "", 1, 1), (3, None, "New york " * 500, "", 1, 1)]


@pytest.mark.parametrize("batch,step", [(1 << 24, 1 << 16), (200, 3)])
def test_against_brute_force(rows, monkeypatch, batch, step):
    monkeypatch.setattr(phrases, "BATCH_BYTES", batch)
    monkeypatch.setattr(phrases, "STEP", step)
    monkeypatch.setattr(phrases, "SHARD_BYTES", batch // 2)
    data = documents(3, 60)
    got = phrases.collocations(rows(data, SCHEMA), min_count=3, max_words=4, top=25)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(data, 3, 4, 25)
    assert sorted(map(tuple, got.collect())) == want
    assert any(r[1] == 25 for r in want)


def test_counts_of_phrases(rows, monkeypatch):
    monkeypatch.setattr(phrases, "BATCH_BYTES", 300)
    monkeypatch.setattr(phrases, "SHARD_BYTES", 100)
    data = documents(4, 30)
    counts, total = brute_counts(data, 3)
    found = phrases.phrase_counts(rows(data, SCHEMA), 5, 3).collect()
    got = {(r.lang, r.phrase): r.f for r in found}
    want = {(lang, " ".join(w)): a for (lang, w), a in counts.items() if a >= 5}
    assert got == want | {(lang, ""): n for lang, n in total.items()} and len(got) == len(found)


def test_long_hashes_that_meet_are_told_apart(rows, monkeypatch):
    own = phrases.Relation.hashes
    monkeypatch.setattr(phrases.Relation, "hashes", lambda self: (own(self)[0] & np.uint64(3), own(self)[1]))
    data = [("en", "a b c d e f g h a b"), ("en", "h g f e d a b")]
    made = []
    for lang, text in data:
        pile = phrases._Pile()
        pile.add(lang, text.encode())
        rows_of = [r for b in pile.rows(len(made)) for r in b.to_pylist() if r["phrase"] is None]
        made.append(phrases.Relation.read(rows_of[0]))
    sent = [pa.Table.from_batches([p]) for k, r in enumerate(made) for p in phrases.packets(k, r, 2)]
    whole = pa.concat_tables(sent)
    replies = [
        phrases.count_shard(whole.filter(pc.equal(whole["shard"], k)), 3)
        for k in set(whole["shard"].to_pylist())
    ]
    replies = pa.concat_tables(replies)
    found = []
    for k, r in enumerate(made):
        alive, first, n = phrases.answered(r, replies.filter(pc.equal(replies["batch"], k)), 2)
        assert {r.words[i] for i in np.flatnonzero(alive)} == {b"a", b"b"}
        found += [(r.words[i], m) for i, m in zip(first, n.tolist())]
    assert sorted(found) == [(b"a", 3), (b"b", 3)]


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 10**12
    made = [("en", 0, "", 5 * big), ("en", 1, "a", 3 * big), ("en", 1, "b", 2 * big), ("en", 2, "a b", big + 1)]
    table = spark.createDataFrame(made, "lang string, size int, phrase string, f long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *a: table)
    row = phrases.collocations(None).first()
    assert row.score == 1000000 * (big + 1) ** 2 // (6 * big * big)
    assert (row.a, row.l, row.r, row.n) == (big + 1, 3 * big, 2 * big, 5 * big)


def test_no_piece_is_cut_by_batches(rows, monkeypatch):
    monkeypatch.setattr(phrases, "BATCH_BYTES", 1)
    data = [(1, "en", "one two three four. five six", "", 0, 0)] * 2
    got = {r.phrase: r.f for r in phrases.phrase_counts(rows(data, SCHEMA, 1), 2, 4).collect()}
    assert got["one two three four"] == 2 and got["five six"] == 2 and "four five" not in got


def test_empty_tables(rows):
    assert phrases.collocations(rows([], SCHEMA)).count() == 0
    assert phrases.collocations(rows([(1, None, None, "", 0, 0)], SCHEMA)).count() == 0


def test_no_tables_are_left(spark, rows):
    before = spark.catalog.listTables()
    phrases.phrase_counts(rows(documents(5, 5), SCHEMA), 2, 2)
    assert spark.catalog.listTables() == before
