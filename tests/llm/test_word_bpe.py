"""BPE with word ends against the tokenizer library."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from riskloom.llm import word_bpe

with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
    MODEL = word_bpe.WordModel(f.read())
LIBRARY = Tokenizer.from_str(MODEL.text)

ALPHABET = ["a", "b", "The", " ", "  ", "\n", "\t", "'s", "'LL", "1", "12", "½", "é", "é", "中", "𝄞", "!", "?!", "\x85", "　", "ՙ", "Σ", "ΑΣ", "İ", "\x1c", " ", "<|endoftext|>", "<|", "|>", "<|startoftext|>", "ß", "́", "ǅ", "hello", "underwriting", "\U0003fc3f", "😀", "Ⅷ"]


def texts(seed, n, size):
    r = random.Random(seed)
    out = ["".join(r.choice(ALPHABET) for _ in range(r.randrange(size))) for _ in range(n)]
    return [*out, "", None, " \n ", "<|endoftext|>" * 3, "x" * 5000, "ab " * 20_000, "antidis" * 60]


def wanted(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_encode_and_decode(rows):
    data = [(i if i % 7 else None, t, i, "x") for i, t in enumerate(texts(2, 300, 30))]
    data += [data[3], data[3]]
    df = rows(data, "doc_id long, text string, ids int, decoded string")
    coded = word_bpe.decode(word_bpe.encode(df, MODEL), MODEL)
    assert coded.columns == ["doc_id", "ids", "decoded"]
    got = sorted((str(r.doc_id), list(r.ids), r.decoded) for r in coded.collect())
    want = [(str(d), ids := wanted(t), LIBRARY.decode(ids, skip_special_tokens=False)) for d, t, *_ in data]
    assert got == sorted(want)


def test_scan_and_heap_agree(monkeypatch):
    r = random.Random(5)
    words = ["".join(r.choice("etaoinshr") for _ in range(r.randrange(1, 120))).encode() for _ in range(800)]
    scanned = MODEL.encode_words(words)
    monkeypatch.setattr(word_bpe, "SHORT", 0)
    assert MODEL.encode_words(words) == scanned


@pytest.mark.parametrize("step,turn", [(50, 200), (1 << 16, 1)])
def test_small_turns(monkeypatch, step, turn):
    monkeypatch.setattr(word_bpe, "STEP", step)
    monkeypatch.setattr(word_bpe, "TURN", turn)
    some = texts(4, 100, 30)
    got = [[] for _ in some]
    for part in word_bpe._turns(pa.array([None if t is None else t.encode() for t in some], pa.binary())):
        words = [(row, MODEL.words(text.decode())) for row, text in part]
        known = MODEL.ids_of({w for _, x in words for w in x})
        for row, x in words:
            got[row] += np.frombuffer(b"".join(map(known.__getitem__, x)), "<u4").tolist()
    assert got == [wanted(t) for t in some]


def test_digests(rows):
    data = [(1, "Hello  wörld", [3]), (2, None, None), (2, None, None), (None, "", [])]
    df = rows(data, "doc_id long, text string, ids array<int>")
    got = {r.doc_id: r for r in word_bpe.digests(word_bpe.encode(df, MODEL), MODEL).collect()}
    ids = wanted("Hello  wörld")
    assert got[1].n_tokens == len(ids)
    assert got[1].ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    assert got[1].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert got[2].ids_sha256 == got[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    lists = {r.doc_id: r.n_tokens for r in word_bpe.digests(df.select("doc_id", "ids"), MODEL).collect()}
    assert lists == {1: 1, 2: 0, None: 0}
    assert [r.decoded for r in word_bpe.decode(df.where("text is null"), MODEL).collect()] == [None, None]


def test_empty_table(rows):
    empty = rows([], "doc_id long, text string")
    assert word_bpe.digests(word_bpe.encode(empty, MODEL), MODEL).count() == 0


def test_other_files_are_refused():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        other = f.read()
    with pytest.raises(ValueError):
        word_bpe.WordModel(other)
