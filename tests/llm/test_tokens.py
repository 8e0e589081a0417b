"""Byte-level BPE and token counts against the tokenizer libraries."""

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from riskloom.llm import bpe, exchange, pretokens, token_counts

RANKS = pretokens.load_ranks(P.path("byte_bpe_50k.tiktoken"))
ENCODER = tiktoken.Encoding("all", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
    MODEL = f.read()
COUNTER = Tokenizer.from_str(MODEL)

ALPHABET = ["a", "b", "The", " ", "  ", "\n", "\t", "'s", "'ll", "1", "½", "é", "中", "𝄞", "!", "?!", "\x85", "　", "ՙ", "՘", "\U0003fc3f", "<|endoftext|>", "<|", "|>"]


def texts(seed, n, size):
    r = random.Random(seed)
    out = ["".join(r.choice(ALPHABET) for _ in range(r.randrange(size))) for _ in range(n)]
    return [*out, "", None, "<|endoftext|>" * 3, "x" * 5000, " " * 3000, "ab " * 20_000]


def test_splitter_is_the_libraries():
    from tokenizers import pre_tokenizers

    split = pretokens.Splitter(P.PATTERN)
    library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    for t in texts(1, 3000, 14):
        if t:
            assert split(t) == [t[a:b] for _, (a, b) in library.pre_tokenize_str(t)]


@pytest.mark.parametrize("batch", [64, 1 << 24])
def test_encode_and_decode(rows, monkeypatch, batch):
    monkeypatch.setattr(exchange, "BATCH_BYTES", batch)
    monkeypatch.setattr(exchange, "SHARD_BYTES", 4096)
    data = [(i if i % 7 else None, t, i) for i, t in enumerate(texts(2, 150, 40))]
    data += [data[3]]
    df = rows(data, "doc_id long, text string, ids int")
    coded = bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS)
    got = sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in coded.collect())
    assert got == sorted((str(d), ENCODER.encode_ordinary(t or ""), (t or "").encode()) for d, t, _ in data)


def test_digests(rows):
    data = [(1, "Hello  wörld"), (2, None)]
    coded = bpe.encode(rows(data, "doc_id long, text string"), RANKS, P.PATTERN)
    got = {r.doc_id: r for r in bpe.digests(coded, RANKS).collect()}
    ids = ENCODER.encode_ordinary("Hello  wörld")
    assert got[1].n_tokens == len(ids)
    assert got[1].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert got[1].decoded_sha256 == hashlib.sha256("Hello  wörld".encode()).hexdigest()
    assert got[2].ids_sha256 == got[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_digests_of_null_lists(rows):
    got = bpe.digests(rows([(1, None), (None, [])], "doc_id long, ids array<int>"), RANKS).collect()
    assert {(r.n_tokens, r.ids_sha256) for r in got} == {(0, hashlib.sha256(b"").hexdigest())} and len(got) == 2


def test_empty_tables(rows):
    empty = rows([], "doc_id long, text string")
    assert bpe.encode(empty, RANKS, P.PATTERN).count() == 0
    assert token_counts.token_counts(empty, MODEL, P.PATTERN).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(16, 4), (40, 30), (1 << 15, 1 << 8)])
def test_token_counts(rows, chunk, overlap):
    data = [(i if i % 9 else None, t, "x") for i, t in enumerate(texts(3, 200, 60))]
    data += [data[4]]
    df = rows(data, "doc_id long, text string, n_tokens string")
    got = token_counts.token_counts(df, MODEL, P.PATTERN, limit=20, chunk=chunk, overlap=overlap).collect()
    want = []
    for d, t, _ in data:
        n = len(COUNTER.encode(t or "", add_special_tokens=False))
        want.append((str(d), len((t or "").encode()), n, n > 20))
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == sorted(want)
