"""BPE with word ends: short words as contiguous arrays of ranks, scanned for the least one.

A word is a row of parts, one for each boundary, beside a row of ranks, one for each two adjacent
parts. The least rank is found by scanning, the boundary there is deleted, and the two ranks beside
it are looked up anew, until no rank is left. Words of one length are rows of one array, so a scan
goes over thousands of words at a time; words that are done leave it. Words of more than ``SHORT``
parts, for which scanning costs the square of the length, take their least ranks from a heap.

Encoding is a projection: it needs no shuffle, and a task lost is a task done anew. Every task
remembers the words it has met, as far as there is room.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from riskloom.llm.common import pick, sha256_hex, small_batches, stretches

#: Parts up to which a word is scanned.
SHORT = 128
#: Words a task remembers, besides those of a turn.
REMEMBERED = 400_000
#: Bytes of a text that are split into words at a time, and ids decoded at a time.
STEP = 1 << 16
#: Bytes of texts whose new words are encoded together.
TURN = 4 << 20

SPACE = re.compile(rb"[\x09-\x0D\x20]")
_SPACE = re.compile(r"[\x09-\x0D\x20]+")

NO_RANK = np.iinfo(np.int32).max

# Characters whose case, class and composition all Unicode tables in use agree on; final sigma aside.
_PLAIN = regex.compile(r"[\x00-˿̀-ͷЀ-ԯ‐-‧‰-⁞€]*")


@dataclass(frozen=True)
class WordModel:
    """A tokenizer file with BPE merges and a mark at the end of words.

    Only files whose parts are those handled here are taken: NFC, white space, lower case; one
    splitting pattern over bytes; no decoder.
    """

    text: str

    def __post_init__(self) -> None:
        own = self._own
        model, normal, split = own["model"], own["normalizer"], own["pre_tokenizer"]
        steps = [x["type"] for x in (normal or {}).get("normalizers", [])]
        kinds = [x["type"] for x in (split or {}).get("pretokenizers", [])]
        if (
            model["type"] != "BPE"
            or not model["end_of_word_suffix"]
            or model["continuing_subword_prefix"]
            or model["dropout"]
            or steps != ["NFC", "Replace", "Lowercase"]
            or kinds != ["Split", "ByteLevel"]
            or own["decoder"] is not None
            or own["post_processor"] is not None
        ):
            raise ValueError("not a BPE file of the kind that is handled here")

    @cached_property
    def _own(self) -> dict:
        return json.loads(self.text)

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_str(self.text)

    @cached_property
    def special(self) -> dict[str, int]:
        return {t["content"]: t["id"] for t in self._own["added_tokens"]}

    @cached_property
    def names(self) -> list[str]:
        """The text of every id."""
        known = {i: t for t, i in (*self._own["model"]["vocab"].items(), *self.special.items())}
        return [known.get(i, "") for i in range(max(known) + 1)]

    @cached_property
    def pattern(self) -> regex.Pattern:
        return regex.compile(self._own["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

    @cached_property
    def special_pattern(self) -> regex.Pattern:
        return regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    @cached_property
    def first_parts(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the 256 bytes, within a word and at its end."""
        vocab, mark = self._own["model"]["vocab"], self._own["model"]["end_of_word_suffix"]
        letters = [letter for letter, _ in sorted(byte_letters().items(), key=lambda x: x[1])]
        return (
            np.array([vocab[x] for x in letters], np.int32),
            np.array([vocab[x + mark] for x in letters], np.int32),
        )

    @cached_property
    def merges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of ids in ascending order, their ranks, and the id that each rank makes."""
        vocab = self._own["model"]["vocab"]
        ranks: dict[int, int] = {}
        made = np.empty(len(self._own["model"]["merges"]), np.int32)
        for rank, pair in enumerate(self._own["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            ranks[vocab[left] << 32 | vocab[right]] = rank
            made[rank] = vocab[left + right]
        pairs = np.fromiter(ranks, np.int64, len(ranks))
        order = np.argsort(pairs)
        return pairs[order], np.fromiter(ranks.values(), np.int32, len(ranks))[order], made

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs, ranks, _ = self.merges
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(pairs, wanted), len(pairs) - 1)
        return np.where(pairs[at] == wanted, ranks[at], np.int32(NO_RANK))

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian numbers of four bytes; words are not empty."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            some = np.frombuffer(b"".join(words[i] for i in at), np.uint8).reshape(-1, size)
            inner, last = self.first_parts
            parts = inner[some]
            parts[:, -1] = last[some[:, -1]]
            if size > SHORT:
                for i, row in zip(at.tolist(), parts):
                    out[i] = self._from_heap(row)
            else:
                self._scan(parts, at, out)
        return out

    def _scan(self, parts: np.ndarray, at: np.ndarray, out: list[bytes]) -> None:
        made = self.merges[2]
        ranks = self.ranks(parts[:, :-1], parts[:, 1:])
        while True:
            rows = np.arange(len(parts))
            if ranks.shape[1]:
                best = ranks.argmin(axis=1)
                least = ranks[rows, best]
                done = least == NO_RANK
            else:
                done = np.ones(len(parts), bool)
            if done.any():
                width = 4 * parts.shape[1]
                ids = parts[done].astype("<u4").tobytes()
                for k, i in enumerate(at[done].tolist()):
                    out[i] = ids[k * width : (k + 1) * width]
                parts, ranks, at = parts[~done], ranks[~done], at[~done]
                if not at.size:
                    return
                best, least, rows = best[~done], least[~done], np.arange(len(parts))
            parts[rows, best] = made[least]
            parts = _without(parts, best + 1)
            ranks = _without(ranks, best)
            for beside in (best - 1, best):
                some = np.flatnonzero((beside >= 0) & (beside < ranks.shape[1]))
                place = beside[some]
                ranks[some, place] = self.ranks(parts[some, place], parts[some, place + 1])

    def _from_heap(self, row: np.ndarray) -> bytes:
        made, n = self.merges[2], len(row)
        parts, after, before = row.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, r in enumerate(self.ranks(row[:-1], row[1:]).tolist()) if r != NO_RANK]
        heapq.heapify(heap)
        current = dict((i, r) for r, i in heap)

        def look(i: int) -> None:
            rank = NO_RANK
            if i >= 0 and after[i] < n:
                rank = int(self.ranks(np.array([parts[i]]), np.array([parts[after[i]]]))[0])
            if rank == NO_RANK:
                current.pop(i, None)
            else:
                current[i] = rank
                heapq.heappush(heap, (rank, i))

        gone = bytearray(n)
        while heap:
            rank, i = heapq.heappop(heap)
            if gone[i] or current.get(i) != rank:
                continue
            j = after[i]
            parts[i], after[i], gone[j] = int(made[rank]), after[j], 1
            if after[i] < n:
                before[after[i]] = i
            look(i)
            look(before[i])
        return np.array([p for p, x in zip(parts, gone) if not x], "<u4").tobytes()

    def words(self, text: str) -> list[str]:
        """The words of a text in lower case, and special tokens as they stand."""
        if self.special and "<" in text:
            sections = self.special_pattern.split(text)
            return [w for x in sections for w in ([x] if x in self.special else self._words(x))]
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        if text.isascii():
            return self.pattern.findall(text.lower())
        if _PLAIN.fullmatch(text) and "Σ" not in text:
            return self.pattern.findall(unicodedata.normalize("NFC", text).lower())
        units = _SPACE.split(text)
        if len(units) > 1:
            return [w for x in units for w in self._words(x)]
        # what tables of several ages may see differently is asked of the library
        back = byte_letters()
        normal = self.library.normalizer.normalize_str(text)
        found = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(map(back.__getitem__, w)).decode() for w, _ in found]

    def ids_of(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of distinct words and special tokens."""
        plain = [w for w in words if w not in self.special]
        ids = dict(zip(plain, self.encode_words([w.encode() for w in plain])))
        return ids | {w: i.to_bytes(4, "little") for w, i in self.special.items()}


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte: itself if it shows, else the next from U+0100 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _without(rows: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Every row without its element at ``place``."""
    stay = np.ones(rows.shape, bool)
    stay[np.arange(len(rows)), place] = False
    return rows[stay].reshape(len(rows), rows.shape[1] - 1)


def _turns(texts: pa.Array) -> Iterator[list[tuple[int, bytes]]]:
    """Stretches of texts with their rows, of about TURN bytes at a time."""
    turn, size = [], 0
    for row, cell in enumerate(texts):
        for some in stretches(cell.as_py() or b"", SPACE, STEP):
            turn.append((row, some))
            size += len(some)
            if size > TURN:
                yield turn
                turn, size = [], 0
    if turn:
        yield turn


def encode(docs: DataFrame, model: WordModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): the ids of each whole text, one row per row of ``docs``.

    Special tokens that stand in a text get their ids, others are not added. Null and empty texts
    have no ids, and so have texts of white space. Repeated rows each get theirs, null ids too; there
    are no ties to settle, as of equal ranks the leftmost is merged. An empty table gives no rows,
    and further columns of ``docs`` stay out.
    """
    small_batches(docs.sparkSession)
    own = pick(docs, doc_id=doc_id, text=text).select("doc_id", F.col("text").cast("binary").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model.text)  # as large as the vocabulary
    kind = own.schema["doc_id"].dataType.simpleString()

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, known = WordModel(shared.value), {}
        for b in it:
            found: list[list[bytes]] = [[] for _ in range(b.num_rows)]
            for turn in _turns(b.column(1)):
                words = [(row, made.words(text.decode())) for row, text in turn]
                new = {w for _, some in words for w in some}
                if len(known) > REMEMBERED:
                    known = {}
                known.update(made.ids_of(new.difference(known)))
                for row, some in words:
                    found[row].append(b"".join(map(known.__getitem__, some)))
            rows = [b"".join(x) for x in found]
            ends = np.cumsum([0, *(len(r) // 4 for r in rows)])
            ids = pa.array(np.frombuffer(b"".join(rows), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["doc_id", "ids"])

    return own.mapInArrow(batch, f"doc_id {kind}, ids array<int>")


def _decoded(names: list[str], ids: list[int]) -> Iterator[str]:
    for k in range(0, len(ids), STEP):
        yield (" " if k else "") + " ".join(map(names.__getitem__, ids[k : k + STEP]))


def decode(tokens: DataFrame, model: WordModel, ids: str = "ids") -> DataFrame:
    """``tokens`` with a column ``decoded``: the texts of the ids, joined by spaces, as the file has
    no decoder; a null list stays null. A column of that name is replaced.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(model.text)
    rows = tokens.drop("decoded") if ids != "decoded" else tokens
    at = rows.columns.index(ids)

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = WordModel(shared.value).names
        for b in it:
            texts = ["".join(_decoded(names, x.values.to_pylist())) if x.is_valid else None for x in b.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, "decoded"]
            )

    return rows.mapInArrow(batch, T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))


def digests(tokens: DataFrame, model: WordModel) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, ids); a null list counts as empty.

    Digests are of the ids as little-endian numbers of four bytes, and of what they decode to.
    """
    kind = tokens.schema["doc_id"].dataType.simpleString()
    shared = tokens.sparkSession.sparkContext.broadcast(model.text)

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = WordModel(shared.value).names
        for b in it:
            counts, marks, texts = [], [], []
            for x in b.column(1):
                some = x.values.to_numpy() if x.is_valid else np.empty(0, np.int32)
                counts.append(len(some))
                marks.append(sha256_hex(some.astype("<u4").tobytes()))
                mark = sha256()
                for piece in _decoded(names, some.tolist()):
                    mark.update(piece.encode())
                texts.append(mark.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(marks, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return tokens.select("doc_id", "ids").mapInArrow(
        batch, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
