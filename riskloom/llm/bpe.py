"""Byte-level BPE: every distinct pre-token is encoded once, wherever it stands.

Pre-tokens are exploded into their places, the distinct ones are shuffled by a hash and encoded
once each, and their ids go back by place, where the documents are put together again (see
``exchange``: places are kept per batch of documents). Decoding joins the table of token bytes,
whose size is the vocabulary's, inside the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskloom.llm.common import sha256_hex
from riskloom.llm.exchange import Exchange, packed, unpack_places, unpack_words, unpacked
from riskloom.llm.pretokens import Splitter


#: Pre-tokens put back in their places at a time.
STEP = 1 << 18


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, ids array<int>): the token ids of each whole text, one row per row of ``docs``.

    Every match of ``pattern`` is encoded by itself, merging by rank; there are no special tokens.
    Null and empty texts have no ids. Repeated rows each get theirs, null ids too. An empty table
    gives no rows.
    """
    sc = docs.sparkSession.sparkContext
    table = sc.broadcast(ranks)  # as large as the vocabulary

    def tokens_of():
        split = Splitter(pattern)
        return lambda raw: [w.encode() for w in split(raw.decode())]

    made = Exchange(docs, doc_id, text, tokens_of)

    def encode_shard(rows: pa.Table) -> pa.Table:
        bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table.value, special_tokens={})
        known: dict[bytes, list[int]] = {}
        out = []
        for r in range(rows.num_rows):
            words = unpack_words(rows["b"][r].as_py(), rows["c"][r].as_py())
            for w in words:
                if w not in known:
                    known[w] = bpe.encode_ordinary(w.decode())
            ids = [known[w] for w in words]
            sizes = np.fromiter(map(len, ids), np.uint32, len(ids))
            flat = np.fromiter((i for some in ids for i in some), np.uint32, int(sizes.sum()))
            out.append((rows["batch"][r].as_py(), packed(sizes), packed(flat), rows["a"][r].as_py()))
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        columns = list(zip(*out)) if out else [[], [], [], []]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["batch", "sizes", "flat", "places"])

    replies = made.tokens.groupBy("shard").applyInArrow(
        encode_shard, "batch long, sizes binary, flat binary, places binary"
    )
    kind = made.id_type

    def assemble(key: tuple, documents: pa.Table, answers: pa.Table) -> pa.Table:
        parts = [
            (unpack_places(p.as_py()), unpacked(s.as_py(), "<u4"), unpacked(f.as_py(), "<u4"))
            for p, s, f in zip(answers["places"], answers["sizes"], answers["flat"])
        ]
        size = np.zeros(sum(len(p) for p, _, _ in parts), np.int64)
        start, at = np.zeros_like(size), 0
        for place, sizes, flat in parts:
            size[place] = sizes
            start[place] = at + np.cumsum(sizes, dtype=np.int64) - sizes
            at += len(flat)
        pool = np.concatenate([f for _, _, f in parts]) if parts else np.empty(0, np.uint32)
        del parts
        ids, tokens, ends = [], [], [np.zeros(1, np.int64)]
        for r in range(documents.num_rows):
            sequence = unpacked(documents["a"][r].as_py(), "<u4")
            counts = documents["counts"][r].values.to_numpy().astype(np.int64)
            for k in range(0, sequence.size, STEP):
                some = sequence[k : k + STEP]
                each = size[some]
                first = np.cumsum(each) - each
                tokens.append(pool[np.repeat(start[some] - first, each) + np.arange(each.sum())].astype(np.int32))
            until = np.r_[0, np.cumsum(size[sequence])][np.cumsum(counts)]
            ends.append(until + ends[-1][-1])
            ids.append(documents["ids"][r].values)
        flat = np.concatenate(tokens) if tokens else np.empty(0, np.int32)
        del tokens
        offsets = pa.array(np.concatenate(ends).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(flat))
        return pa.table([pa.concat_arrays(ids) if ids else pa.array([], documents.schema.field("ids").type.value_type), lists], names=["doc_id", "ids"])

    documents = made.documents.select("batch", "ids", "counts", "a")
    return (
        documents.groupBy("batch")
        .cogroup(replies.groupBy("batch"))
        .applyInArrow(assemble, f"doc_id {kind}, ids array<int>")
    )


def _joiner(table: dict[int, bytes]):
    """The bytes of a list of ids, by the table of token bytes."""
    return lambda ids: b"".join(map(table.__getitem__, ids))


def decode(tokens: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """``tokens`` with a column ``decoded``: the bytes of each list of ids, joined; null stays null."""
    table = tokens.sparkSession.sparkContext.broadcast({i: b for b, i in ranks.items()})
    rows = tokens.drop("decoded")
    at = rows.columns.index(ids)

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = _joiner(table.value)
        for b in it:
            texts = [join(x.values.to_numpy().tolist()) if x.is_valid else None for x in b.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(texts, pa.binary())], names=[*b.schema.names, "decoded"]
            )

    return rows.mapInArrow(batch, T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())]))


def digests(tokens: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, ids): the ids, and what they decode to.

    A null list counts as empty; null ids and repeated rows each get their row.
    """
    kind = tokens.schema["doc_id"].dataType.simpleString()
    table = tokens.sparkSession.sparkContext.broadcast({i: b for b, i in ranks.items()})

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = _joiner(table.value)
        name = {i: str(i) for i in table.value}
        for b in it:
            counts, marks, texts = [], [], []
            for x in b.column(1):
                some = x.values.to_numpy().tolist() if x.is_valid else []
                counts.append(len(some))
                marks.append(sha256_hex(" ".join(map(name.__getitem__, some)).encode()))
                texts.append(sha256_hex(join(some)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(marks, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return tokens.select("doc_id", "ids").mapInArrow(
        batch, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
