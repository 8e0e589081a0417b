"""Documents as positions into their batch's distinct tokens, and one global exchange of tokens.

A batch of documents is written once as rows of two kinds: its documents, each token given by its
place among the batch's distinct tokens, and the distinct tokens, dealt to shards by their hash. A
shard gathers its tokens from all batches, so that equal tokens meet and are worked on once; what
comes of them goes back to the batches by place. A token costs one entry per batch, however often
it occurs, so a very common token is no hot key.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import pick, small_batches
from riskloom.session import fresh_dir, note_scratch

#: Bytes of text in a batch, unless one document has more.
BATCH_BYTES = 16 << 20
#: Bytes of text for which there is one shard of tokens.
SHARD_BYTES = 8 << 20
#: The shard number of rows that hold documents.
DOCUMENTS = -1


def packed(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of their width, as the upper bytes are mostly alike."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pack_places(places: np.ndarray) -> bytes:
    """Ascending places, by their steps."""
    return packed(np.diff(places, prepend=places.dtype.type(0)))


def unpack_places(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, "<u4"), dtype=np.uint32)


def pack_words(words: list[bytes]) -> tuple[bytes, bytes]:
    sizes = np.fromiter(map(len, words), np.uint32, len(words))
    return packed(sizes), zstandard.ZstdCompressor(level=1).compress(b"".join(words))


def unpack_words(sizes: bytes, joined: bytes) -> list[bytes]:
    ends = np.cumsum(unpacked(sizes, "<u4").astype(np.int64)).tolist()
    blob = zstandard.ZstdDecompressor().decompress(joined)
    return [blob[a:b] for a, b in zip([0, *ends], ends)]


class Exchange:
    """The written batches of ``docs``; ``flag`` names a boolean that is carried with a document.

    ``tokens_of`` gives the tokens of a text as bytes. The columns of ``table`` hold, for a batch's
    documents, their ids, flags and numbers of tokens, and in a the tokens' places; for a shard of
    its tokens, in a their places, in b and c their sizes and bytes, and in d how often they occur
    in flagged documents. The table is bucketed by batch, so what comes back joins without another
    shuffle of the documents.
    """

    SCHEMA = "batch long, shard int, ids array<{}>, flags array<boolean>, counts array<int>, a binary, b binary, c binary, d binary"

    def __init__(
        self,
        docs: DataFrame,
        doc_id: str,
        text: str,
        tokens_of: Callable[[], Callable[[bytes], list[bytes]]],
        flag=None,
    ):
        small_batches(docs.sparkSession)
        own = pick(docs, doc_id=doc_id, text=text)
        self.id_type = own.schema["doc_id"].dataType.simpleString()
        total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(1, -(-total // SHARD_BYTES))
        flagged = F.lit(False) if flag is None else flag
        own = own.select("doc_id", F.col("text").cast("binary").alias("text"), flagged.alias("flag"))
        schema = self.SCHEMA.format(self.id_type)

        def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split, part, nth = tokens_of(), TaskContext.get().partitionId(), 0
            pile = _Pile(split)
            for b in it:
                for i, text in enumerate(b.column(1)):
                    pile.add(b.column(0)[i], text.as_py() or b"", b.column(2)[i].as_py())
                    if pile.size >= BATCH_BYTES:
                        yield from pile.rows((part << 32) + nth, shards, b.schema.field(0).type)
                        pile, nth = _Pile(split), nth + 1
            if pile.ids:
                yield from pile.rows((part << 32) + nth, shards, b.schema.field(0).type)

        spark = docs.sparkSession
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BATCH_BYTES)
        name = f"batches_{uuid.uuid4().hex}"
        written = own.mapInArrow(batches, schema).write.bucketBy(min(buckets, 100_000), "batch")
        path = fresh_dir(spark, "batches")
        note_scratch(path, name)
        written.option("path", path).saveAsTable(name)
        self.table = spark.table(name)
        self.documents = self.table.where(F.col("shard") == DOCUMENTS)
        self.tokens = self.table.where(F.col("shard") != DOCUMENTS)


class _Pile:
    """A batch in the making."""

    def __init__(self, split: Callable[[bytes], list[bytes]]):
        self.split, self.size = split, 0
        self.places: dict[bytes, int] = {}
        self.ids, self.flags, self.counts = [], [], array("i")
        self.sequence = array("I")
        self.flagged: list[np.ndarray] = []

    def add(self, doc_id: pa.Scalar, text: bytes, flag: bool) -> None:
        words, places = self.split(text), self.places
        here = array("I", [places.setdefault(w, len(places)) for w in words])
        self.sequence.extend(here)
        self.counts.append(len(words))
        self.ids.append(doc_id)
        self.flags.append(flag)
        self.size += len(text)

    def rows(self, batch: int, shards: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        kind = pa.schema(
            [
                ("batch", pa.int64()),
                ("shard", pa.int32()),
                ("ids", pa.list_(id_type)),
                ("flags", pa.list_(pa.bool_())),
                ("counts", pa.list_(pa.int32())),
                ("a", pa.binary()),
                ("b", pa.binary()),
                ("c", pa.binary()),
                ("d", pa.binary()),
            ]
        )
        sequence = np.frombuffer(self.sequence, np.uint32) if len(self.sequence) else np.empty(0, np.uint32)
        seats = np.repeat(np.array(self.flags, bool), np.frombuffer(self.counts, np.int32))
        # the most frequent tokens get the lowest places
        order = np.argsort(-np.bincount(sequence, minlength=len(self.places)), kind="stable")
        rank = np.empty(order.size, np.uint32)
        rank[order] = np.arange(order.size, dtype=np.uint32)
        sequence = rank[sequence]
        often = np.bincount(sequence[seats], minlength=order.size).astype(np.uint32)
        ids = [x.as_py() for x in self.ids]
        rows = [(batch, DOCUMENTS, ids, self.flags, list(self.counts), packed(sequence), None, None, None)]
        words = list(self.places)
        words = [words[i] for i in order.tolist()]
        shard = np.fromiter((xxhash.xxh64_intdigest(w) % shards for w in words), np.int64, len(words))
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        for at in np.split(order, cuts) if len(words) else []:
            sizes, joined = pack_words([words[i] for i in at])
            place, here = pack_places(at.astype(np.uint32)), packed(often[at])
            rows.append((batch, int(shard[at[0]]), None, None, None, place, sizes, joined, here))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)
