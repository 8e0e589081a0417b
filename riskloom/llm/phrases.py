"""Phrase mining by joining relations of occurrences, length by length.

The occurrences of phrases of k words form a relation (piece, position, phrase), kept sorted and
written out. Phrases are counted, the relation is reduced to those that are frequent, and it is
merge-joined with itself on the piece and the adjacent position, which gives the phrases of k + 1
words both of whose parts of k words are frequent.

A row of a written relation holds a batch of pieces as sorted arrays, as one row per occurrence
would be hundreds of bytes for each word of the text. Positions number the words of a batch; a
break between pieces takes a position of its own, so adjacent positions lie in one piece.

To be counted, a batch sends each of its distinct phrases once, with its number: a very common
phrase is one entry of a batch. Phrases go as sorted hashes of 96 bits, of which two that differ
agree about once in ten million times among a hundred billion phrases, and are dealt to shards by
the upper bits, so that the steps between them are small numbers. A shard adds up and answers by
place which phrases are frequent. Of the batches that have a frequent phrase the first writes its
words down, so a phrase's text is written once.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import pick, settle, small_batches, stretches
from riskloom.llm.exchange import pack_places, pack_words, packed, unpack_places, unpack_words, unpacked
from riskloom.session import fresh_dir

#: Bytes of text in a batch, unless one piece has more.
BATCH_BYTES = 16 << 20
#: Bytes of text for which there is one shard of phrases.
SHARD_BYTES = 8 << 20
#: Rows that are handed on at a time.
STEP = 1 << 16
#: Parts in which the best phrases of a language are first looked for.
TOP_PARTS = 16

# The language of texts without one.
NO_LANGUAGE = "und"

_BREAK = b"\xff"  # in no UTF-8 text
_BREAKS = re.compile(rb"[.,;:!?\x0A-\x0D]")


def _translation() -> bytes:
    table = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    for c in b".,;:!?\n\x0b\x0c\r":
        table[c] = _BREAK[0]
    return bytes(table)


_TABLE = _translation()

_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

#: A batch: its languages and the first word of each, its distinct words by language, the words of
#: each distinct phrase, and the occurrences as positions and phrases. Rows with a phrase instead
#: give a phrase of ``size`` words and how often it stands in all batches, or, with size 0, the
#: number of a language's words in the batch.
SCHEMA = (
    "batch long, langs array<string>, starts array<int>, sizes binary, words binary, parts binary,"
    " at binary, which binary, lang string, size int, phrase string, n long"
)
_FIELDS = pa.schema(
    [
        ("batch", pa.int64()),
        ("langs", pa.list_(pa.string())),
        ("starts", pa.list_(pa.int32())),
        *[(c, pa.binary()) for c in ("sizes", "words", "parts", "at", "which")],
        ("lang", pa.string()),
        ("size", pa.int32()),
        ("phrase", pa.string()),
        ("n", pa.int64()),
    ]
)


class Relation:
    """The sorted occurrences of one batch: ``which[i]`` is the phrase that begins at ``at[i]``,
    and row p of ``parts`` the places of phrase p's words in ``words``."""

    def __init__(self, langs: list[str], starts: list[int], words: list[bytes], parts: np.ndarray, at: np.ndarray, which: np.ndarray):
        self.langs, self.starts, self.words = langs, np.asarray(starts, np.int32), words
        self.parts, self.at, self.which = parts, at, which

    @classmethod
    def read(cls, row: dict) -> Relation:
        words = unpack_words(row["sizes"], row["words"])
        which = unpacked(row["which"], "<u4")
        flat = unpacked(row["parts"], "<u4")
        size = row["size"]
        return cls(row["langs"], row["starts"], words, flat.reshape(-1, size), unpack_places(row["at"]), which)

    def row(self, batch: int) -> pa.RecordBatch:
        sizes, words = pack_words(self.words)
        values = [batch, self.langs, self.starts.tolist(), sizes, words, packed(np.ascontiguousarray(self.parts).ravel()), pack_places(self.at), packed(self.which), None, self.parts.shape[1], None, None]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _FIELDS)], schema=_FIELDS)

    def counts(self) -> np.ndarray:
        return np.bincount(self.which, minlength=len(self.parts))

    def languages(self) -> np.ndarray:
        """The language of each phrase, which is that of its first word."""
        return np.searchsorted(self.starts, self.parts[:, 0], side="right") - 1

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each phrase, 64 and 32 bits that depend on its words and its language."""
        seeds = [xxhash.xxh64_intdigest(x.encode()) for x in self.langs]
        ends = [*self.starts[1:].tolist(), len(self.words)]
        each = b"".join(
            xxhash.xxh3_128_digest(w, seed)
            for seed, start, end in zip(seeds, self.starts.tolist(), ends)
            for w in self.words[start:end]
        )
        lanes = np.frombuffer(each, "<u8").reshape(-1, 2)
        mixed = []
        for lane, factor in zip(lanes.T, _FACTORS):
            x = np.zeros(len(self.parts), np.uint64)
            for k in range(self.parts.shape[1]):
                x = (x ^ x >> np.uint64(29)) * factor + lane[self.parts[:, k]]
            mixed.append((x ^ x >> np.uint64(32)) * factor)
        return mixed[0], (mixed[1] >> np.uint64(32)).astype(np.uint32)

    def sorted_hashes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The phrases in order of their hashes, and the hashes."""
        long, short = self.hashes()
        order = np.lexsort((short, long))
        return order, long[order], short[order]

    def only(self, alive: np.ndarray) -> Relation:
        """The relation of the phrases that ``alive`` marks, without words that stand in none of them."""
        parts = self.parts[alive]
        used = np.zeros(len(self.words), bool)
        used[parts.ravel()] = True
        place = np.cumsum(used) - 1
        starts = np.r_[0, np.cumsum(used)][self.starts]
        stays = alive[self.which]
        number = (np.cumsum(alive) - 1).astype(np.uint32)
        return Relation(
            self.langs,
            starts,
            [self.words[i] for i in np.flatnonzero(used)],
            place[parts].astype(np.uint32),
            self.at[stays],
            number[self.which[stays]],
        )

    def extended(self) -> Relation:
        """The merge-join of the relation with itself on adjacent positions."""
        next_to = np.flatnonzero(self.at[1:] == self.at[:-1] + 1)
        pairs = self.which[next_to].astype(np.uint64) << np.uint64(32) | self.which[next_to + 1]
        distinct, which = np.unique(pairs, return_inverse=True)
        left, right = (distinct >> np.uint64(32)).astype(np.int64), (distinct & np.uint64(0xFFFFFFFF)).astype(np.int64)
        parts = np.column_stack([self.parts[left], self.parts[right, -1:]])
        return Relation(self.langs, self.starts, self.words, parts, self.at[next_to], which.astype(np.uint32))

    def phrases(self, batch: int, which: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A row for each of some phrases, and how often it stands in all batches."""
        texts = pa.array(self.words, pa.binary()).cast(pa.string())
        langs, lang = pa.array(self.langs, pa.string()), self.languages()
        for k in range(0, len(which), STEP):
            some = which[k : k + STEP]
            columns = [texts.take(pa.array(c)) for c in self.parts[some].T]
            phrase = pc.binary_join_element_wise(*columns, " ") if len(columns) > 1 else columns[0]
            yield _phrase_rows(batch, langs.take(pa.array(lang[some])), len(columns), phrase, n[k : k + STEP])


def _phrase_rows(batch: int, lang: pa.Array, size: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    m = len(n)
    known = {"batch": pa.array([batch] * m, pa.int64()), "lang": lang, "size": pa.array([size] * m, pa.int32()), "phrase": phrase, "n": pa.array(n, pa.int64())}
    return pa.RecordBatch.from_arrays([known.get(f.name, pa.nulls(m, f.type)) for f in _FIELDS], schema=_FIELDS)


PACKET = "batch long, shard int, long binary, short binary, n binary"
REPLY = "batch long, shard int, alive binary, first binary, n binary"


def packets(batch: int, relation: Relation, shards: int) -> Iterator[pa.RecordBatch]:
    """The batch's distinct phrases with their numbers, dealt to shards by the upper bits of their hashes."""
    order, long, short = relation.sorted_hashes()
    n = relation.counts()[order].astype(np.uint32)
    bounds = np.array([(i << 64) // shards for i in range(1, shards)], np.uint64)
    cuts = [0, *np.searchsorted(long, bounds).tolist(), len(long)]
    for shard, (start, end) in enumerate(zip(cuts, cuts[1:])):
        if start < end:
            columns = pack_places(long[start:end]), packed(short[start:end]), packed(n[start:end])
            values = [pa.array([batch], pa.int64()), pa.array([shard], pa.int32()), *(pa.array([c], pa.binary()) for c in columns)]
            yield pa.RecordBatch.from_arrays(values, names=["batch", "shard", "long", "short", "n"])


def count_shard(rows: pa.Table, min_count: int) -> pa.Table:
    """For each packet of a shard, as bits by place: whether a phrase is frequent, and whether this
    packet is the first to have it, then with its number over all packets."""
    rows = rows.sort_by("batch")
    long = [np.cumsum(unpacked(x.as_py(), "<u8"), dtype=np.uint64) for x in rows["long"]]
    short = np.concatenate([unpacked(x.as_py(), "<u4") for x in rows["short"]])
    n = np.concatenate([unpacked(x.as_py(), "<u4") for x in rows["n"]]).astype(np.int64)
    ends = np.cumsum([len(x) for x in long])
    long = np.concatenate(long)
    # stable, so that within a phrase the packets keep their order
    order = np.lexsort((short, long))
    long, short = long[order], short[order]
    begins = np.flatnonzero(np.r_[True, (long[1:] != long[:-1]) | (short[1:] != short[:-1])])
    total = np.add.reduceat(n[order], begins)
    frequent = total >= min_count
    alive, met = np.zeros(len(order), bool), np.zeros(len(order), np.int64)
    alive[order] = np.repeat(frequent, np.diff(np.r_[begins, len(order)]))
    met[order[begins]] = np.where(frequent, total, 0)
    out = []
    for at, start, end in zip(range(rows.num_rows), [0, *ends.tolist()], ends.tolist()):
        own = met[start:end]
        bits = [np.packbits(x).tobytes() for x in (alive[start:end], own > 0)]
        out.append((rows["batch"][at].as_py(), rows["shard"][at].as_py(), *bits, packed(own[own > 0])))
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["batch", "shard", "alive", "first", "n"])


def answered(relation: Relation, replies: pa.Table, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which phrases of a batch are frequent, which of them it is the first to have, and their numbers."""
    order, long, _ = relation.sorted_hashes()
    bounds = np.array([(i << 64) // shards for i in range(1, shards)], np.uint64)
    sizes = np.diff([0, *np.searchsorted(long, bounds).tolist(), len(long)])
    replies = replies.sort_by("shard")

    def bits(name: str) -> np.ndarray:
        parts = zip(replies["shard"].to_pylist(), replies[name])
        found = [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=sizes[k]) for k, x in parts]
        return np.concatenate(found).astype(bool) if found else np.empty(0, bool)

    alive = np.zeros(len(order), bool)
    alive[order] = bits("alive")
    numbers = [unpacked(x.as_py(), "<i8") for x in replies["n"]]
    return alive, order[bits("first")], np.concatenate(numbers) if numbers else np.empty(0, np.int64)


class _Pile:
    """A batch in the making: each language has its own words, numbered in one row."""

    def __init__(self) -> None:
        self.size, self.next = 0, count(1).__next__
        self.places: dict[str, defaultdict[bytes, int]] = {}
        self.sequence = array("I", [0])

    def add(self, lang: str, text: bytes) -> None:
        if lang not in self.places:
            self.places[lang] = defaultdict(self.next, {_BREAK: 0})
        tokens = text.translate(_TABLE).replace(_BREAK, b" \xff ").split()
        self.sequence.extend(array("I", map(self.places[lang].__getitem__, tokens)))
        self.sequence.append(0)
        self.size += len(text)

    def rows(self, batch: int) -> Iterator[pa.RecordBatch]:
        langs = list(self.places)
        words, starts, place = [], [], np.zeros(self.next(), np.uint32)
        for lang in langs:
            own = self.places[lang]
            del own[_BREAK]
            starts.append(len(words))
            place[np.fromiter(own.values(), np.int64, len(own))] = np.arange(len(words), len(words) + len(own))
            words.extend(own)
        sequence = np.frombuffer(self.sequence, np.uint32)
        at = np.flatnonzero(sequence).astype(np.uint32)
        which = place[sequence[at]]
        made = Relation(langs, starts, words, np.arange(len(words), dtype=np.uint32)[:, None], at, which)
        whole = np.bincount(made.languages()[which], minlength=len(langs))
        yield _phrase_rows(batch, pa.array(langs, pa.string()), 0, pa.array([""] * len(langs)), whole)
        yield made.row(batch)


class _Steps:
    """Relations written one after the other, each dealt by batch; the one before can go then."""

    def __init__(self, spark, buckets: int):
        self.spark, self.buckets, self.name, self.paths = spark, buckets, None, []

    def write(self, rows: DataFrame) -> DataFrame:
        """The written rows that hold relations."""
        name, path = f"occurrences_{uuid.uuid4().hex}", fresh_dir(self.spark, "occurrences")
        rows.write.bucketBy(self.buckets, "batch").option("path", path).saveAsTable(name)
        self.drop()
        self.name = name
        self.paths.append(path)
        return self.spark.table(name).where(F.col("phrase").isNull()).drop("lang", "phrase", "n")

    def drop(self) -> None:
        """Take the last table out of the catalog; its files stay."""
        if self.name:
            self.spark.sql(f"DROP TABLE {self.name}")
            self.name = None

    def phrases(self) -> DataFrame:
        own = [self.spark.read.schema(SCHEMA).parquet(p).select("lang", "size", "phrase", "n") for p in self.paths]
        rows = own[0]
        for other in own[1:]:
            rows = rows.unionByName(other)
        return rows.where(F.col("phrase").isNotNull())


def phrase_counts(
    docs: DataFrame, min_count: int = 10, max_words: int = 3, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """(lang, size, phrase, f): every phrase of 1 to ``max_words`` words that stands at least
    ``min_count`` times within pieces of a language's texts, and, as the phrase "" of size 0, the
    number of all words of a language.

    Null texts are empty; texts without a language belong to ``und``. Repeated rows count again.
    Languages without words have 0 words; an empty table gives no rows. Other columns stay out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = pick(docs, lang=lang, text=text).select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BATCH_BYTES)
    steps = _Steps(spark, min(buckets, 100_000))

    def first(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, pile = TaskContext.get().partitionId(), 0, _Pile()
        for b in it:
            for name, cell in zip(b.column(0).to_pylist(), b.column(1)):
                for some in stretches(cell.as_py(), _BREAKS):
                    pile.add(name, some)
                    if pile.size >= BATCH_BYTES:
                        yield from pile.rows((part << 32) + nth)
                        pile, nth = _Pile(), nth + 1
        if pile.places:
            yield from pile.rows((part << 32) + nth)

    def sent(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for row in b.to_pylist():
                yield from packets(row["batch"], Relation.read(row), shards)

    def reduced(size: int):
        def batch(key: tuple, relation: pa.Table, replies: pa.Table) -> pa.Table:
            number, made = key[0].as_py(), []
            for row in relation.to_pylist():
                own = Relation.read(row)
                alive, first, n = answered(own, replies, shards)
                made.extend(own.phrases(number, first, n))
                if size < max_words:
                    made.append(own.only(alive).extended().row(number))
            return pa.Table.from_batches(made, schema=_FIELDS)

        return batch

    relation = steps.write(own.mapInArrow(first, SCHEMA))
    for size in range(1, max_words + 1):
        counts = relation.mapInArrow(sent, PACKET).groupBy("shard")
        replies = counts.applyInArrow(lambda rows: count_shard(rows, min_count), REPLY)
        rows = relation.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(reduced(size), SCHEMA)
        relation = steps.write(rows)
    steps.drop()
    found = steps.phrases()
    whole = found.where("size = 0").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f"))
    return settle(whole.unionByName(found.where("size > 0").withColumnRenamed("n", "f")), "phrases")


def collocations(
    docs: DataFrame,
    min_count: int = 10,
    max_words: int = 3,
    top: int = 2000,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``max_words`` words of
    each language whose words stand together most exclusively.

    A phrase seen ``a`` times, cut into a first part seen ``l`` and a rest seen ``r`` times, scores
    floor(1000000 * a * a / (l * r)); its worst cut counts, of equal ones the first. Phrases inside a
    longer frequent one that has at least half of their occurrences are left out. Ties of the score
    go to the larger ``a``, then to the phrase that is less in UTF-8 bytes; ``n`` is the language's
    number of words. Nulls, empty texts, repeated rows and empty tables are as in
    ``phrase_counts``; a language without such phrases gives no row.
    """
    counts = phrase_counts(docs, min_count, max_words, lang, text)
    total = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    known = counts.where("size > 0")
    words = F.split("phrase", " ")
    candidates = known.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("w"))

    def stretch(first, length):
        return F.array_join(F.slice("w", first, length), " ")

    cuts = candidates.select(
        "lang", "phrase", "size", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select("lang", "phrase", "size", "a", "k", stretch(F.lit(1), F.col("k")).alias("left"), stretch(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    part = known.select("lang", F.col("phrase").alias("part"), F.col("f"))
    cuts = cuts.join(part.withColumnsRenamed({"part": "left", "f": "l"}), ["lang", "left"])
    cuts = cuts.join(part.withColumnsRenamed({"part": "right", "f": "r"}), ["lang", "right"])
    score = F.expr("(1000000BD * CAST(a AS DECIMAL(15, 0)) * CAST(a AS DECIMAL(15, 0))) DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    worst = (
        cuts.withColumn("score", score)
        .groupBy("lang", "phrase", "size", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    inner = (
        candidates.where("size > 2")
        .select("lang", "size", "a", "w", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
        .select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("i"))
        .groupBy("lang", stretch(F.col("i"), F.col("m")).alias("phrase"))
        .agg(F.max("a").alias("longer"))
    )
    own = worst.join(inner, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 50 * a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))).orderBy(order)
    best = own.withColumn("_near", F.row_number().over(near)).where(F.col("_near") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(order)).cast("long"))
    rows = ranked.where(F.col("rank") <= top).join(total, "lang")
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
