"""Language identification by character language models.

Each language has an interpolated Kneser-Ney model of ORDER characters. All models share one table
per order: hashed n-grams in a sorted array, and beside it the log probability and the weight as a
context for every language. A text goes to the language with the lowest cross-entropy per
character. How far the second is behind tells, by a calibrated curve, how likely that is right;
texts that are unlike any language, or too close to call, are marked as rejected.

The models are fitted on a bounded sample of labelled rows: at most PER_LANGUAGE by hash of the id
for each language, a fifth of them set aside to calibrate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import pick, settle, small_batches
from riskloom.llm.letters import codes, fold_table, single_spaces

ORDER = 4
#: Labelled rows per language that are fitted on, at most.
PER_LANGUAGE = 1_000
#: Languages that are learned, the most frequent first.
LANGUAGES = 200
DISCOUNT = 0.75
#: Share of the calibration texts in their own language that may cost more than the limit.
REJECT = 0.005
#: Characters that are scored at a time.
PIECE = 1 << 18
UNKNOWN = "und"

_HASH = np.uint64(0x9E3779B97F4A7C15)


def grams(text: str) -> np.ndarray | None:
    """ORDER-grams of a text folded to lower-case letters and single spaces, 16 bits a character.

    The text stands between spaces, with more in front, so that each character closes one gram.
    None if there is no letter. Characters past the first 65,536 are folded into them.
    """
    points = single_spaces(np.take(fold_table(False), codes(text)))
    if not points.size:
        return None
    points = np.where(points < 1 << 16, points, 0xE000 + (points & 0x7FF)).astype(np.uint64)
    space = np.uint64(0x20)
    line = np.concatenate([np.full(ORDER - 1, space), points, np.full(1, space)])
    out = np.zeros(line.size - ORDER + 1, np.uint64)
    for k in range(ORDER):
        out = out << np.uint64(16) | line[k : k + out.size]
    return out


def _lower(keys: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` characters."""
    return keys & np.uint64((1 << 16 * order) - 1) if order < 4 else keys


@dataclass
class Table:
    """N-grams of one order by sorted hash; log probability and context weight per language."""

    hashes: np.ndarray
    logp: np.ndarray
    bow: np.ndarray

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places, and whether the n-gram is there. The hash is one to one."""
        h = keys * _HASH
        at = np.minimum(np.searchsorted(self.hashes, h), max(0, self.hashes.size - 1))
        return at, (self.hashes[at] == h) if self.hashes.size else np.zeros(keys.size, bool)


@dataclass
class Model:
    languages: list[str]
    tables: list[Table]
    floor: float
    root: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    limit: float = np.inf

    def logp(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of the last character after the others, for each gram and language."""
        if order == 0:
            return np.full((keys.size, len(self.languages)), self.floor)
        table = self.tables[order - 1]
        at, there = table.find(_lower(keys, order))
        if there.all():
            return table.logp[at]
        out = table.logp[at] if table.hashes.size else np.empty((keys.size, len(self.languages)))
        miss = np.flatnonzero(~there)
        rest = self.logp(keys[miss], order - 1)
        if order > 1:
            context = self.tables[order - 2]
            where, known = context.find(_lower(keys[miss] >> np.uint64(16), order - 1))
            rest = rest + np.where(known[:, None], context.bow[where], 0.0)
        else:
            rest = rest + self.root
        out[miss] = rest
        return out

    def costs(self, text: str) -> tuple[np.ndarray, int] | None:
        """Cross-entropy per character in each language, and the number of characters."""
        keys = grams(text)
        if keys is None:
            return None
        total = np.zeros(len(self.languages))
        for k in range(0, keys.size, PIECE):
            total -= self.logp(keys[k : k + PIECE]).sum(axis=0, dtype=np.float64)
        return total / keys.size, keys.size

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability that it is right, and whether that is too little."""
        found = self.costs(text) if text and self.languages else None
        if found is None:
            return UNKNOWN, 0.0, True
        cost, n = found
        best = int(np.argmin(cost))
        lead = _lead(cost, n)
        p = float(1 / (1 + np.exp(-np.clip(self.offset + self.slope * lead, -50, 50))))
        return self.languages[best], p, bool(p < 0.5 or cost[best] > self.limit)


def _lead(cost: np.ndarray, n: int) -> float:
    """How much likelier the best language is than the second, on a scale that grows slowly."""
    if cost.size < 2:
        return float(np.log1p(n))
    first, second = np.partition(cost, 1)[:2]
    return float(np.log1p((second - first) * n))


def _sample(docs: DataFrame, per_language: int) -> DataFrame:
    """(lang, text, calibrate): at most ``per_language`` rows of each language, by hash of the id."""
    ids = docs.select("doc_id", "lang").where("lang IS NOT NULL AND doc_id IS NOT NULL").distinct()
    often = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    place = F.xxhash64("doc_id")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(place, "doc_id"))
    # the lowest hashes of a language are among those below a bound that twice as many fall under
    share = F.least(F.lit(1.0), (2.0 * per_language + 100) / F.col("count"))
    low = place.cast("double") <= share * 2.0**64 - 2.0**63
    some = ids.join(F.broadcast(often), "lang").where(low).withColumn("nth", nth).where(F.col("nth") <= per_language)
    some = settle(some.select("doc_id", "lang", (F.col("nth") % 5 == 0).alias("calibrate")), "sample")
    # at most LANGUAGES * per_language rows of an id and a language
    texts = docs.where("text IS NOT NULL").select("doc_id", "lang", "text").join(F.broadcast(some), ["doc_id", "lang"])
    return settle(texts.select("lang", "calibrate", "text"), "sample-texts")


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE
) -> Model:
    """Models of all languages that ``docs`` names; rows with a null id, text or language teach nothing."""
    own = pick(docs, doc_id=doc_id, text=text, lang=lang)
    texts = _sample(own, per_language)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            by: dict[str, list[np.ndarray]] = {}
            for l, t in zip(b.column(0).to_pylist(), b.column(1)):
                keys = grams(t.as_py())
                if keys is not None:
                    by.setdefault(l, []).append(keys)
            for l, some in by.items():
                keys, n = np.unique(np.concatenate(some), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([l] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"]
                )

    counts = (
        texts.where("NOT calibrate").select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    table = counts.toArrow()  # distinct grams of the bounded sample
    langs = np.array(table["lang"].to_pylist(), object)
    model = build(
        sorted(set(langs)), langs, table["gram"].to_numpy().view(np.uint64), table["n"].to_numpy().astype(np.float64)
    )
    return _calibrated(model, texts.where("calibrate").select("lang", "text"))


def build(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """Interpolated Kneser-Ney models from the counts of ORDER-grams by language."""
    every, seen = [], []
    for k, name in enumerate(languages):
        mine = lang == name
        here = {ORDER: dict_of(gram[mine], n[mine])}
        for order in range(ORDER - 1, 0, -1):
            # how many different characters stand in front
            keys, _ = here[order + 1]
            shorter, spread = np.unique(_lower(keys, order), return_counts=True)
            here[order] = (shorter, spread.astype(np.float64))
        seen.append(here)
    for order in range(1, ORDER + 1):
        parts = [h[order][0] for h in seen]
        if order < ORDER:
            # contexts too, as the padding of a text's first gram closes none itself
            parts += [h[order + 1][0] >> np.uint64(16) for h in seen]
        every.append(np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64))
    letters = max(2, every[0].size + 1)
    model = Model(languages, [], float(-np.log(letters)), np.zeros(len(languages)))
    for order in range(1, ORDER + 1):
        keys = every[order - 1]
        by_hash = np.argsort(keys * _HASH)
        keys = keys[by_hash]
        logp = np.zeros((keys.size, len(languages)), np.float32)
        # lower orders are complete, so what they say holds for every n-gram of this one
        below = np.exp(model.logp(keys, order - 1).astype(np.float64))
        for k in range(len(languages)):
            grams_k, n_k = seen[k][order]
            contexts, inverse = np.unique(grams_k >> np.uint64(16), return_inverse=True)
            total = np.bincount(inverse, n_k, contexts.size)
            kinds = np.bincount(inverse, minlength=contexts.size)
            left = DISCOUNT * kinds / np.maximum(total, 1)
            at = np.minimum(np.searchsorted(contexts, keys >> np.uint64(16)), max(0, contexts.size - 1))
            known = contexts[at] == keys >> np.uint64(16) if contexts.size else np.zeros(keys.size, bool)
            mine = np.minimum(np.searchsorted(grams_k, keys), max(0, grams_k.size - 1))
            have = grams_k[mine] == keys if grams_k.size else np.zeros(keys.size, bool)
            own = np.where(have, np.maximum(n_k[mine] - DISCOUNT, 0), 0) / np.where(known, total[at], 1)
            logp[:, k] = np.log(own + np.where(known, left[at], 1.0) * below[:, k])
            if order > 1:
                # the weight of the context, for grams that no language has
                table = model.tables[order - 2]
                place, there = table.find(contexts)
                table.bow[place[there], k] = np.log(np.maximum(left[there], 1e-30))
            elif left.size:
                model.root[k] = np.log(np.maximum(left[0], 1e-30))
        model.tables.append(Table(keys * _HASH, logp, np.zeros_like(logp)))
    return model


def dict_of(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    return keys[order], n[order]


def _calibrated(model: Model, texts: DataFrame) -> Model:
    """The curve from lead to probability, and the limit of cost, from texts that were set aside."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def test(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in it:
            rows = []
            for l, t in zip(b.column(0).to_pylist(), b.column(1)):
                if m.languages and (found := m.costs(t.as_py())) is not None:
                    cost, n = found
                    best = int(np.argmin(cost))
                    rows.append((_lead(cost, n), m.languages[best] == l, float(cost[best])))
            columns = list(zip(*rows)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.float64()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.float64())],
                names=["lead", "right", "cost"],
            )

    rows = texts.mapInArrow(test, "lead double, right boolean, cost double").collect()
    if not rows:
        return model
    lead = np.array([r.lead for r in rows])
    right = np.array([r.right for r in rows], float)
    # soft targets keep the curve finite where all or none are right
    target = np.where(right == 1, (right.sum() + 1) / (right.sum() + 2), 1 / (len(rows) - right.sum() + 2))
    a, b = 0.0, 1.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * lead, -30, 30)))
        g, w = target - p, p * (1 - p) + 1e-6
        step = np.linalg.solve(
            np.array([[w.sum(), (w * lead).sum()], [(w * lead).sum(), (w * lead * lead).sum()]]) + 1e-3 * np.eye(2),
            np.array([g.sum(), (g * lead).sum()]),
        )
        a, b = a + np.clip(step[0], -1, 1), b + np.clip(step[1], -1, 1)
    model.offset, model.slope = float(a), float(max(b, 0.0))
    kept = np.array([r.cost for r in rows if r.right])
    if kept.size:
        model.limit = float(np.quantile(kept, 1 - REJECT))
    return model


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected): one row per row of ``docs``; whole texts are scored.

    Null texts and texts without a letter get ``und`` with score 0, and so does everything if no
    language was learned. Null ids and repeated rows each get their row; an empty table gives none.
    """
    small_batches(docs.sparkSession)
    own = pick(docs, doc_id=doc_id, text=text)
    kind = own.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # n-grams of the bounded sample

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in it:
            found = [model.judge(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([x for x, _, _ in found], pa.string()),
                    pa.array([x for _, x, _ in found], pa.float64()),
                    pa.array([x for _, _, x in found], pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    return own.mapInArrow(batch, f"doc_id {kind}, lang_pred string, score double, rejected boolean")
