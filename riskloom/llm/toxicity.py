"""Toxicity by weak supervision.

Many voters, each a word, a word beginning or a pattern, fire on a text or do not. A generative
label model of their votes estimates by EM how often each fires on toxic and on clean texts, and
how voters hang together given the class; voters that say the same share one say. Its posterior
labels train a linear classifier, which scores texts by the voters that fire.

The classifier is fitted on a bounded sample of labelled rows, at most SAMPLE by the hash of their
id. A label is one more voter there, whose reliability the model estimates like any other's.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskloom.llm.common import fresh_name, pick, settle, small_batches

#: Labelled rows that are fitted on, at most.
SAMPLE = 20_000
#: Voters that are taken from the labelled texts, at most.
LEXICON = 300
#: How sure it must be that a word goes with a class: G^2, at 27 about one in five million by chance.
MIN_G2 = 27.0
#: Bytes of a word beginning that can be a voter.
PREFIXES = (4, 5, 6, 7, 8)
#: Score from which a document is rejected.
THRESHOLD = 0.3
ROUNDS = 30
#: Right labels that are taken for granted for each one that is seen.
TRUST = 4

#: A hand-written lexicon of insults, one voter each.
INSULTS = ["dumb", "fool", "idiot", "jerk", "loser", "moron", "scum", "stupid", "trash", "ugly"]
PATTERNS = [
    ("shouting", re.compile(r"(?:\b[A-Z]{3,}\b\W+){4}")),
    ("exclamations", re.compile(r"!{3,}")),
    ("masked", re.compile(r"\b\w+[*#@]{2,}\w*")),
    ("you are a", re.compile(r"\byou(?:'re| are) (?:a|an|such)\b", re.IGNORECASE)),
]

#: All ASCII but letters as spaces.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_set(text: str) -> set[bytes]:
    """The distinct words of a text: runs of lower-cased letters and characters beyond ASCII."""
    return set(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split())


def _features(words: set[bytes]) -> set[bytes]:
    """Words as =word, beginnings of longer words as beginning-."""
    out = {b"=" + w for w in words}
    for n in PREFIXES:
        out |= {w[:n] + b"-" for w in words if len(w) > n}
    return out


class Voters:
    """Which voters fire on a text: lexicon entries, then patterns, then the one for calm texts,
    which fires where no lexicon entry does. Who does not fire abstains."""

    def __init__(self, lexicon: list[bytes]):
        self.lexicon = lexicon
        self.seat = {f: i for i, f in enumerate(lexicon)}
        self.names = [*lexicon, *(name.encode() for name, _ in PATTERNS), b"calm"]
        self.lengths = sorted({len(f) - 1 for f in lexicon if f[:1] != b"="})

    def fired(self, text: str) -> list[int]:
        seat, out = self.seat, set()
        for w in word_set(text):
            if (at := seat.get(b"=" + w)) is not None:
                out.add(at)
            for n in self.lengths:
                if len(w) > n and (at := seat.get(w[:n] + b"-")) is not None:
                    out.add(at)
        calm = not out
        for i, (_, pattern) in enumerate(PATTERNS):
            if pattern.search(text):
                out.add(len(self.lexicon) + i)
        if calm:
            out.add(len(self.names) - 1)
        return sorted(out)


@dataclass
class LabelModel:
    """How often each voter fires given the class; ``share`` is how much of its say it keeps."""

    prior: float
    toxic: np.ndarray
    clean: np.ndarray
    share: np.ndarray
    label: tuple[float, float]

    def posterior(self, votes: np.ndarray, label: np.ndarray) -> np.ndarray:
        odds = math.log(self.prior / (1 - self.prior)) + votes @ (self.share * np.log(self.toxic / self.clean))
        right, wrong = self.label
        odds = odds + np.where(label == 1, math.log(right / wrong), math.log((1 - right) / (1 - wrong)))
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def estimate(votes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> LabelModel:
    """EM over distinct rows of votes with their label and how often they occur.

    Given the class, correlations between voters are estimated from the same posterior; a voter
    keeps 1 / (1 + sum of its positive correlations) of its say. A class without rows keeps the
    prior counts, so nothing is divided by zero.
    """
    p = np.where(label == 1, 0.95, 0.05)
    model = None
    for _ in range(ROUNDS):
        one, zero = weight * p, weight * (1 - p)
        n1, n0 = one.sum(), zero.sum()
        toxic = (votes.T @ one + 0.5) / (n1 + 1.0)
        clean = (votes.T @ zero + 0.5) / (n0 + 1.0)
        pull = np.zeros((votes.shape[1],) * 2)
        for part, mean, n in ((one, toxic, n1), (zero, clean, n0)):
            if n > 0:
                spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
                both = (votes * part[:, None]).T @ votes / n - np.outer(mean, mean)
                pull += np.maximum(0.0, both / np.outer(spread, spread)) * (n / (n1 + n0))
        np.fill_diagonal(pull, 0.0)
        right = (one[label == 1].sum() + TRUST * n1 + 1) / (n1 + TRUST * n1 + 2)
        wrong = (zero[label == 1].sum() + 1) / (n0 + TRUST * n0 + 2)
        prior = (n1 + 1.0) / (n1 + n0 + 2.0)
        model = LabelModel(prior, toxic, clean, 1 / (1 + pull.sum(axis=1)), (right, wrong))
        new = model.posterior(votes, label)
        if np.abs(new - p).max(initial=0) < 1e-6:
            break
        p = new
    return model


@dataclass
class Model:
    """The linear classifier: voters, their weights, and the intercept."""

    lexicon: list[bytes]
    weights: np.ndarray
    intercept: float

    def scorer(self):
        voters, weights = Voters(self.lexicon), self.weights.tolist()

        def score(text: str | None) -> float:
            x = self.intercept + sum(weights[i] for i in voters.fired(text or ""))
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))

        return score


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    """The classifier, from the texts that ``labels`` marks 0 or 1; other marks, null texts and null
    ids are passed over, and an id marked both ways counts as toxic. Without toxic or without clean
    rows the score is the prior of the class everywhere.
    """
    marks = pick(labels, doc_id=doc_id, toxic=toxic).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # at most `sample` rows of two numbers
    marks = settle(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "marks")
    own = pick(docs, doc_id=doc_id, text=text).where(F.col("text").isNotNull())
    texts = settle(own.join(F.broadcast(marks), "doc_id").select("text", "toxic"), "labelled")
    sums = texts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if not 0 < sums.toxic < sums.n:
        return Model([], np.zeros(len(PATTERNS) + 1), math.log((sums.toxic + 0.5) / (sums.n - sums.toxic + 0.5)))
    lexicon = _lexicon(texts, sums.n, sums.toxic)
    voters = Voters(lexicon)
    m = len(voters.names)

    def vote(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fired = [voters.fired(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(fired, pa.list_(pa.int32())), b.column(1)], names=["fired", "toxic"]
            )

    votes = settle(texts.mapInArrow(vote, "fired array<int>, toxic int"), "votes")
    kinds = votes.groupBy("fired", "toxic").count().collect()  # no more than the sample has rows
    table = np.zeros((len(kinds), m))
    for i, k in enumerate(kinds):
        table[i, k.fired] = 1
    label = np.array([k.toxic for k in kinds])
    model = estimate(table, label, np.array([k["count"] for k in kinds], float))

    def soft(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            x = np.zeros((b.num_rows, m))
            for i, some in enumerate(b.column(0).to_pylist()):
                x[i, some] = 1
            p = model.posterior(x, b.column(1).to_numpy())
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(list(x), kind), pa.array(p)], names=["x", "p"])

    rows = votes.mapInArrow(soft, "x array<double>, p double")
    sides = F.explode(
        F.array(
            F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")),
            F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight")),
        )
    )
    training = settle(rows.select("x", sides.alias("s")).select("x", "s.label", "s.weight"), "posterior")
    training = training.withColumn("features", array_to_vector("x"))
    linear = LogisticRegression(weightCol="weight", regParam=1e-6, maxIter=100, standardization=False).fit(training)
    return Model(lexicon, linear.coefficients.toArray(), float(linear.intercept))


def _lexicon(texts: DataFrame, n: int, toxic: int) -> list[bytes]:
    """Insults, and what the labelled texts show to go with toxic ones, the surest first."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            all_of, bad = Counter(), Counter()
            for t, y in zip(b.column(0), b.column(1)):
                some = _features(word_set(t.as_py()))
                all_of.update(some)
                if y.as_py():
                    bad.update(some)
            # what no toxic text has cannot go with them
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(all_of), pa.binary()),
                    pa.array(list(all_of.values()), pa.int64()),
                    pa.array([bad[f] for f in all_of], pa.int64()),
                ],
                names=["feature", "k", "bad"],
            )

    counts = texts.mapInArrow(count, "feature binary, k long, bad long")
    sums = counts.groupBy("feature").agg(F.sum("k").alias("k"), F.sum("bad").alias("bad")).where("bad > 0")
    k, bad, rate = F.col("k"), F.col("bad"), toxic / n

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    # with and without the feature, toxic and clean
    g2 = 2 * (
        term(bad, k * rate)
        + term(k - bad, k * (1 - rate))
        + term(F.lit(toxic) - bad, (F.lit(n) - k) * rate)
        + term(F.lit(n - toxic) - (k - bad), (F.lit(n) - k) * (1 - rate))
    )
    sure = sums.where((bad > 2 * rate * k) & (g2 >= MIN_G2)).orderBy(g2.desc(), "feature").limit(LEXICON)
    found = [bytes(r.feature) for r in sure.select("feature").collect()]
    return found + [f for f in (b"=" + w.encode() for w in INSULTS) if f not in found]


def with_score(docs: DataFrame, model: Model, name: str, text: str = "text") -> DataFrame:
    """All of ``docs`` and a column ``name``, from 0 to 1, higher for likelier toxic; null texts count as empty."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for b in it:
            scores = pa.array([score(t.as_py()) for t in b.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, scores], names=[*b.schema.names, name])

    return docs.mapInArrow(batch, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def toxicity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted): one row per row of ``docs``; an empty table gives none.

    predicted is 1 from THRESHOLD on. Null and empty texts get the score of a text on which no
    voter fires; null ids and repeated rows each get their row.
    """
    scored = with_score(pick(docs, doc_id=doc_id, text=text), model, "score")
    return scored.select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, whose score stays below THRESHOLD.

    Null and empty texts have the score of a text on which no voter fires; null ids and repeated
    rows are judged like any other. An empty table gives no rows. Columns of any name come along.
    """
    name = fresh_name(docs, "_toxicity")
    scored = with_score(docs, fit(docs, labels), name)
    return scored.where(F.col(name) < THRESHOLD).drop(name)
