"""URL filter: rules first, then naive Bayes over the words of host and path.

Host names run words together. A unigram model of words, counted over all page texts, splits them
by the Viterbi algorithm; a name only needs the counts of its own substrings, which a join brings.
A multinomial naive Bayes model then scores the words of host and path. It learns from the URLs that
a rule judges; words that name what is unwanted (SEEDS) come in as a prior, as if they had been seen
in blocked URLs, and what is seen can overrule them.

Hosts and paths are reduced to their distinct forms before anything is joined, so a host that
holds a third of all pages costs one row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ascii_lower, pick, settle

#: Words that name advertising, gambling, adult content, pills or spam.
SEEDS = [
    "ad", "ads", "adult", "bet", "bets", "bingo", "casino", "escort", "gambling", "jackpot", "loans",
    "malware", "phishing", "pill", "pills", "poker", "porn", "scam", "sex", "slots", "spam", "track",
    "tracker", "viagra", "warez", "xxx",
]
#: Characters of a word that the model may know; a longer run is put together from such words.
LONGEST = 20
#: A host name's part is at most 63 characters; longer ones are no names and stay whole.
NAME = 63
#: Occurrences from which a word counts as one; seeds always do.
MIN_COUNT = 3
SMOOTHING = 1.0
#: Words of the blocked URLs that the seeds together stand for, for each word that is seen there.
SEED_SHARE = 0.25
#: A form that more than one page in so many has is sent to the pages; at most so many are.
HEAVY = 1000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if the url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits.

    A rule is a host, then from the first slash a path. It fits the host and its subdomains where
    the path starts with the rule's. Of two that are equally long the one with the longer host wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), len(r[0].split("/")[0]), r)):
        name, slash, rest = text.partition("/")
        name = name.lower()
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """(word, n) over all texts: runs of a-z of up to LONGEST characters, markup left out."""
    plain = F.regexp_replace(ascii_lower(F.col(text)), r"<[^>]*>", " ")
    words = F.explode(F.split(plain, "[^a-z]+")).alias("word")
    counts = texts.select(words).where((F.length("word") > 0) & (F.length("word") <= LONGEST))
    return counts.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def viterbi(name: str, cost: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """The cheapest split of a name; of equally cheap ones, that with the shorter last word.

    ``cost`` gives the words that the model knows by start and end. Any other stretch costs
    ``unknown`` for each of its characters, and once more.
    """
    best, back = [0.0] + [math.inf] * len(name), [0] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        for start in range(end - 1, max(-1, end - 1 - LONGEST), -1):
            c = best[start] + cost.get((start, end), unknown * (end - start + 1))
            if c < best[end] - 1e-12:
                best[end], back[end] = c, start
    out, end = [], len(name)
    while end:
        out.append(name[back[end] : end])
        end = back[end]
    return out[::-1]


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words): distinct names of a-z split into words of ``counts``."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    starts = F.sequence(F.lit(1), F.length("name"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("name") - F.col("start") + 1))
    spans = (
        names.withColumn("start", F.explode(starts))
        .withColumn("size", F.explode(sizes))
        .select("name", "start", "size", F.col("name").substr(F.col("start"), F.col("size")).alias("word"))
    )
    known = spans.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("start", "size", "n")).alias("known"))
    unknown = math.log(total) + 1.0

    def split(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            for name, some in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                cost = {(x["start"] - 1, x["start"] - 1 + x["size"]): math.log(total / x["n"]) for x in some or []}
                out.append(viterbi(name, cost, unknown))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.string()))], names=["name", "words"])

    return names.join(known, "name", "left").select("name", "known").mapInArrow(split, "name string, words array<string>")


def _runs(text: Column) -> Column:
    """Runs of letters and digits; a run of digits only tells how long it is."""
    runs = F.filter(F.split(ascii_lower(text), r"[^a-z0-9\x{80}-\x{10FFFF}]+"), lambda x: F.length(x) > 0)
    return F.transform(runs, lambda x: F.when(x.rlike("^[0-9]+$"), F.concat(F.lit("#"), F.length(x))).otherwise(x))


def url_filter(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    page_id: str = "page_id",
    url: str = "url",
    text: str | None = "html",
    held_out: Column | None = None,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): one row per row of ``pages``.

    ``verdict`` is the rule's where one fits, else ``block`` if naive Bayes finds that likelier than
    ``allow``; ``score`` is its log odds of ``block``. A null url, or one without ``://``, has neither host
    nor path and no words, so the classes' sizes decide; a tie allows. Null ids and repeated rows each get
    their row; an empty table gives none. Where no rule judges any URL, only the seeds speak.
    ``held_out``, a condition on page_id and url, names URLs whose rules teach nothing.
    """
    own = pick(pages, page_id=page_id, url=url)
    host, path = host_and_path(F.col("url"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    form = F.concat_ws(" ", _runs(F.col("path")))
    aside = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    judged = own.select("page_id", host.alias("host"), path.alias("path"), aside.alias("aside")).select(
        "page_id", "host", "path", "aside", rule.alias("rule"), verdict.alias("said"), form.alias("form")
    )
    # forms hold no line ends
    key = F.sha2(F.concat_ws("\n", "form", "host"), 256)
    judged = judged.withColumns({"teaches": F.when(~F.col("aside"), F.col("said")), "key": key})
    # distinct hosts with the words of their paths, and how many pages of them a rule blocks or allows
    shapes = judged.groupBy("host", "form").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("teaches") == "block").alias("b"), F.count_if(F.col("teaches") == "allow").alias("a"))
    shapes = settle(shapes, "shapes")
    hosts = shapes.select("host").distinct()
    runs = hosts.select("host", F.posexplode(_runs(F.col("host"))).alias("at", "run"))
    names = runs.where(F.col("run").rlike("^[a-z]+$") & (F.length("run") <= NAME)).select(F.col("run").alias("name")).distinct()
    seeds = pages.sparkSession.createDataFrame([(w, MIN_COUNT) for w in SEEDS], "word string, n long")
    texts = word_counts(pages, text).unionByName(seeds) if text else seeds
    counts = texts.groupBy("word").agg(F.sum("n").alias("n"))
    split = settle(segmented(names, settle(counts, "words")), "names")
    host_words = (
        runs.join(split, F.col("run") == F.col("name"), "left")
        .select("host", "at", F.coalesce("words", F.array("run")).alias("words"))
        .groupBy("host")
        .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("host_words"))
    )
    path_words = F.filter(F.split("form", " "), lambda x: x != "")
    tokens = F.concat(F.coalesce("host_words", F.array().cast("array<string>")), path_words)
    words = settle(shapes.join(host_words, "host", "left").select("host", "form", "n", "b", "a", tokens.alias("words")), "shape-words")
    scores = settle(naive_bayes(words).withColumn("key", key).select("key", "n", "score"), "shape-scores")
    pages_in_all = scores.agg(F.sum("n")).first()[0] or 0
    heavy = scores.where(F.col("n") * HEAVY > pages_in_all).select("key", "score")
    lighter = judged.join(F.broadcast(heavy.select("key")), "key", "left_anti").join(scores.select("key", "score"), "key")
    scored = judged.join(F.broadcast(heavy), "key").unionByName(lighter)
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("said", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
        "score",
    )


def naive_bayes(shapes: DataFrame) -> DataFrame:
    """(host, form, n, score): log odds of ``block`` for each distinct form.

    ``b`` and ``a`` say how many of its n pages are known to be blocked and allowed. A word that is
    neither in those nor a seed says nothing, but belongs to the words that smoothing counts.
    """
    seen = shapes.select("b", "a", F.explode("words").alias("word")).groupBy("word").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    seen = settle(seen, "word-classes")
    sums = seen.agg(F.sum("b").alias("b"), F.sum("a").alias("a")).first()
    pages = shapes.agg(F.sum("b").alias("b"), F.sum("a").alias("a")).first()
    each = max(1.0, SEED_SHARE * (sums.b or 0) / len(SEEDS))
    seeds = shapes.sparkSession.createDataFrame([(w, each, 0.0) for w in SEEDS], "word string, b double, a double")
    both = seen.unionByName(seeds).groupBy("word").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    size = both.count()
    prior = math.log(((pages.b or 0) + 1) / ((pages.a or 0) + 1))
    total_b, total_a = (sums.b or 0) + each * len(SEEDS) + SMOOTHING * size, (sums.a or 0) + SMOOTHING * size
    says = F.log((F.col("b") + SMOOTHING) / total_b) - F.log((F.col("a") + SMOOTHING) / total_a)
    exploded = shapes.select("host", "form", "n", F.explode_outer("words").alias("word"))
    scored = exploded.join(both.where("b > 0 OR a > 0").select("word", says.alias("says")), "word", "left")
    return scored.groupBy("host", "form", "n").agg((F.coalesce(F.sum("says"), F.lit(0.0)) + F.lit(prior)).alias("score"))
