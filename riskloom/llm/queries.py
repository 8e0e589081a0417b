"""One registered query per operator of this package, with SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.bindings import table
from riskloom.llm import (
    bpe,
    decontaminate,
    filter_audit,
    language,
    line_dedup,
    maxent,
    near_dedup,
    phrases,
    pretokens,
    token_counts,
    topk,
    toxicity,
    url_filter,
    word_bpe,
)
from riskloom.llm.common import in_fold
from riskloom.queries import query

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = public_tokenizers.path("byte_bpe_50k.json")

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op3_decontamination",
    f"""WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, list_slice(w, i + 1, i + 10) AS w
                FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)),
        size AS (SELECT DISTINCT len(w) AS n FROM win),
        doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
        cut AS (SELECT r, n, unnest(range(0, len(w) - n + 1)) AS i, w FROM doc, size WHERE len(w) >= n),
        hit AS (SELECT c.r, c.i, c.n, win.item_id
                FROM (SELECT r, i, n, list_slice(w, i + 1, i + n) AS w FROM cut) c JOIN win ON c.w = win.w),
        place AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
        named AS (SELECT r, list_sort(list_distinct(list(item_id::VARCHAR))) AS ids FROM hit GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(len(ids), 0)::BIGINT AS n_items,
               sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN place USING (r) LEFT JOIN named USING (r)""",
)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that lie in windows of the benchmark."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents and what they decode to, as digests."""
    ranks = pretokens.load_ranks(RANKS)
    tokens = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(tokens, ranks)


@query(
    "op7_topk",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
                  WHERE embedding IS NOT NULL
                    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score
              FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
        r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
                     vec_id, score FROM s)
        SELECT * FROM r WHERE rank <= 5""",
)
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners of every fiftieth vector among all vectors."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents."""
    with open(MODEL, encoding="utf-8") as f:
        model = f.read()
    return token_counts.token_counts(table(spark, sf_dir, "documents"), model, public_tokenizers.PATTERN)


@query("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that stand elsewhere before, as a digest."""
    kept = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near copies of every document."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


@query("op1_url_filter")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the urls of all pages."""
    return url_filter.url_filter(table(spark, sf_dir, "pages"), RULES)


@query("op2_language")
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those outside the fold."""
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 3, 1)
    model = language.fit(docs.where(~held_out))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels outside the fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    model = toxicity.fit(docs, labels.where(~held_out))
    return toxicity.toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op6_lm_scores")
def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents, learned from those outside the fold."""
    held_out = in_fold(F.col("doc_id"), 7, 2)
    scores = maxent.lm_scores(table(spark, sf_dir, "documents"), ~held_out)
    return scores.withColumn("held_out", held_out)


_PIECES = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'), lambda x: x <> '')"


@query(
    "op11_phrases",
    rf"""WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS p FROM documents),
        w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
        total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
        f AS (SELECT lang, size, phrase, count(*) AS f FROM (
                SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase FROM (
                  SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS size)
                  WHERE len(w) >= size))
              GROUP BY ALL HAVING count(*) >= 10),
        c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
        cut AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
                FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
        scored AS (SELECT cut.lang, cut.phrase, a, k, x.f AS l, y.f AS r,
                          (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
                   FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = lp JOIN f y ON y.lang = cut.lang AND y.phrase = rp),
        worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        longer AS (SELECT lang, phrase, max(a) AS m FROM (
                     SELECT lang, a, array_to_string(w[1:2], ' ') AS phrase FROM c WHERE size = 3
                     UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM c WHERE size = 3) GROUP BY ALL),
        own AS (SELECT worst.* FROM worst LEFT JOIN longer USING (lang, phrase) WHERE m IS NULL OR 100 * m < 50 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
               a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
        FROM own JOIN total USING (lang) QUALIFY rank <= 2000""",
)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of two and three words of every language, over all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"), min_count=10, max_words=3, top=2000)


@query(
    "op12_filter_audit",
    r"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        x AS (SELECT doc_id, part,
                     (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
                     + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT
                     + 8 * regexp_matches(t, '[#$%&*|]')::INT
                     + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS fails FROM d),
        m AS (SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic
              FROM labels GROUP BY doc_id),
        g AS (SELECT part, fails, count(*) AS n, coalesce(sum(good::INT), 0) AS good, coalesce(sum(toxic::INT), 0) AS toxic
              FROM x LEFT JOIN m USING (doc_id) GROUP BY ALL),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
        o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM l a, l b, l c, l d, l e
              WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
        s AS (SELECT filter_order, step, (1 << (ascii(filter_order[step]) - 65)) AS f,
                     list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))) AS earlier
              FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
        z AS (SELECT filter_order, step, f, coalesce(earlier, 0)::INT AS earlier FROM s),
        r AS (SELECT part, filter_order, step, f,
                     sum(CASE WHEN fails & (earlier | f) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
                     sum(CASE WHEN fails & earlier = 0 AND fails & f <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
                     sum(CASE WHEN fails & earlier <> 0 AND fails & f <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
                     sum(CASE WHEN fails = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
                     sum(CASE WHEN fails & earlier = 0 AND fails & f <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
                     sum(CASE WHEN fails & earlier = 0 AND fails & f <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
              FROM g, z GROUP BY ALL)
        SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r""",
)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters do to each source, in every order."""
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")


@query("op13_word_bpe")
def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents in the vocabulary of words, and what they decode to, as digests."""
    with open(WORD_MODEL, encoding="utf-8") as f:
        model = word_bpe.WordModel(f.read())
    return word_bpe.digests(word_bpe.encode(table(spark, sf_dir, "documents"), model), model)
