"""Binning, evidence and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import bindings as B
from riskloom.functions.scores import rounded
from riskloom.operators import binning, evidence, profile, quantiles, sketches
from riskloom.operators.importance import permutation_importance as exchanged
from riskloom.queries import query
from riskloom.session import fresh_dir, settle

_ITEM_KEY = ", ".join(B.ITEM_KEY)
_DECILES = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"
BINS = 10

# ---- SQL shared by the checks -------------------------------------------------

DOC_FEATURES_SQL = """
features AS (
  SELECT doc_id, lang, source, n_chars,
    (length(text) - length(translate(text, ' ', ''))) / n_chars AS space_ratio,
    (length(text) - length(translate(text, '0123456789', ''))) / n_chars AS digit_ratio,
    len(list_distinct(string_split(text, ' '))) / len(string_split(text, ' ')) AS uniq_ratio,
    (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) / n_chars AS upper_ratio,
    (length(text) - length(translate(text, '.', ''))) / n_chars AS dot_ratio
  FROM documents)"""

DOCS_SQL = (
    DOC_FEATURES_SQL
    + """,
rows AS (SELECT f.*, l.toxic AS target FROM features f JOIN labels l USING (doc_id))"""
)

ITEMS_SQL = """
rows AS (SELECT *, (l_returnflag = 'R')::INT AS target FROM lineitem)"""


GAPS_NUM = ["l_quantity", "l_tax", "discount_few_gaps", "discount_many_gaps"]
GAPS_SQL = """
rows AS (SELECT *, CASE WHEN l_discount <> 0.0 THEN l_discount END AS discount_few_gaps,
                CASE WHEN l_discount > 0.01 THEN l_discount END AS discount_many_gaps,
                (l_returnflag = 'R')::INT AS target FROM lineitem)"""


def long_num(columns: list[str], keep: str = "target") -> str:
    parts = [f"SELECT {keep}, '{c}' AS feature, {c}::DOUBLE AS v FROM rows" for c in columns]
    return "nums AS (" + " UNION ALL ".join(parts) + ")"


def long_cat(columns: list[str], keep: str = "target") -> str:
    parts = [f"SELECT {keep}, '{c}' AS feature, {c} AS v FROM rows" for c in columns]
    return "cats AS (" + " UNION ALL ".join(parts) + ")"


EDGES_SQL = f"""
edges AS (SELECT DISTINCT feature, unnest(quantile_cont(v, {_DECILES})) AS edge
          FROM nums WHERE v IS NOT NULL AND {{fitted_on}} GROUP BY feature)"""

KEPT_SQL = """
sizes AS (SELECT feature, v, count(*) AS n FROM cats WHERE {fitted_on} GROUP BY feature, v),
kept AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) - 1 AS bin_id
         FROM (SELECT *, sum(n) OVER (PARTITION BY feature) AS total FROM sizes)
         WHERE v IS NOT NULL AND n >= 0.05 * total)"""


def contingency_sql(
    rows: str, num: list[str], cat: list[str], label: str = "target", fitted_on: str = "true"
) -> str:
    """Common table expressions ending in contingency(feature, bin_id, good, bad).

    Bins come from the rows for which ``fitted_on`` holds, counts from all.
    """
    edges, kept = EDGES_SQL.format(fitted_on=fitted_on), KEPT_SQL.format(fitted_on=fitted_on)
    # Per distinct value, so that edges are compared once per value.
    return f"""{rows}, {long_num(num, label)}, {long_cat(cat, label)}, {edges}, {kept},
values_n AS (SELECT feature, v, count(*) FILTER ({label} = 0) AS good, count(*) FILTER ({label} = 1) AS bad
             FROM nums GROUP BY feature, v),
marks AS (SELECT feature, list(edge) AS cuts FROM edges GROUP BY feature),
num_bins AS (
  SELECT feature, CASE WHEN v IS NULL THEN -1 ELSE len(list_filter(cuts, lambda e: e <= v)) END AS bin_id,
         sum(good) AS good, sum(bad) AS bad
  FROM values_n JOIN marks USING (feature) GROUP BY ALL),
cat_bins AS (
  SELECT c.feature, CASE WHEN c.v IS NULL THEN -1 ELSE coalesce(k.bin_id, -2) END AS bin_id,
         count(*) FILTER ({label} = 0) AS good, count(*) FILTER ({label} = 1) AS bad
  FROM cats c LEFT JOIN kept k ON c.feature = k.feature AND c.v = k.v GROUP BY ALL),
contingency AS (
  SELECT feature, bin_id::INT AS bin_id, good::BIGINT AS good, bad::BIGINT AS bad FROM num_bins
  UNION ALL SELECT feature, bin_id::INT, good::BIGINT, bad::BIGINT FROM cat_bins)"""


WOE_SQL = """
shares AS (SELECT *, (CASE WHEN good = 0 THEN 0.5 ELSE good END) / sum(good) OVER (PARTITION BY feature) AS g,
                     (CASE WHEN bad = 0 THEN 0.5 ELSE bad END) / sum(bad) OVER (PARTITION BY feature) AS b
           FROM contingency),
woe AS (SELECT feature, bin_id, good, bad, ln(g / b) AS woe, (g - b) * ln(g / b) AS iv FROM shares)"""


# ---- queries ------------------------------------------------------------------


@query(
    "missing_rate",
    """SELECT 'l_quantity' AS feature, 0.0::DOUBLE AS missing_rate
       UNION ALL SELECT 'discount_few_gaps', round(avg((l_discount = 0.0)::INT), 6) FROM lineitem
       UNION ALL SELECT 'discount_many_gaps', round(avg((l_discount <= 0.01)::INT), 6) FROM lineitem""",
)
def missing_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_quantity", "discount_few_gaps", "discount_many_gaps"]
    rates = profile.missing_rate(B.lineitems_with_gaps(spark, sf_dir), columns)
    return rates.withColumn("missing_rate", rounded(F.col("missing_rate")))


@query(
    "class_totals",
    """SELECT count(*) FILTER (l_returnflag <> 'R') AS goods, count(*) FILTER (l_returnflag = 'R') AS bads
       FROM lineitem""",
)
def class_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.class_totals(B.lineitems(spark, sf_dir), "TARGET")


@query(
    "prebin_numeric",
    f"""WITH {ITEMS_SQL}, {long_num(B.ITEM_NUM)}, {EDGES_SQL.format(fitted_on="true")}
        SELECT feature, (row_number() OVER (PARTITION BY feature ORDER BY edge))::INT AS edge_no,
               round(edge, 6) AS edge FROM edges""",
)
def prebin_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = binning.prebin_numeric(B.lineitems(spark, sf_dir), B.ITEM_NUM, BINS)
    rows = [(f, i, e) for f, es in edges.items() for i, e in enumerate(es, 1)]
    table = spark.createDataFrame(rows, "feature string, edge_no int, edge double")
    return table.withColumn("edge", rounded(F.col("edge")))


@query(
    "sketch_refit",
    f"""WITH {ITEMS_SQL}, {long_num(B.ITEM_NUM)}, {EDGES_SQL.format(fitted_on="true")}
        SELECT feature, (row_number() OVER (PARTITION BY feature ORDER BY edge))::INT AS edge_no,
               round(edge, 6) AS edge, true AS near FROM edges""",
)
def sketch_refit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges from the kept sketches of two loads, settled exactly; and whether the sketches alone
    come near them, by the values around the wanted rank."""
    items = B.lineitems(spark, sf_dir)
    finished = F.coalesce(F.col("l_linestatus") == "F", F.lit(False))
    path = fresh_dir(spark, "sketches")
    for load, rows in (("finished", items.where(finished)), ("open", items.where(~finished))):
        sketches.keep_load(sketches.quantile_sketches(rows, B.ITEM_NUM), path, load)
    merged = settle(sketches.merged_sketches(sketches.kept_loads(spark, path)), "sketches")
    probabilities = [i / BINS for i in range(1, BINS)]
    exact = quantiles.exact_quantiles(items, B.ITEM_NUM, probabilities, sketches=merged)
    slack = quantiles.SKETCH_SLACK
    low, high = (
        sketches.sketched_quantiles(merged, [p + sign * slack for p in probabilities]) for sign in (-1, 1)
    )
    rows = []
    for feature, edges in exact.items():
        near = {e: a <= e <= b for e, a, b in zip(edges, low[feature], high[feature])}
        rows += [(feature, i, e, near[e]) for i, e in enumerate(sorted(set(edges)), 1)]
    table = spark.createDataFrame(rows, "feature string, edge_no int, edge double, near boolean")
    return table.withColumn("edge", rounded(F.col("edge")))


@query(
    "prebin_categorical",
    f"""WITH {DOCS_SQL}, {long_cat(B.DOC_CAT)},
        sizes AS (SELECT feature, v, count(*) AS n FROM cats GROUP BY feature, v),
        flagged AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS total FROM sizes)
        SELECT feature, CASE WHEN n >= 0.05 * total THEN v END AS category, sum(n)::BIGINT AS n,
               round(sum(n) / max(total), 6) AS share, (n < 0.05 * total) AS pooled
        FROM flagged GROUP BY ALL""",
)
def prebin_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = binning.prebin_categorical(B.labelled_documents(spark, sf_dir, "toxic"), B.DOC_CAT)
    return bins.withColumn("share", rounded(F.col("share")))


def _item_contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = B.lineitems(spark, sf_dir)
    prebins = binning.fit_prebins(items, B.ITEM_CAT, B.ITEM_NUM, BINS)
    return binning.bin_contingency(items, "TARGET", prebins)


@query(
    "bin_contingency",
    f"WITH {contingency_sql(ITEMS_SQL, B.ITEM_NUM, B.ITEM_CAT)} SELECT * FROM contingency",
)
def bin_contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item_contingency(spark, sf_dir)


def _gaps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Items with missing values, and their contingency."""
    items = B.lineitems_with_gaps(spark, sf_dir)
    prebins = binning.fit_prebins(items, B.ITEM_CAT, GAPS_NUM, BINS)
    return items, binning.bin_contingency(items, "TARGET", prebins)


@query(
    "bin_contingency_gaps",
    f"WITH {contingency_sql(GAPS_SQL, GAPS_NUM, B.ITEM_CAT)} SELECT * FROM contingency",
)
def bin_contingency_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gaps(spark, sf_dir)[1]


@query(
    "woe_table_gaps",
    f"""WITH {contingency_sql(GAPS_SQL, GAPS_NUM, B.ITEM_CAT)}, {WOE_SQL}
        SELECT feature, bin_id, good, bad, round(woe, 6) + 0.0 AS woe, round(iv, 6) + 0.0 AS iv FROM woe""",
)
def woe_table_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = evidence.woe_table(_gaps(spark, sf_dir)[1])
    return table.withColumns({"woe": rounded(F.col("woe")), "iv": rounded(F.col("iv"))})


_CAT_NAMES_SQL = ", ".join(f"'{c}'" for c in B.DOC_CAT)
# Pooling as a formula: the rate of a pool is, over the stretches that begin at or before a bin, the
# highest of the lowest rates of those that end at or after it (and the other way round for falling
# rates). Pools that are too small then join a neighbour, one a step.
POOLS_SQL = f"""
placed AS (SELECT *, row_number() OVER (PARTITION BY feature
             ORDER BY CASE WHEN feature IN ({_CAT_NAMES_SQL}) THEN bad / (good + bad) ELSE bin_id END, bin_id) AS i
           FROM contingency WHERE bin_id <> -1),
spans AS (SELECT a.feature, a.i AS first, z.i AS last, sum(m.bad) / sum(m.good + m.bad) AS rate
          FROM placed a JOIN placed z ON z.feature = a.feature AND z.i >= a.i
          JOIN placed m ON m.feature = a.feature AND m.i BETWEEN a.i AND z.i GROUP BY ALL),
ends AS (SELECT p.feature, p.i, s.first, min(rate) AS low, max(rate) AS high
         FROM placed p JOIN spans s ON s.feature = p.feature AND p.i BETWEEN s.first AND s.last GROUP BY ALL),
pooled AS (SELECT feature, i, 1 AS way, max(low) AS rate FROM ends GROUP BY ALL
           UNION ALL SELECT feature, i, 2, min(high) FROM ends GROUP BY ALL),
pools AS (SELECT way, feature, min(i) AS first, max(i) AS last, sum(good) AS good, sum(bad) AS bad
          FROM pooled JOIN placed USING (feature, i) GROUP BY way, feature, rate),
sides AS (SELECT *, greatest(good, 0.5) / greatest(sum(good) OVER w, 1) AS g, greatest(bad, 0.5) / greatest(sum(bad) OVER w, 1) AS b
          FROM pools WINDOW w AS (PARTITION BY way, feature)),
worth AS (SELECT feature, way, sum((g - b) * ln(g / b)) AS iv FROM sides GROUP BY feature, way),
ways AS (SELECT feature, way FROM worth QUALIFY row_number() OVER (PARTITION BY feature ORDER BY iv DESC, way) = 1),
least AS (SELECT feature, 0.05::DOUBLE * sum(good + bad) AS least FROM contingency GROUP BY feature),
steps(feature, least, p) AS (
  SELECT feature, any_value(least), list({{'first': first, 'last': last, 'good': good::DOUBLE, 'bad': bad::DOUBLE}} ORDER BY first)
  FROM pools JOIN ways USING (feature, way) JOIN least USING (feature) GROUP BY feature
  UNION ALL
  SELECT feature, least,
         p[1:k - 1] || [{{'first': p[k].first, 'last': p[k + 1].last, 'good': p[k].good + p[k + 1].good, 'bad': p[k].bad + p[k + 1].bad}}]
           || p[k + 2:]
  FROM (SELECT feature, least, p,
               CASE WHEN i = 1 THEN 1 WHEN i = len(p) THEN i - 1
                    WHEN abs(p[i - 1].bad / (p[i - 1].good + p[i - 1].bad) - p[i].bad / (p[i].good + p[i].bad))
                      <= abs(p[i + 1].bad / (p[i + 1].good + p[i + 1].bad) - p[i].bad / (p[i].good + p[i].bad)) THEN i - 1
                    ELSE i END AS k
        FROM (SELECT *, list_transform(p, lambda x: x.good + x.bad) AS n, list_position(n, list_min(n)) AS i
              FROM steps WHERE len(p) > 1)
        WHERE n[i] < least)),
final AS (SELECT feature, unnest(p) AS own, generate_subscripts(p, 1) - 1 AS merged_id
          FROM (SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY feature ORDER BY len(p)) = 1))"""


@query(
    "merge_bins",
    f"""WITH RECURSIVE {contingency_sql(DOCS_SQL, B.DOC_NUM, B.DOC_CAT)}, {POOLS_SQL}
        SELECT feature, bin_id, merged_id::INT AS merged_id, p.good, p.bad
        FROM placed p JOIN final f USING (feature) WHERE p.i BETWEEN f.own.first AND f.own.last
        UNION ALL SELECT feature, bin_id, -1, good, bad FROM contingency WHERE bin_id = -1""",
)
def merge_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prebins of labelled documents and the bin that each was pooled into."""
    docs = B.labelled_documents(spark, sf_dir, "toxic")
    prebins = binning.fit_prebins(docs, B.DOC_CAT, B.DOC_NUM, BINS)
    counts = binning.bin_contingency(docs, "TARGET", prebins)
    kind = F.when(F.col("feature").isin(B.DOC_CAT), "cat").otherwise("num")
    return binning.merge_bins(counts.withColumn("kind", kind))


@query("bin_map")
def bin_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole map of bins as it is stored."""
    docs = B.labelled_documents(spark, sf_dir, "quality")
    bins = binning.fit_bins(docs, "TARGET", B.DOC_CAT, B.DOC_NUM, BINS)
    return bins.to_table(spark)


@query(
    "woe_table",
    f"""WITH {contingency_sql(DOCS_SQL, B.DOC_NUM, B.DOC_CAT)}, {WOE_SQL}
        SELECT feature, bin_id, good, bad, round(woe, 6) + 0.0 AS woe, round(iv, 6) + 0.0 AS iv FROM woe""",
)
def woe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = B.labelled_documents(spark, sf_dir, "toxic")
    prebins = binning.fit_prebins(docs, B.DOC_CAT, B.DOC_NUM, BINS)
    table = evidence.woe_table(binning.bin_contingency(docs, "TARGET", prebins))
    return table.withColumns({"woe": rounded(F.col("woe")), "iv": rounded(F.col("iv"))})


@query(
    "iv_by_feature",
    f"""WITH {contingency_sql(ITEMS_SQL, B.ITEM_NUM, B.ITEM_CAT)}, {WOE_SQL}
        SELECT feature, round(sum(iv), 6) + 0.0 AS iv,
               round((count(*) - 1) * (1 / sum(good) + 1 / sum(bad)), 6) AS iv_floor
        FROM woe GROUP BY feature""",
)
def iv_by_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = evidence.iv_by_feature(_item_contingency(spark, sf_dir))
    return table.withColumns({"iv": rounded(F.col("iv")), "iv_floor": rounded(F.col("iv_floor"))})


def _screened(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    docs = B.labelled_documents(spark, sf_dir, "toxic")
    prebins = binning.fit_prebins(docs, B.DOC_CAT, B.DOC_NUM, BINS)
    iv = evidence.iv_by_feature(binning.bin_contingency(docs, "TARGET", prebins))
    return iv, profile.missing_rate(docs, prebins.features), prebins.features


def _ordinals(features: list[str]) -> str:
    rows = ", ".join(f"({i}, '{f}')" for i, f in enumerate(features))
    return f"places(ordinal, feature) AS (VALUES {rows})"


@query(
    "feature_gate",
    f"""WITH {contingency_sql(DOCS_SQL, B.DOC_NUM, B.DOC_CAT)}, {WOE_SQL}, {_ordinals(B.DOC_CAT + B.DOC_NUM)},
        ivs AS (SELECT feature, sum(iv) AS iv FROM woe GROUP BY feature)
        SELECT ordinal, feature, round(iv, 6) AS iv, 0.0::DOUBLE AS missing_rate
        FROM places JOIN ivs USING (feature) WHERE iv BETWEEN 0.02 AND 0.5""",
)
def feature_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv, missing, order = _screened(spark, sf_dir)
    gate = evidence.feature_gate(iv, missing, order)
    return gate.withColumn("iv", rounded(F.col("iv"))).select("ordinal", "feature", "iv", "missing_rate")


def screening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature of the labelled documents with its value, missing rate and verdict."""
    iv, missing, order = _screened(spark, sf_dir)
    return evidence.screening(iv, missing, order)


def _item_bins(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, binning.BinMap]:
    items = B.lineitems(spark, sf_dir)
    bins = binning.fit_bins(items, "TARGET", B.ITEM_CAT, B.ITEM_NUM, BINS, merge=False)
    return items, bins


def _transformed_sql(num: list[str], cat: list[str], keep: str) -> str:
    """wide(keep..., one evidence column per feature) on top of ``woe``."""
    out = []
    for c in num:
        out.append(
            f"""coalesce((SELECT woe FROM lookup_num w WHERE w.feature = '{c}' AND w.v = r.{c}), 0.0) AS {c}"""
        )
    for c in cat:
        out.append(
            f"""coalesce((SELECT woe FROM lookup_cat w WHERE w.feature = '{c}' AND w.v = r.{c}), 0.0) AS {c}"""
        )
    return f"""
lookup_num AS (SELECT x.feature, x.v, w.woe FROM (
    SELECT feature, v, len(list_filter(cuts, lambda e: e <= v)) AS bin_id
    FROM values_n JOIN marks USING (feature) WHERE v IS NOT NULL) x
  JOIN woe w ON w.feature = x.feature AND w.bin_id = x.bin_id),
lookup_cat AS (SELECT s.feature, s.v, w.woe FROM sizes s LEFT JOIN kept k ON s.feature = k.feature AND s.v = k.v
  JOIN woe w ON w.feature = s.feature AND w.bin_id = coalesce(k.bin_id, -2) WHERE s.v IS NOT NULL),
wide AS (SELECT {keep}, {", ".join(out)} FROM rows r)"""


_ITEM_FEATURES = B.ITEM_CAT + B.ITEM_NUM
_ITEM_WOE_SQL = f"{contingency_sql(ITEMS_SQL, B.ITEM_NUM, B.ITEM_CAT)}, {WOE_SQL}"
_ITEM_WIDE_SQL = f"{_ITEM_WOE_SQL}, {_transformed_sql(B.ITEM_NUM, B.ITEM_CAT, _ITEM_KEY + ', target')}"


@query(
    "woe_transform",
    f"""WITH {_ITEM_WIDE_SQL}
        SELECT {_ITEM_KEY}, {", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _ITEM_FEATURES)} FROM wide""",
)
def woe_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, bins = _item_bins(spark, sf_dir)
    wide = evidence.woe_transform(items, bins, B.ITEM_KEY)
    return wide.withColumns({c: rounded(F.col(c)) for c in _ITEM_FEATURES})


@query(
    "woe_transform_long",
    f"""WITH {_ITEM_WIDE_SQL}, long AS (
          UNPIVOT (SELECT * EXCLUDE (target) FROM wide) ON {", ".join(_ITEM_FEATURES)} INTO NAME feature VALUE woe)
        SELECT {_ITEM_KEY}, feature, round(woe, 6) + 0.0 AS woe FROM long""",
)
def woe_transform_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, bins = _item_bins(spark, sf_dir)
    return evidence.woe_long(items, bins, B.ITEM_KEY).withColumn("woe", rounded(F.col("woe")))


_ANOVA_SQL = """
long AS (UNPIVOT wide ON {features} INTO NAME feature VALUE x),
per_class AS (SELECT feature, target, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM long GROUP BY ALL),
centred AS (SELECT *, sum(n * m) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS c
            FROM per_class),
sums AS (SELECT feature, sum(n * (m - c) * (m - c)) AS outer_ss, sum(n * v) AS inner_ss, sum(n) AS n, count(*) AS k
         FROM centred GROUP BY feature),
scores AS (SELECT feature, CASE WHEN inner_ss > 0 THEN (outer_ss / (k - 1)) / (inner_ss / (n - k))
                                WHEN outer_ss > 0 THEN 'inf'::DOUBLE END AS f_score
           FROM sums)"""


@query(
    "anova_f",
    f"""WITH {_ITEM_WIDE_SQL}, {_ANOVA_SQL.format(features=", ".join(_ITEM_FEATURES))}
        SELECT feature, round(f_score, 6) AS f_score FROM scores""",
)
def anova_f(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, bins = _item_bins(spark, sf_dir)
    wide = evidence.woe_transform(items, bins, ["TARGET"])
    scores = evidence.anova_f(wide, "TARGET", bins.features)
    return scores.withColumn("f_score", rounded(F.col("f_score")))


@query(
    "feature_gate_gaps",
    f"""WITH {contingency_sql(GAPS_SQL, GAPS_NUM, B.ITEM_CAT)}, {WOE_SQL}, {_ordinals(B.ITEM_CAT + GAPS_NUM)},
        ivs AS (SELECT feature, sum(iv) AS iv FROM woe GROUP BY feature),
        absent AS (UNPIVOT (SELECT avg((l_linestatus IS NULL)::INT) AS l_linestatus,
                                   {", ".join(f"avg(({c} IS NULL)::INT) AS {c}" for c in GAPS_NUM)} FROM rows)
                   ON COLUMNS(*) INTO NAME feature VALUE missing_rate)
        SELECT ordinal, feature, round(iv, 6) + 0.0 AS iv, round(missing_rate, 6) + 0.0 AS missing_rate
        FROM places JOIN ivs USING (feature) JOIN absent USING (feature)
        WHERE iv BETWEEN 0.0 AND 0.5 AND missing_rate <= 0.1""",
)
def feature_gate_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide band, so that the missing rates decide."""
    items, contingency = _gaps(spark, sf_dir)
    order = B.ITEM_CAT + GAPS_NUM
    iv, missing = evidence.iv_by_feature(contingency), profile.missing_rate(items, order)
    gate = evidence.feature_gate(iv, missing, order, min_iv=0.0)
    return gate.select("ordinal", "feature", *[rounded(F.col(c)).alias(c) for c in ("iv", "missing_rate")])


_DOC_FEATURES = B.DOC_CAT + B.DOC_NUM
DOC_WIDE_SQL = f"""{contingency_sql(DOCS_SQL, B.DOC_NUM, B.DOC_CAT)}, {WOE_SQL},
{_transformed_sql(B.DOC_NUM, B.DOC_CAT, "doc_id, target")}"""


def doc_bins(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, binning.BinMap]:
    docs = B.labelled_documents(spark, sf_dir, "toxic")
    return docs, binning.fit_bins(docs, "TARGET", B.DOC_CAT, B.DOC_NUM, BINS, merge=False)


@query(
    "select_k_best",
    f"""WITH {DOC_WIDE_SQL}, {_ANOVA_SQL.format(features=", ".join(_DOC_FEATURES))}, {_ordinals(_DOC_FEATURES)},
        best AS (SELECT * FROM places JOIN scores USING (feature)
                 ORDER BY f_score DESC NULLS LAST, ordinal DESC LIMIT 4)
        SELECT ordinal, feature, round(f_score, 6) AS f_score FROM best""",
)
def select_k_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bins = doc_bins(spark, sf_dir)
    scores = evidence.anova_f(
        evidence.woe_transform(docs, bins, ["TARGET"]), "TARGET", bins.features
    )
    best = evidence.select_k_best(scores, bins.features, 4)
    return best.withColumn("f_score", rounded(F.col("f_score")))


SCORE_WEIGHTS = {f: round(-1.0 + 0.25 * i, 2) for i, f in enumerate(_DOC_FEATURES)}


@query(
    "contribution_summary",
    f"""WITH {DOC_WIDE_SQL}, means AS (SELECT {", ".join(f"avg({f}) AS m_{f}" for f in _DOC_FEATURES)} FROM wide)
        {" UNION ALL ".join(
            f"SELECT '{f}' AS feature, round(avg(abs({w} * ({f} - m_{f}))), 6) + 0.0 AS mean_abs_contribution "
            "FROM wide, means" for f, w in SCORE_WEIGHTS.items())}""",
)
def contribution_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bins = doc_bins(spark, sf_dir)
    summary = evidence.contribution_summary(evidence.woe_transform(docs, bins, []), SCORE_WEIGHTS)
    return summary.withColumn("mean_abs_contribution", rounded(F.col("mean_abs_contribution")))


_LOGIT = " + ".join(["-2.0", *[f"({w}) * {f}" for f, w in SCORE_WEIGHTS.items()]])


@query(
    "permutation_importance",
    f"""WITH {DOC_WIDE_SQL},
        placed AS (SELECT *, md5('42:0|' || doc_id) AS place, (SELECT greatest(1, count(*) // 10000) FROM wide) AS buckets FROM wide),
        dealt AS (SELECT *, ('0x' || place[1:8])::BIGINT % buckets AS bucket FROM placed),
        donors AS (SELECT *, {", ".join(f"coalesce(lead({f}) OVER w, first_value({f}) OVER w) AS d_{f}" for f in _DOC_FEATURES)}
                   FROM dealt WINDOW w AS (PARTITION BY bucket ORDER BY place)),
        logits AS (SELECT *, {_LOGIT} AS z FROM donors),
        judged AS ({" UNION ALL ".join(
            f"SELECT '{f}' AS feature, avg(((z > 0)::INT = target)::INT) AS baseline, "
            f"avg(((z + ({w}) * (d_{f} - {f}) > 0)::INT = target)::INT) AS permuted FROM logits"
            for f, w in SCORE_WEIGHTS.items())})
        SELECT feature, round(baseline, 6) AS baseline, round(permuted, 6) AS permuted,
               round(baseline - permuted, 6) + 0.0 AS importance FROM judged""",
)
def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a fixed scorecard loses when one feature's values change places."""
    docs, bins = doc_bins(spark, sf_dir)
    wide = settle(evidence.woe_transform(docs, bins, ["doc_id", "TARGET"]), "woe")
    logit = F.lit(-2.0)
    for f, w in SCORE_WEIGHTS.items():
        logit = logit + F.lit(w) * F.col(f)
    found = exchanged(
        wide, ["doc_id"], "TARGET", _DOC_FEATURES, lambda t: t.withColumn("prediction", (logit > 0).cast("int"))
    )
    return found.select("feature", *[(rounded(F.col(c)) + 0.0).alias(c) for c in ("baseline", "permuted", "importance")])
