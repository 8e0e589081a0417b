"""URL filter, language, toxicity and language-model scores: brute force and held-out accuracy."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.bindings import table
from riskloom.llm import exchange, language, maxent, queries, toxicity, url_filter
from riskloom.llm.common import in_fold

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block")]

URLS = [
    ("http://a.com/x", "a.com", "/x", "com/", "allow"),
    ("http://a.com", "a.com", "", None, None),
    ("HTTPS://M.Example.COM/en/1?q#t", "m.example.com", "/en/1", "example.com/en/", "block"),
    ("x://example.com/en/", "example.com", "/en/", "example.com/en/", "block"),
    ("x://www.example.com/en/a#?", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
    ("x://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
    ("x://a.net/es/\n1", "a.net", "/es/\n1", "net/es/", "block"),
    ("x://?a/b", "", "", None, None),
    ("no scheme", "", "", None, None),
    ("a://b://c/d", "b:", "//c/d", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def test_hosts_and_rules(rows):
    data = [(i, u, "t") for i, (u, *_) in enumerate(URLS)]
    got = url_filter.url_filter(rows(data, "page_id long, url string, host string"), RULES, text=None).collect()
    by = {r.page_id: r for r in got}
    for i, (_, host, path, rule, says) in enumerate(URLS):
        assert (by[i].host, by[i].path, by[i].rule) == (host, path, rule)
        assert by[i].verdict == (says or "allow")


def slow_split(name, n, total):
    """The cheapest of all splits."""
    unknown = math.log(total) + 1
    cost = lambda w: math.log(total / n[w]) if w in n else unknown * (len(w) + 1)
    best = math.inf
    for mask in range(1 << (len(name) - 1)):
        cuts = [0, *(i + 1 for i in range(len(name) - 1) if mask >> i & 1), len(name)]
        best = min(best, sum(cost(name[a:b]) for a, b in zip(cuts, cuts[1:])))
    return best, cost


def test_segmentation(spark):
    n = {"the": 50, "re": 9, "there": 5, "he": 20, "in": 30, "rein": 3, "a": 40, "casino": 7, "win": 8}
    total = sum(n.values())
    names = ["there", "therein", "casinowin", "thexa", "ainthe", "zzz", "reinhe"]
    counts = spark.createDataFrame(list(n.items()), "word string, n long")
    got = url_filter.segmented(spark.createDataFrame([(x,) for x in names], "name string"), counts).collect()
    assert sorted(r.name for r in got) == sorted(names)
    for r in got:
        best, cost = slow_split(r.name, n, total)
        assert "".join(r.words) == r.name
        assert sum(map(cost, r.words)) == pytest.approx(best)


def test_naive_bayes(spark):
    shapes = [("a", "", 3, 0, ["casino", "play", "www"]), ("b", "", 0, 2, ["the", "news", "www"]), ("c", "", 1, 1, ["play", "win"]), ("d", "", 0, 0, ["odd", "play"]), ("e", "", 0, 0, [])]
    df = spark.createDataFrame(shapes, "host string, form string, b long, a long, words array<string>").withColumn("n", F.lit(2))
    got = {r.host: r.score for r in url_filter.naive_bayes(df).collect()}
    bad, good = Counter(), Counter()
    for _, _, b, a, words in shapes:
        for w in words:
            bad[w] += b
            good[w] += a
    bad.update(dict.fromkeys(url_filter.SEEDS, max(1.0, url_filter.SEED_SHARE * sum(bad.values()) / len(url_filter.SEEDS))))
    size = len(set(bad) | set(good))
    for host, _, _, _, words in shapes:
        want = math.log(5 / 4) + sum(
            math.log((bad[w] + 1) / (sum(bad.values()) + size)) - math.log((good[w] + 1) / (sum(good.values()) + size))
            for w in words
            if bad[w] + good[w] > 0
        )
        assert got[host] == pytest.approx(want)


def test_rules_teach_other_hosts(rows):
    """Verdicts where no rule fits follow words that only the rules' URLs teach; no seed is among them."""
    rules = [("bad.net/", "block"), ("good.net/", "allow")]
    urls = [f"http://{'bad' if i % 2 else 'good'}.net/{'prize/claim' if i % 2 else 'recipes/soup'}/{i}" for i in range(60)]
    urls += ["http://x.org/claim/1", "http://x.org/soup/1", "http://y.org/prize", "http://y.org/recipes"]
    got = url_filter.url_filter(rows(list(enumerate(urls)), "page_id long, url string"), rules, text=None)
    says = {r.page_id: (r.rule, r.verdict) for r in got.where("page_id >= 60").collect()}
    assert says == {60: (None, "block"), 61: (None, "allow"), 62: (None, "block"), 63: (None, "allow")}


def test_naive_bayes_held_out(spark):
    """Rules learned on one half of the hosts and paths are found again by words on the other half."""
    pages = table(spark, "/root/testdata/sf0.1", "pages")
    held_out = F.xxhash64("url") % 2 == 0
    got = url_filter.url_filter(pages, queries.RULES, held_out=held_out).join(pages.select("page_id", "url"), "page_id")
    right = F.avg(((F.col("score") > 0) == (F.col("verdict") == "block")).cast("int"))
    found = got.where(held_out & F.col("rule").isNotNull()).agg(right, F.count("*")).first()
    assert found[1] > 500 and found[0] >= 0.9


def test_url_filter_edges(rows):
    data = [(None, "http://casinowin.org/a", None), (1, "http://news.org/" + "x" * 5000, "<p>casino win</p> news " * 5), (1, "http://news.org/1", None), (2, "http://casinowin.org/b", "")]
    got = url_filter.url_filter(rows(data, "page_id long, url string, html string"), RULES).collect()
    says = sorted((str(r.page_id), r.verdict) for r in got)
    assert says == [("1", "allow"), ("1", "allow"), ("2", "block"), ("None", "block")]
    assert url_filter.url_filter(rows([], "page_id long, url string, html string"), RULES).count() == 0


def slow_kneser_ney(texts, letters):
    """Probability of the last character of a gram, from the counts of one language."""
    d, top = language.DISCOUNT, language.ORDER
    counts = {top: Counter()}
    for t in texts:
        line = " " * (top - 1) + " ".join(t.split()) + " "
        counts[top].update(line[i : i + top] for i in range(len(line) - top + 1))
    for n in range(top - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / letters
        here = [c for g, c in counts[n].items() if g[:-1] == gram[:-1]]
        rest = p(gram[1:])
        if not here:
            return rest
        return max(counts[n][gram] - d, 0) / sum(here) + d * len(here) / sum(here) * rest

    return p


def test_kneser_ney(rows):
    r = random.Random(9)
    texts = {l: [" ".join("".join(r.choice(a) for _ in range(r.randrange(1, 6))) for _ in range(9)) for _ in range(6)] for l, a in (("x", "abcd"), ("y", "bcdé"))}
    lang, gram, n = [], [], []
    for l, some in texts.items():
        keys, times = np.unique(np.concatenate([language.grams(t) for t in some]), return_counts=True)
        lang += [l] * len(keys)
        gram += keys.tolist()
        n += times.tolist()
    model = language.build(["x", "y"], np.array(lang, object), np.array(gram, np.uint64), np.array(n, float))
    slow = [slow_kneser_ney(texts[l], math.exp(-model.floor)) for l in ("x", "y")]
    for t in ["abcé dab", "zz top", "ccc bbb", *texts["y"][:2]]:
        cost, size = model.costs(t)
        line = "   " + t + " "
        want = [-sum(math.log(p(line[i : i + 4])) for i in range(len(line) - 3)) / size for p in slow]
        assert cost == pytest.approx(want, rel=1e-4)


def test_language_edges(rows):
    data = [(1, "bonjour tout le monde", "fr"), (2, "hello to all the world", "en"), (3, None, "en"), (4, "12 !?", "en"), (5, "", None), (None, "le monde " * 20_000, "fr"), (2, "hello to all the world", "en"), (6, "𐌰𐌱 the world", None)]
    df = rows(data, "doc_id long, text string, lang string")
    model = language.fit(df)
    got = language.identify(df, model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(data)
    assert [by[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3
    assert (by[1].lang_pred, by[None].lang_pred, by[6].lang_pred) == ("fr", "fr", "en")
    assert all(0 <= r.score <= 1 for r in got)
    nothing = language.fit(rows([], "doc_id long, text string, lang string"))
    assert [r.lang_pred for r in language.identify(rows([(1, "abc")], "doc_id long, text string"), nothing).collect()] == ["und"]


def test_language_held_out(spark):
    path = "/root/testdata/sf0.01"
    found = queries.op2_language(spark, path).where("held_out")
    both = found.join(table(spark, path, "documents").select("doc_id", "lang"), "doc_id")
    right = both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.98


def test_label_model():
    r = np.random.default_rng(10)
    y = r.random(4000) < 0.2
    fire = np.where(y[:, None], [0.7, 0.6, 0.5, 0.05], [0.02, 0.05, 0.01, 0.3])
    votes = (r.random((4000, 4)) < fire).astype(float)
    votes = np.c_[votes, votes[:, 0]]  # an echo of the first voter
    label = (y ^ (r.random(4000) < 0.03)).astype(int)
    model = toxicity.estimate(votes, label, np.ones(4000))
    assert model.share[0] < 0.5 < model.share[1]
    assert model.toxic[1] == pytest.approx(0.6, abs=0.1) and model.clean[1] == pytest.approx(0.05, abs=0.05)
    assert ((model.posterior(votes, label) > 0.5) == y).mean() > 0.95


def test_toxicity_learns(rows):
    r = random.Random(11)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    data, marks = [], []
    for i in range(600):
        text = [r.choice(words) for _ in range(30)]
        if bad := r.random() < 0.2:
            text += [r.choice(["gruzzle", "zorkina", "zorkino", "zorkiny"]) for _ in range(3)]
        r.shuffle(text)
        data.append((i, " ".join(text)))
        marks.append((i, int(bad)))
    data += [(None, "gruzzle " * 50_000), (700, None), (701, ""), (1, data[1][1])]
    marks += [(None, 1), (3, None), (4, 7)]
    docs = rows([(d, t, 0.5) for d, t in data], "doc_id long, text string, score double")
    model = toxicity.fit(docs, rows(marks, "doc_id long, toxic int").where("doc_id IS NULL OR doc_id % 4 <> 2"))
    got = toxicity.toxicity(docs, model).collect()
    assert len(got) == len(data) and all(0 <= x.score <= 1 for x in got)
    truth = {i: y for i, y in marks[:600] if i % 4 == 2}
    right = [x.predicted == truth[x.doc_id] for x in got if x.doc_id in truth]
    assert np.mean(right) > 0.97
    assert [x.predicted for x in got if x.doc_id in (700, 701)] == [0, 0]
    assert len([x for x in got if x.doc_id is None]) == 1


def test_toxicity_without_labels(rows):
    docs = rows([(1, "a b"), (2, None)], "doc_id long, text string")
    none = rows([], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, toxicity.fit(docs, none)).collect()
    assert len({r.score for r in got}) == 1
    assert toxicity.toxicity(rows([], "doc_id long, text string"), toxicity.fit(docs, none)).count() == 0


def slow_lm(data, learn):
    """Counts and base scores, and the sum of the model's probabilities of all words at a place."""
    tok = lambda t: [*(t or "").encode().lower().split(), None]
    c = Counter(w for i, (d, t) in enumerate(data) if learn(d) for w in tok(t))
    n, v = sum(c.values()), len(c)
    rows = []
    for d, t in data:
        w = tok(t)
        rows.append((str(d), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)))
    return sorted(rows)


def lm_case():
    r = random.Random(12)
    words = ["".join(r.choice("ABab.é") for _ in range(r.randrange(1, 5))) for _ in range(60)]
    data = [(i, " ".join(r.choice(words[: 5 + i % 50]) for _ in range(r.randrange(40)))) for i in range(200)]
    return [*data, (None, "ab\x1cb \x85 c"), (300, None), (301, ""), (302, "ab " * 30_000), data[5]]


@pytest.mark.parametrize("batch", [300, 1 << 24])
def test_lm_counts_and_base(rows, monkeypatch, batch):
    monkeypatch.setattr(exchange, "BATCH_BYTES", batch)
    monkeypatch.setattr(exchange, "SHARD_BYTES", 2000)
    data = lm_case()
    df = rows([(d, t, 1) for d, t in data], "doc_id long, text string, score int")
    got = maxent.lm_scores(df, F.coalesce(F.col("doc_id") % 3 != 1, F.lit(True))).collect()
    want = slow_lm(data, lambda d: d is None or d % 3 != 1)
    for g, w in zip(sorted(map(tuple, got), key=lambda x: (str(x[0]), *x[1:3])), want, strict=True):
        assert (str(g[0]), *g[1:4]) == w[:4]
        assert g[4] == pytest.approx(w[4], rel=1e-9)
        assert g[5] < 0 and math.isfinite(g[5])


def test_lm_gradient():
    """Sums over the texts are those of a plain loop."""
    made = exchange._Pile(maxent.tokens)
    for text, flag in ((b"a b a c", True), (b"", True), (b"b b", False)):
        made.add(None, text, flag)
    words = list(made.places)
    counts = np.array([{b"a": 2, b"b": 1, b"c": 1, b"": 2}[w] for w in words], np.uint64)
    row = {
        "flags": made.flags, "counts": list(made.counts), "a": exchange.packed(np.array(made.sequence, np.uint32)),
        "c": exchange.packed(counts), "h": exchange.packed(np.arange(len(words), dtype=np.uint32) + 5),
    }
    r = np.random.default_rng(13)
    columns = maxent.columns_of(np.bincount([1, 2], [4.0, 3.0], maxent.CLASSES))
    assert columns[[0, 1, 2, maxent.END_CLASS]].tolist() == [0, 1, 2, 3]
    shape = (maxent.KINDS, maxent.BUCKETS, 4)
    weights = maxent.Weights(r.normal(size=shape).astype(np.float32), r.normal(size=4).astype(np.float32), columns)
    observed, expected = maxent._observed(iter([row]), columns), maxent._expected(iter([row]), weights)
    batch = maxent.Batch(row, columns)
    features, cls = batch.features(0, 9), batch.column[batch.sequence]
    assert cls.tolist() == [2, 1, 2, 1, 3, 3, 1, 1, 3]
    want, slow = np.zeros_like(observed), np.zeros_like(observed)
    for t in range(6):  # tokens of the flagged texts
        seats = [k * maxent.BUCKETS + int(features[k, t]) for k in range(maxent.KINDS)]
        x = weights.bias + sum(weights.table.reshape(-1, 4)[s] for s in seats)
        p = np.exp(x) / np.exp(x).sum()
        for s in [*seats, -1]:
            for k, share in ((0, 0.5), (1, 0.5)) if cls[t] == 1 else ((int(cls[t]), 1.0),):
                want[s, k] += share
            slow[s] += p
    assert np.allclose(observed, want) and np.allclose(expected, slow, atol=1e-4)
    # stretches add up to the whole, and steps change nothing
    stretches = [maxent._observed([row], columns, (k, 4)) for k in range(4)]
    assert np.allclose(sum(stretches), want)
    assert np.allclose(sum(maxent._expected([row], weights, (k, 4)) for k in range(4)), slow, atol=1e-4)
    # the first token of a text sees no other text
    assert (features[:, 5] == features[:, 0]).all() and (features[:, 6] == features[:, 0]).all()


def test_lm_is_normalised():
    counts = np.array([0, 1, 1, 3, 7, 6], np.int64)
    cls = maxent.classes_of(counts)
    totals = maxent.Totals(18, 5, np.bincount(cls[1:], counts[1:] + 1.0, maxent.CLASSES))
    share = 10 ** totals.within(counts, cls)
    assert np.bincount(cls, share).tolist() == pytest.approx([1, 1, 1, 1])


def test_lm_paths_are_normalised():
    """Without weights, the turns give the share by counts; with any, they sum to one after a context."""
    r = np.random.default_rng(14)
    counts = {b"%d" % i: n for i, n in enumerate([1, 1, 0, 3, 2, 2, 3, 3, 2, 3, 3])}
    names, masses = list(counts), np.zeros((6, maxent.CLASSES))
    leaves, runs = [], []
    for shard, own in ((3, names[:5]), (5, names[5:])):
        seen = {w: counts[w] for w in own}
        leaf, values, often = maxent.ranked(seen)
        leaves += [leaf.get(w, 0) for w in own]
        runs.append((shard, values.size, values, often))
        masses[shard] = np.bincount(maxent.classes_of(values.astype(int)), often * (values + 1.0), maxent.CLASSES)
    shards, sizes, values, often = zip(*runs)
    cls = maxent.classes_of(np.array(list(counts.values())))
    small = {"a": None, "h": range(12), "l": [*leaves, 0], "p": [0] * 5 + [1] * 7, "k": shards, "s": sizes, "n": np.concatenate(often)}
    large = {"c": [*counts.values(), 1], "v": np.concatenate(values)}
    # a text that has each word in turn, with the first two words before each of them
    for inner in (np.zeros(1 << 10, np.float32), r.normal(size=1 << 10).astype(np.float32)):
        weights, got = maxent.Weights(None, None, None, inner, masses), []
        for w in range(11):
            small["a"] = [0, 1, w, 11]
            row = {n: exchange.packed(np.array(x, np.uint32)) for n, x in small.items()}
            row |= {n: exchange.packed(np.array(x, np.uint64)) for n, x in large.items()}
            batch = maxent.Batch(row | {"flags": [True], "counts": [4]}, np.arange(maxent.CLASSES))
            got.append(10 ** batch.within(weights)[2])
        assert np.bincount(cls, got)[1:] == pytest.approx([1, 1])
        if not inner.any():
            totals = maxent.Totals(18, 10, masses.sum(axis=0))
            assert got == pytest.approx(10 ** totals.within(np.array(list(counts.values())), cls), rel=1e-5)


def test_lm_tells_words_of_one_class_apart(rows, monkeypatch):
    """Words of one count stand in fixed pairs; a text scores above the same one with the second words exchanged."""
    monkeypatch.setattr(exchange, "SHARD_BYTES", 2000)
    pairs = [(f"a{i}", f"b{i}") for i in range(40)]
    r, data = random.Random(15), []
    for i in range(16):
        data.append((i, " ".join(w for p in r.sample(pairs, 40) for w in p)))
    data.append((100, " ".join(w for p in pairs for w in p)))
    data.append((101, " ".join(w for (a, _), (_, b) in zip(pairs, [*pairs[1:], pairs[0]]) for w in (a, b))))
    got = maxent.lm_scores(rows(data, "doc_id long, text string"), F.col("doc_id") < 100).where("doc_id >= 100").collect()
    score = {r.doc_id: r.score / r.n_tokens for r in got}
    assert score[100] > score[101] + 0.3


def test_lm_beats_the_base(spark):
    found = queries.op6_lm_scores(spark, "/root/testdata/sf0.001").where("held_out")
    sums = found.agg(F.sum("score").alias("model"), F.sum("base_score").alias("base")).first()
    assert sums.model > sums.base


def test_lm_without_training(rows):
    df = rows([(1, "a b"), (2, None)], "doc_id long, text string")
    got = maxent.lm_scores(df, F.lit(False)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]
    assert maxent.lm_scores(rows([], "doc_id long, text string"), F.lit(True)).count() == 0


def test_folds(rows):
    import zlib

    df = rows([(i,) for i in range(200)] + [(None,)], "doc_id long").select("doc_id", in_fold(F.col("doc_id"), 7, 2).alias("f"))
    for r in df.collect():
        assert r.f == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2)


def test_drop_toxic_keeps_columns_of_any_name(rows):
    bad, good = "you are a stupid idiot and a moron", "the river runs through the quiet town"
    texts = [(i, bad if i % 2 else good, float(i), "x") for i in range(40)] + [(40, None, 0.0, "x"), (None, "", 1.0, "y")]
    df = rows(texts, "doc_id long, text string, _toxicity double, score string")
    labels = rows([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(df, labels)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(t[0]) for t in texts if t[1] != bad)
