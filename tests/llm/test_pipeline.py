"""The pipeline, stage by stage, against brute-force versions; and what the entry points list."""

import hashlib

import __spark_entry__ as entry_points
import corpus_pipeline
from test_lines import brute as slow_lines
from test_near import brute_components, brute_print
from test_search import slow_hits
from test_tokens import ENCODER

from riskloom.bindings import table
from riskloom.llm import toxicity


def test_stages(spark, sf_dir):
    docs, steps = table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        steps.append((name, docs.columns, {r.doc_id: r for r in docs.collect()}))
        docs = spark.createDataFrame(docs.collect(), docs.schema).repartition(4)
    (_, _, calm), (_, _, lines), (_, _, single), (_, _, clean), (_, _, coded) = steps
    assert [c for _, c, _ in steps[:4]] == [corpus_pipeline.COLUMNS] * 4

    everything = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    scores = toxicity.toxicity(everything, toxicity.fit(everything, labels)).collect()
    assert set(calm) == {r.doc_id for r in scores if r.score < toxicity.THRESHOLD}
    assert len(calm) < len(scores)

    gone = slow_lines(sorted((d, r.text) for d, r in calm.items()))
    for d, r in calm.items():
        left = "\n".join(x for k, x in enumerate(r.text.split("\n")) if k not in gone[d])
        assert (lines[d].text, lines[d].n_chars, lines[d].lang) == (left, len(left), r.lang)
    assert set(lines) == set(calm)

    ids = sorted(lines)
    prints = {d: brute_print(lines[d].text) for d in ids}
    near = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert set(single) == {d for d, top in brute_components(ids, near).items() if d == top}

    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    hit = slow_hits([(d, r.text) for d, r in single.items()], items)
    assert {str(d) for d in clean} == {d for d, *_, bad in hit if not bad}

    assert set(coded) == set(clean)
    for d, r in coded.items():
        ids = ENCODER.encode_ordinary(clean[d].text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(clean[d].text.encode()).hexdigest()


def test_empty_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_entry_points():
    names = entry_points.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert {"op3_decontamination", "op7_topk"} <= set(entry_points.oracle_sql())
