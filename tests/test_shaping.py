import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import profile as P
from riskloom.operators import shaping as H
from riskloom.sources import (
    APPLICANT_SCHEMA,
    append_run,
    object_uri,
    parse_records,
    read_applications,
    read_object,
    read_records,
    read_runs,
    rejected_records,
    rejected_rows,
    versioned_name,
    write_versioned,
)


def test_applicant_schema():
    kinds = [f.dataType.simpleString() for f in APPLICANT_SCHEMA]
    assert (kinds.count("bigint"), kinds.count("double"), kinds.count("string")) == (40, 66, 15)
    assert all(f.nullable for f in APPLICANT_SCHEMA)
    assert APPLICANT_SCHEMA.names[0] == "SK_ID_CURR"


def test_records_drop_unlisted_and_null_absent_fields(spark, tmp_path):
    request = [{"SK_ID_CURR": 1, "EXT_SOURCE_1": 0.5, "unlisted": 1}, {"CODE_GENDER": None}]
    (tmp_path / "r.json").write_text(json.dumps(request, indent=1))
    rows = read_records(spark, str(tmp_path / "r.json")).orderBy(F.col("SK_ID_CURR").asc_nulls_last()).collect()
    assert len(rows) == 2 and len(rows[0]) == 121
    assert (rows[0]["SK_ID_CURR"], rows[0]["EXT_SOURCE_1"], rows[1]["SK_ID_CURR"]) == (1, 0.5, None)
    (tmp_path / "l.json").write_text("\n".join(json.dumps(r) for r in request))
    assert read_records(spark, str(tmp_path / "l.json"), lines=True).count() == 2


def test_records_in_a_column(spark):
    texts = [('[{"k": 1}, {"k": 2, "z": 3}]',), ('{"k": 5}',)]
    df = spark.createDataFrame(texts, "body string")
    schema = T.StructType([T.StructField("k", T.LongType())])
    assert sorted(r["k"] for r in parse_records(df, "body", schema).collect()) == [1, 2, 5]


def test_object_addresses(spark, sf_dir):
    assert object_uri("raw", "data/train.csv") == "s3a://raw/data/train.csv"
    assert read_object(spark, sf_dir, "nation.parquet", "file").count() == 25
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_object(spark, sf_dir, "no_such.parquet", "file")


def test_versioned_names_and_round_trip(spark, tmp_path):
    assert versioned_name("data/train.csv", "v1") == "data/train_v1.csv"
    df = spark.createDataFrame([(1, "a"), (2, None)], "k bigint, c string")
    for suffix in ("csv", "parquet"):
        target = write_versioned(df, str(tmp_path / f"t.{suffix}"), "v2")
        assert target.endswith(f"t_v2.{suffix}")
        back = read_applications(spark, target, df.schema)
        assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, None)]


def test_schema_is_inferred_without_one(spark, tmp_path):
    spark.createDataFrame([(1, 0.5, "x")], "a bigint, b double, c string").write.option("header", True).csv(str(tmp_path / "i.csv"))
    assert [t for _, t in read_applications(spark, str(tmp_path / "i.csv")).dtypes] == ["int", "double", "string"]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert append_run(spark, path, "ci", "xgb", {"max_depth": 3}, {"accuracy": 0.5, "roc_auc": None}) == "ci_XGB"
    append_run(spark, path, "v2", "lgbm", {}, {"accuracy": 0.6})
    rows = {r["run_name"]: r for r in read_runs(spark, path).collect()}
    assert rows["ci_XGB"]["metrics"] == {"accuracy": 0.5} and rows["ci_XGB"]["params"] == {"max_depth": "3"}
    assert set(rows) == {"ci_XGB", "v2_LGBM"}


def test_feature_lists():
    class Table:
        schema = T.StructType(
            [
                T.StructField("SK_ID_CURR", T.LongType()),
                T.StructField("a", T.StringType()),
                T.StructField("b", T.DoubleType()),
                T.StructField("when", T.TimestampType()),
                T.StructField("c", T.LongType()),
                T.StructField("TARGET", T.LongType()),
            ]
        )

    assert H.feature_lists(Table()) == (["a"], ["b", "c"])


def test_label_and_projection(spark):
    df = spark.createDataFrame([(1, 2, 0)], "b int, a int, TARGET int")
    x, y = H.label_split(df)
    assert (x.columns, y.columns) == (["b", "a"], ["TARGET"])
    assert H.model_input(df, ["a", "b", "z"]).columns == ["b", "a"]


def test_split_is_stable_and_about_a_fifth(spark):
    df = spark.range(5000)
    parts = [{r["id"] for r in H.train_valid_split(df.repartition(n), "id")[1].collect()} for n in (1, 17)]
    assert parts[0] == parts[1]
    assert 900 < len(parts[0]) < 1100
    train, valid = H.train_valid_split(df, "id")
    assert train.count() + valid.count() == 5000
    other = {r["id"] for r in H.train_valid_split(df, "id", seed=7)[1].collect()}
    assert other != parts[0]


def test_lookup(spark):
    table = spark.createDataFrame([(1, "x"), (2, "y")], "k bigint, v string")
    ids = spark.createDataFrame([(2,), (9,), (2,)], "id bigint")
    found = {r["requested_id"]: (r["v"], r["error"]) for r in H.entity_lookup(ids, table, "id", "k").collect()}
    assert found == {2: ("y", None), 9: (None, "ID 9 not found")}
    assert H.lookup_one(table, "k", 1).first()["v"] == "x"


def test_latest_in_production_else_unstaged(spark):
    rows = [("m", 1, "Production"), ("m", 3, "None"), ("m", 2, "Production"), ("n", 1, "None"), ("n", 2, "None"), ("n", 5, "Staging"), ("o", 1, "Archived")]
    df = spark.createDataFrame(rows, "name string, version int, stage string")
    found = H.latest_with_fallback(df, "name", "stage", ["version"])
    assert {(r["name"], r["version"]) for r in found.collect()} == {("m", 2), ("n", 2)}


def test_missing_rate_and_profile(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (4.0, "b")], "x double, c string")
    rates = {r["feature"]: r["missing_rate"] for r in P.missing_rate(df, ["x", "c"]).collect()}
    assert rates == {"x": 0.5, "c": 0.25}
    prof = {r["column_name"]: r for r in P.table_profile(df, distinct=True).collect()}
    assert (prof["x"]["n_missing"], prof["x"]["min_number"], prof["x"]["max_number"], prof["x"]["mean"]) == (2, 1.0, 4.0, 2.5)
    assert (prof["c"]["min_text"], prof["c"]["approx_distinct"], prof["c"]["dtype"]) == ("a", 2, "string")
    clean = H.null_normalise(df)
    assert clean.where(F.isnan("x")).count() == 0 and clean.where(F.col("x").isNull()).count() == 2
    assert H.fill_missing(clean, ["x"]).agg(F.sum("x")).first()[0] == 5.0


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 0.1, "a"), (2, None, None), (3, float("nan"), "c")], "k int, EXT_SOURCE_1 double, c string")
    found = {r["k"]: r["missing"] for r in P.required_column_check(df, ["k"], ["EXT_SOURCE_1", "c"]).collect()}
    assert found == {2: ["EXT_SOURCE_1", "c"], 3: ["EXT_SOURCE_1"]}
    with pytest.raises(ValueError, match="missing columns: EXT_SOURCE_2"):
        P.required_column_check(df, ["k"], ["EXT_SOURCE_2"])


def test_type_conformance(spark):
    df = spark.createDataFrame([("1", "0.5"), ("x", "1e3"), (None, ""), ("2.5", "y")], "a string, b string")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    found = {r["column_name"]: (r["n_values"], r["n_bad"]) for r in P.type_conformance(df, schema).collect()}
    assert found == {"a": (3, 2), "b": (4, 2)}
    assert P.conforming_rows(df, schema).collect() == [(1, 0.5)]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,TARGET,b,a\n1,9,x,2\n2,9,,3\nzz,9,y,4\n4,9\n")
    path = str(tmp_path / "t.csv")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("k", T.LongType()), T.StructField("b", T.StringType())])
    rows = read_applications(spark, path, schema, bad="drop").collect()
    assert {tuple(r) for r in rows} == {(2, 1, "x"), (3, 2, None)}, "a row cut short is rejected too"
    assert rejected_rows(spark, path, schema).count() == 2
    with pytest.raises(Exception, match="cannot be read"):
        read_applications(spark, path, schema).collect()
    with pytest.raises(ValueError, match="nowhere"):
        read_applications(spark, path, T.StructType([T.StructField("nowhere", T.LongType())]))


def test_damaged_records_are_kept_apart(spark):
    texts = [('[{"k": 1}, {"k": "x"}]',), ('[{"k": 2}',), (None,), ("[]",), ('{"k": 3}',), ("7",)]
    df = spark.createDataFrame(texts, "body string")
    schema = T.StructType([T.StructField("k", T.LongType())])
    assert sorted(r["k"] for r in parse_records(df, "body", schema, bad="drop").collect()) == [1, 3]
    lost = {r["rejected"] for r in rejected_records(df, "body", schema).collect()}
    assert lost == {'{"k":"x"}', '[{"k": 2}', None, "7"}
    with pytest.raises(Exception, match="cannot be read"):
        parse_records(df, "body", schema).collect()


def test_broken_requests_are_refused(spark):
    from pyspark.sql import types as T

    from riskloom.session import fresh_dir
    from riskloom.sources.readers import read_records, rejected_requests

    schema = T.StructType([T.StructField("SK_ID_CURR", T.LongType()), T.StructField("AMT_CREDIT", T.DoubleType())])
    whole = fresh_dir(spark, "requests")
    texts = ['[{"SK_ID_CURR": 1, "AMT_CREDIT": 2.5, "x": 1}, {"SK_ID_CURR": 2}]', '{"SK_ID_CURR": 3}', "[{broken", '[{"SK_ID_CURR": "four"}, {"SK_ID_CURR": 5}]']
    for i, text in enumerate(texts):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{whole}/{i}")
    with pytest.raises(Exception):
        read_records(spark, f"{whole}/*", schema).collect()
    kept = read_records(spark, f"{whole}/*", schema, bad="drop")
    assert sorted(kept.collect()) == [(1, 2.5), (2, None), (3, None), (5, None)]
    rejected = rejected_requests(spark, f"{whole}/*", schema)
    assert sorted(r["rejected"].replace(" ", "").strip() for r in rejected.collect()) == sorted(["[{broken", '{"SK_ID_CURR":"four"}'])
    assert sorted(read_records(spark, f"{whole}/[01]", schema).collect()) == [(1, 2.5), (2, None), (3, None)]

    lined = fresh_dir(spark, "lines")
    spark.createDataFrame([(t,) for t in (*texts, "")], "value string").write.text(lined)
    again = read_records(spark, lined, schema, lines=True, bad="drop")
    assert sorted(again.collect()) == sorted(kept.collect())
    assert rejected_requests(spark, lined, schema, lines=True).count() == 2
