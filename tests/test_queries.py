import __spark_entry__ as entry_points


def test_every_oracle_has_a_query():
    queries = entry_points.queries()
    assert set(entry_points.oracle_sql()) <= set(queries)
    assert len(queries) >= 55


def test_flagship_query_has_rows(spark):
    found = entry_points.entry(spark).collect()
    assert [r["feature"] for r in sorted(found)] == [
        "lang", "source", "n_chars", "space_ratio", "digit_ratio", "uniq_ratio", "upper_ratio", "dot_ratio"
    ]
