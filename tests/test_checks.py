"""Integrity checks Q1-Q4."""

from jobsight.operators.checks import duplicate_keys, nullify_orphans, orphans, over_length


def test_duplicate_keys_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert [(r["k"], r["n"]) for r in duplicate_keys(df, "k").collect()] == [(1, 2)]


def test_orphans_and_set_null(spark):
    fact = spark.createDataFrame([(10, 1), (11, 2), (12, None), (13, 3)], "vacancy_id int, area_id int")
    dim = spark.createDataFrame([(1, "a"), (3, "c"), (None, "z")], "area_id int, name string")
    assert sorted(r["vacancy_id"] for r in orphans(fact, dim, "area_id").collect()) == [11]
    fixed = dict((r["vacancy_id"], r["area_id"]) for r in nullify_orphans(fact, dim, "area_id").collect())
    assert fixed == {10: 1, 11: None, 12: None, 13: 3}


def test_over_length_lists_columns(spark):
    df = spark.createDataFrame([(1, "x" * 256, "RUR"), (2, "ok", "TOOLONGCODE"), (3, "ok", None)], "id int, n string, c string")
    got = {r["id"]: r["violations"] for r in over_length(df, {"n": 255, "c": 10}, ["id"]).collect()}
    assert got == {1: "n", 2: "c"}
