"""SCD-1 upsert rules (FIXTURES §3.1) and properties."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from jobsight.operators.upsert import DuplicateKeyError, always, name_changed, rate_changed, upsert

DIM = "k int, name string"


def _sorted(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((v is None, v) for v in t))


def test_golden_merge(spark):
    target = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (None, "old")], DIM)
    source = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d"), (None, "new"), (3, "")], DIM)
    got = _sorted(upsert(target, source, "k", name_changed), ["k", "name"])
    assert got == [(1, "a"), (2, "b"), (3, ""), (4, "d"), (None, "new"), (None, "old")]


def test_null_and_empty_names_are_equal(spark):
    target = spark.createDataFrame([(2, None)], DIM)
    source = spark.createDataFrame([(2, "")], DIM)
    assert _sorted(upsert(target, source, "k", name_changed), ["k", "name"]) == [(2, None)]


def test_duplicate_source_keys_raise(spark):
    target = spark.createDataFrame([(1, "a")], DIM)
    source = spark.createDataFrame([(1, "x"), (1, "y")], DIM)
    with pytest.raises(DuplicateKeyError):
        upsert(target, source, "k", name_changed)


def test_currency_rule_is_not_null_safe(spark):
    schema = "currency_id string, to_rub decimal(12,6)"
    target = spark.createDataFrame([("A", None), ("B", Decimal(90)), ("C", Decimal(80))], schema)
    source = spark.createDataFrame([("A", Decimal(90)), ("B", None), ("C", Decimal(90))], schema)
    got = dict(upsert(target, source, "currency_id", rate_changed).collect())
    assert got == {"A": None, "B": Decimal("90.000000"), "C": Decimal("90.000000")}


def test_missing_target_columns_keep_or_null(spark):
    target = spark.createDataFrame([(1, "a", True)], "k int, name string, flag boolean")
    source = spark.createDataFrame([(1, "b"), (2, "c")], DIM)
    got = _sorted(upsert(target, source, "k", name_changed), ["k", "name", "flag"])
    assert got == [(1, "b", True), (2, "c", None)]


def test_fact_rule_overwrites_and_never_deletes(spark):
    target = spark.createDataFrame([(1, "a"), (5, "e")], DIM)
    source = spark.createDataFrame([(1, "a2")], DIM)
    assert _sorted(upsert(target, source, "k", always), ["k", "name"]) == [(1, "a2"), (5, "e")]


def test_upsert_twice_equals_once_on_non_null_keys(spark):
    target = spark.range(0, 300).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    source = spark.range(200, 500).select(
        F.col("id").cast("int").alias("k"), F.concat(F.lit("m"), (F.col("id") % 3)).alias("name")
    )
    once = upsert(target, source, "k", name_changed)
    twice = upsert(once, source, "k", name_changed)
    assert _sorted(once, ["k", "name"]) == _sorted(twice, ["k", "name"])
    assert once.count() == 500


def test_null_keys_accumulate_per_run(spark):
    target = spark.createDataFrame([(None, "x")], DIM)
    source = spark.createDataFrame([(None, "x")], DIM)
    once = upsert(target, source, "k", name_changed)
    assert once.where(F.col("k").isNull()).count() == 2


def test_duplicate_target_rows_are_all_updated(spark):
    # The fact has no unique key: a key held twice by the target takes the
    # source values in both rows (many target rows per source row is legal).
    target = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], DIM)
    source = spark.createDataFrame([(1, "z")], DIM)
    got = _sorted(upsert(target, source, "k", always), ["k", "name"])
    assert got == [(1, "z"), (1, "z"), (2, "b")]


def test_allow_mode_inserts_duplicate_source_rows(spark):
    target = spark.createDataFrame([(2, "b")], DIM)
    source = spark.createDataFrame([(1, "x"), (1, "y")], DIM)
    got = _sorted(upsert(target, source, "k", always, on_duplicate="allow"), ["k", "name"])
    assert got == [(1, "x"), (1, "y"), (2, "b")]
    with pytest.raises(ValueError):
        upsert(target, source, "k", always, on_duplicate="ignore")
