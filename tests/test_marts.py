"""Mart semantics on hand rows (FIXTURES §3.4) and the distributed numbering."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from jobsight.operators.numbering import numbered
from jobsight.plans.marts import mart
from jobsight.schemas import DIM_AREA, DIM_CURRENCY, FACT_VACANCY

DE = "Инженер данных"
TS = dt.datetime(2023, 11, 1)


def _fact(spark, rows):
    full = [
        (i, role, grade, None, TS, False, is_open, None, None, area, frm, to, False, cur)
        for i, (role, grade, is_open, area, frm, to, cur) in enumerate(rows)
    ]
    return spark.createDataFrame(full, FACT_VACANCY)


def _d(x):
    return None if x is None else Decimal(x)


def test_golden_region_mart(spark):
    fact = _fact(
        spark,
        [
            (DE, "Junior", True, 1, _d(100), None, "RUR"),
            (DE, "Junior", False, 1, _d(50), _d(200), "RUR"),
            (DE, "Junior", True, 1, None, None, "RUR"),
            (DE, "Junior", True, None, _d(10), _d(20), "RUR"),
            (DE, "Junior", True, 2, _d(10), _d(20), "EUR"),
            (DE, "Junior", True, 3, _d(300), None, "RUR"),
            ("Аналитик данных", "Junior", True, 1, _d(1), _d(1), "RUR"),
        ],
    )
    currency = spark.createDataFrame([("RUR", Decimal(1)), ("USD", Decimal(90))], DIM_CURRENCY)
    areas = spark.createDataFrame([(1, "A1"), (2, "A2"), (3, "A3")], DIM_AREA)
    out = {r["area_id"]: r.asDict() for r in mart(fact, currency, "area_id", DE, areas, "area_name").collect()}
    a1 = out[1]
    assert (a1["cnt_vacancy"], a1["cnt_vac_salary"], a1["cnt_junior"], a1["cnt_intern"]) == (2, 2, 3, None)
    assert a1["avg_sal_jun"] == Decimal("150.00")
    assert a1["min_sal_jun"] == Decimal(50) and a1["max_sal_jun"] == Decimal(200)
    assert (a1["min_salary"], a1["max_salary"]) == (Decimal(50), Decimal(200))
    assert a1["ratio_sal_jun"] == Decimal("0.75") and a1["ratio_sal_intern"] is None
    # NULL area: counts kept, stats blank.
    none = out[None]
    assert none["cnt_vacancy"] == 1 and none["cnt_vac_salary"] == 1
    assert none["avg_sal_jun"] is None and none["min_salary"] is None and none["ratio_sal_jun"] is None
    # Unlisted currency: counted, no stats.
    assert out[2]["cnt_vac_salary"] == 1 and out[2]["avg_sal_jun"] is None and out[2]["max_salary"] is None
    # Upper bound missing: average from the lower bound, no maximum, no ratio.
    assert out[3]["avg_sal_jun"] == Decimal("300.00") and out[3]["max_salary"] is None
    assert out[3]["ratio_sal_jun"] is None
    # Numbering follows the key, NULL last.
    assert [out[k]["id"] for k in (1, 2, 3, None)] == [1, 2, 3, 4]


def test_orphan_keys_fall_into_null_rows(spark):
    fact = _fact(
        spark,
        [
            (DE, "Junior", True, 1, _d(10), _d(20), "RUR"),
            (DE, "Junior", True, 8, _d(10), _d(20), "RUR"),  # orphan
            (DE, "Junior", True, 9, _d(10), _d(20), "RUR"),  # orphan, same stats as 8
            (DE, "Junior", True, None, _d(10), _d(20), "RUR"),
        ],
    )
    currency = spark.createDataFrame([("RUR", Decimal(1))], DIM_CURRENCY)
    areas = spark.createDataFrame([(1, "A1")], DIM_AREA)
    got = mart(fact, currency, "area_id", DE, areas, "area_name").collect()
    null_rows = sorted((r["cnt_vacancy"], r["avg_sal_jun"]) for r in got if r["area_id"] is None)
    # Orphans 8 and 9 share their stats and merge; the NULL key has blank stats.
    assert null_rows == [(1, None), (2, Decimal("20.00"))]


def test_zero_max_salary_raises(spark):
    fact = _fact(spark, [(DE, "Junior", True, 1, _d(0), _d(0), "RUR")])
    currency = spark.createDataFrame([("RUR", Decimal(1))], DIM_CURRENCY)
    with pytest.raises(Exception):
        mart(fact, currency, "area_id", DE).collect()


def test_numbering_is_dense_and_ordered_across_partitions(spark):
    df = spark.range(0, 5000, 1, 13).select(((F.col("id") * 7919) % 5000).alias("k"))
    out = numbered(df, [F.col("k").asc_nulls_last()]).collect()
    assert sorted(r["id"] for r in out) == list(range(1, 5001))
    assert all(r["id"] == r["k"] + 1 for r in out)


def test_publish_equals_single_marts(spark):
    from jobsight.plans.catalog import star
    from jobsight.plans.marts import MARTS, build_mart, publish

    s = star(spark, "/root/testdata/sf0.001")
    views = publish(spark, s.fact, s.currency, s.dims)
    for name, spec in MARTS.items():
        one = build_mart(name, s.fact, s.currency, s.dims)
        cols = one.columns
        assert views[spec.view].columns == cols
        a = sorted(tuple(r) for r in views[spec.view].collect())
        b = sorted(tuple(r) for r in one.collect())
        assert a == b, name
        assert spark.table(spec.view).count() == len(b)
