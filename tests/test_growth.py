"""What a task holds and what a load computes again do not grow faster than the rows."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from jobsight.operators.aggregates import grain_stats_sets, group_partials, partial_stats_sets
from jobsight.operators.candidates import fact_candidates
from jobsight.operators.checks import duplicate_keys
from jobsight.plans import mart_feed as M
from jobsight.plans.marts import MART_GRAINS
from jobsight.schemas import DIM_CURRENCY, FACT_VACANCY
from jobsight.sinks.versioned import refresh
from jobsight.sources import fixture


def _tables(spark, root, n):
    day = dt.datetime(1998, 8, 1)
    orders = [(i, i % 7, "F" if i % 2 else "O", 5000.0 + i, day, "3-MEDIUM") for i in range(n)]
    columns = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(orders, columns).write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame([(i, f"c{i}", i % 3) for i in range(7)], "c_custkey bigint, c_name string, c_nationkey int").write.parquet(f"{root}/customer.parquet")
    spark.createDataFrame([(i, f"n{i}") for i in range(3)], "n_nationkey int, n_name string").write.parquet(f"{root}/nation.parquet")


def test_tasks_are_dealt_a_number_of_rows(spark, scratch, monkeypatch):
    _tables(spark, scratch, 120)
    monkeypatch.setattr(fixture, "DEALT_ROWS", 10)
    df = duplicate_keys(fact_candidates(fixture.duplicated_batch(fixture.vacancy_records(spark, scratch))), "vacancy_id")
    rows = df.collect()
    assert sorted(r["vacancy_id"] for r in rows) == [i for i in range(120) if i % 9 != 8 and i % 11 not in (1, 2, 3)] and {r["n"] for r in rows} == {2}
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Both aggregations work on the dealt parts: as many as the rows ask for, no shuffle of their own.
    assert "hashpartitioning(o_orderkey" in plan and ", 12), REPARTITION_BY_NUM" in plan, plan
    assert "hashpartitioning(id" not in plan and "hashpartitioning(vacancy_id" not in plan, plan


def _fact(spark, n, seed):
    r = random.Random(seed)
    rows = [
        (
            i, r.choice(["Data scientist", "Инженер данных", None]), r.choice([None, "Senior", "Team Lead"]), r.choice([None, "Junior"]),
            dt.datetime(2023, 11, 1), False, r.random() < 0.5, r.choice([None, 1, 2, 3]), None, r.choice([None, 1, 2]),
            r.choice([None, Decimal(r.randrange(1, 9) * 100)]), r.choice([None, Decimal(r.randrange(1, 9) * 100)]), None,
            r.choice([None, "RUR", "USD", "XXX", "NEG"]),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, FACT_VACANCY)


def test_figures_of_a_fine_grain_shuffle_its_groups_once(spark, scratch):
    fact = _fact(spark, 300, 3)
    rates = spark.createDataFrame([("RUR", Decimal(1)), ("USD", Decimal(90)), ("NEG", Decimal(-2)), (None, Decimal(5))], DIM_CURRENCY)
    rates = refresh(rates, scratch, "dim_currency")  # as the load has it: its size is known
    want, got = grain_stats_sets(fact, rates, MART_GRAINS), partial_stats_sets(group_partials(fact, M.KEYS).checkpoint(), rates, MART_GRAINS)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum("hashpartitioning" in line and "employer_id" in line for line in plan.split("\n")) == 1, plan


def test_a_group_replaced_whole_is_not_looked_for(spark):
    def images(rows):
        return M.graded(spark.createDataFrame(rows, FACT_VACANCY))

    def row(i, employer, frm):
        return (i, "Data scientist", None, "Junior", dt.datetime(2023, 11, 1), False, True, employer, None, 1, frm, None, None, "RUR")

    old, new = [row(1, 1, Decimal(5)), row(2, 2, Decimal(5)), row(3, 2, Decimal(7))], [row(1, 1, Decimal(6)), row(2, 2, Decimal(6))]
    groups = group_partials(spark.createDataFrame(old, FACT_VACANCY), M.KEYS).withColumn(M.LOST, F.lit(False))
    before = images(old).select(F.col("vacancy_id"), F.struct(*M.S.IMAGE).alias("_before"))
    changed = images(new).drop("_grade").join(before, "vacancy_id").withColumn("_op", F.lit("update"))
    got = {r["employer_id"]: r for r in M.apply_delta(groups, M.delta(changed)).collect()}
    assert (got[1]["lo_from"], got[1]["hi_from"], got[1]["n"], got[1][M.LOST]) == (6, 6, 1, False)
    # Employer 2 keeps a row that did not change: only the fact can tell its least amount.
    assert (got[2]["n"], got[2][M.LOST]) == (2, True)
