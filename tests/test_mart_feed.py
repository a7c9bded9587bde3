"""Marts from the change feed, SQL names that stay current, deleted dimension rows, duplicates as MERGE sees them."""

import datetime as dt
import glob
import hashlib
import random
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from jobsight.operators.aggregates import group_partials
from jobsight.operators.checks import nullify_orphans
from jobsight.operators.upsert import DUPLICATE, Differs, merge_rows, name_changed
from jobsight.plans import daily_load as D
from jobsight.plans import fact_store as S
from jobsight.plans import mart_feed as M
from jobsight.schemas import DIM_AREA, DIM_CURRENCY, FACT_VACANCY
from jobsight.sinks.versioned import expire_versions, write_version
from jobsight.sources.fixture import landed_pages, vacancy_records
from jobsight.sources.pages import parse_pages
from tests.conftest import SF_SMALL

WIDTH = 10
ROLES = ["Инженер данных", "Аналитик данных", "Data scientist", None]


def _fact_rows(r, ids):
    def money():
        return r.choice([None, Decimal(r.randrange(1, 6) * 100)])

    return [
        (
            i, r.choice(ROLES), r.choice([None, "Senior", "Team Lead"]), r.choice([None, "Junior", "Middle"]), dt.datetime(2023, 11, 1),
            False, r.random() < 0.5, r.choice([None, 1, 2, 3]), r.choice([None, "noExperience"]), r.choice([None, 1, 2]), money(), money(),
            None, r.choice([None, "RUR", "USD"]),
        )
        for i in ids
    ]


def _bag(df):
    cols = sorted(df.columns)
    return sorted((tuple(None if r[c] == 0 and c == "pay" else r[c] for c in cols) for r in df.collect()), key=repr)


def test_groups_follow_random_days(spark, scratch):
    r = random.Random(11)
    looked = []
    found = S.ranges_holding

    def seen(*a):
        looked.append(found(*a))
        return looked[-1]

    S.ranges_holding = seen
    try:
        for day in range(5):
            ids = r.sample(range(60), 45 if day == 0 else 12)
            D.upsert_fact(spark, scratch, spark.createDataFrame(_fact_rows(r, ids), FACT_VACANCY), WIDTH)
            fact = D.read_fact(spark, scratch)
            assert _bag(M.settle(spark, scratch)) == _bag(group_partials(fact, M.KEYS)), day
    finally:
        S.ranges_holding = found
    assert looked and all(looked)  # some bounds left with the rows that held them


def test_references_checked_without_the_fact(spark, scratch, monkeypatch):
    r = random.Random(4)
    for day, areas in enumerate(([(1, "a")], [(1, "a"), (1, "twice"), (None, None), (2, "b")])):
        D.upsert_fact(spark, scratch, spark.createDataFrame(_fact_rows(r, r.sample(range(40), 20)), FACT_VACANCY), WIDTH)
        write_version(spark.createDataFrame(areas, DIM_AREA), scratch, "dim_area")
        write_version(spark.createDataFrame([("RUR", Decimal(1))], DIM_CURRENCY), scratch, "dim_currency")
        want = D.verify(spark, scratch, full=True)
        with monkeypatch.context() as m:
            m.setattr(D, "read_fact", None)  # not to be read
            assert D.verify(spark, scratch) == want
        assert want["unique:dim_area"] == day and want["fk:employer_id"] > 0 and want["fk:salary_currency"] > 0
        assert (want["fk:area_id"] > 0) == (day == 0)
    S.reached(spark, scratch, "writing")
    assert D.verify(spark, scratch) == want  # nothing trusts the counts now: from the fact


def test_a_change_that_did_not_end_is_made_good(spark, scratch):
    r = random.Random(2)
    D.upsert_fact(spark, scratch, spark.createDataFrame(_fact_rows(r, range(30)), FACT_VACANCY), WIDTH)
    rows = S.merge_fact(spark, scratch, spark.createDataFrame(_fact_rows(r, range(5, 9)), FACT_VACANCY), WIDTH)
    S.reached(spark, scratch, "writing")
    S.write_ranges(spark, scratch, rows)  # ... and here the run ended: the groups are those of the day before
    assert S.marked(spark, scratch) and not M.current(spark, scratch)
    D.upsert_fact(spark, scratch, spark.createDataFrame(_fact_rows(r, range(7, 12)), FACT_VACANCY), WIDTH)
    assert _bag(M.settle(spark, scratch)) == _bag(group_partials(D.read_fact(spark, scratch), M.KEYS))


def _two_days(spark):
    recs = vacancy_records(spark, SF_SMALL)
    day2 = recs.where(F.col("id") < 300).withColumns(
        {"salary_from": F.col("salary_from") + 1, "is_open": ~F.col("is_open"), "area_name": F.concat("area_name", F.lit(" (new)"))}
    )
    return [parse_pages(landed_pages(x)) for x in (recs.where("id % 3 > 0"), day2)]


def _same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cols = a.columns
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(*cols).collect()), key=repr)


def test_names_show_the_newest_day_and_deletes_reach_the_fact(spark, scratch):
    day1, day2 = _two_days(spark)
    D.load(spark, day1, root=scratch, strict=False, fact_range_width=100)
    D.register_tables(spark, scratch)
    first = spark.sql("SELECT name FROM core.dim_area WHERE area_id = 1").collect()
    open1 = spark.sql("SELECT sum(cnt_vacancy) AS n FROM data_mart.vacancies").first()["n"]
    D.load(spark, day2, root=scratch, strict=False, fact_range_width=100)
    for dataset in ("staging", "dim_area", "dim_employer", "dim_currency", "mart_stats", "mart_groups"):
        expire_versions(spark, scratch, dataset, keep=1)
    second = spark.sql("SELECT name FROM core.dim_area WHERE area_id = 1").collect()
    assert second != first and second[0]["name"].endswith("(new)")
    assert spark.sql("SELECT sum(cnt_vacancy) AS n FROM data_mart.vacancies").first()["n"] != open1
    fact, dims = D.read_fact(spark, scratch), {k: D.read_stored(spark, scratch, f"dim_{k}") for k in ("area", "employer")}
    from jobsight.plans.marts import MARTS, build_mart

    for name in ("mart_de_region", "mart_da_employer", "mart_vacancies"):
        full = build_mart(name, fact, D.read_stored(spark, scratch, "dim_currency"), dims)
        _same(spark.table(f"data_mart.{MARTS[name].view}"), full)
        _same(D.marts(spark, scratch, [MARTS[name].view])[MARTS[name].view], full)
    _same(spark.sql("SELECT * FROM mart_region('Data scientist')"), spark.table("data_mart.ds_region"))

    # Deleting an area: the fact's references become NULL, in the ranges that hold it only.
    before = {p: hashlib.md5(open(p, "rb").read()).hexdigest() for p in glob.glob(f"{scratch}/fact_vacancy/*/*.parquet")}
    rare = fact.groupBy("area_id").count().where("area_id is not null").orderBy("count").first()["area_id"]
    want = nullify_orphans(fact, dims["area"].where(F.col("area_id") != rare), "area_id").checkpoint()
    keys = spark.createDataFrame([(rare,), (None,)], "area_id int")
    ranges = D.delete_dimension_rows(spark, scratch, "dim_area", keys)
    _same(D.read_fact(spark, scratch), want)
    after = {p: hashlib.md5(open(p, "rb").read()).hexdigest() for p in glob.glob(f"{scratch}/fact_vacancy/*/*.parquet")}
    changed = {p.split("id_range=")[1].split("/")[0] for p in before if after.get(p) != before[p]}
    assert ranges and changed == {str(x) for x in ranges} and len(changed) < len({p.split("/")[-2] for p in before})
    assert spark.sql(f"SELECT * FROM core.dim_area WHERE area_id = {rare}").count() == 0
    full = build_mart("mart_vacancies", want, D.read_stored(spark, scratch, "dim_currency"), dims)
    _same(spark.table("data_mart.vacancies"), full)
    assert set(D.verify(spark, scratch).values()) == {0}


# ------------------------------------------------------- duplicates as MERGE
def _duck_merge(target, source, changed, unique):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t (k INT{' UNIQUE' if unique else ''}, name VARCHAR)")
    con.execute("CREATE TABLE s (k INT, name VARCHAR)")
    for name, rows in (("t", target), ("s", source)):
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    cond = " AND coalesce(t.name, '') <> coalesce(s.name, '')" if changed else ""
    try:
        con.execute(
            f"MERGE INTO t USING s ON t.k = s.k WHEN MATCHED{cond} THEN UPDATE SET name = s.name WHEN NOT MATCHED THEN INSERT VALUES (s.k, s.name)"
        )
    except duckdb.Error:
        return None
    return sorted(con.execute("SELECT * FROM t").fetchall(), key=repr)


CASES = [
    ([(1, "a")], [(1, "b"), (1, "c")]),  # two updates
    ([(1, "a")], [(1, "a"), (1, "c")]),  # one of them changes nothing
    ([(1, "a")], [(1, "a"), (1, "a")]),
    ([(1, "a")], [(1, "a"), (1, "a"), (1, "b")]),
    ([(1, "a")], [(1, "a"), (1, "b"), (1, "b")]),
    ([(1, None)], [(1, ""), (1, None), (1, "b")]),
    ([(1, "b")], [(1, "a"), (1, "b"), (1, "c")]),
    ([(2, "a")], [(1, "b"), (1, "c")]),  # two inserts
    ([(None, "a"), (3, "z")], [(None, "b"), (None, "c"), (3, "y")]),
    ([], [(1, "a"), (2, "b")]),
]


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("changed", [name_changed, Differs()])
def test_merge_errs_where_merge_errs(spark, changed, unique):
    r = random.Random(5)
    names = [None, "", "a", "b"]
    cases = CASES + [
        ([(k, r.choice(names)) for k in range(3)], [(r.randrange(4), r.choice(names)) for _ in range(r.randrange(5))]) for _ in range(8)
    ]
    schema = "k int, name string"
    for target, source in cases:
        want = _duck_merge(target, source, changed.value is not None, unique)
        t, s = (spark.createDataFrame(x, schema).coalesce(1) for x in (target, source))
        try:
            got = sorted((tuple(x) for x in merge_rows(t, s, "k", changed, "merge", unique).select("k", "name").collect()), key=repr)
        except Exception as e:  # noqa: BLE001 - raised on an executor
            assert DUPLICATE in str(e), e
            got = None
        assert got == want, (target, source)


def test_merge_is_one_join_and_no_extra_shuffle(spark):
    t = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("name"))
    plan = merge_rows(t, t.where("k % 2 = 0"), "k", name_changed, "merge", True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 2 and plan.count("Join") == 1, plan
