"""Two-day load end to end, and the same load driven by a file stream."""

import glob
import json
import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

from jobsight.operators.candidates import as_dim, dim_candidates, fact_candidates
from jobsight.operators.normalise import distinct_records, normalise
from jobsight.operators.upsert import upsert_table
from jobsight.plans import daily_load as D
from jobsight.plans.marts import mart
from jobsight.sources.fixture import day1_batch, landed_pages, vacancy_records
from jobsight.sources.pages import flatten_pages, parse_pages
from jobsight.streaming.landing import start_landing_ingest
from tests.conftest import SF_SMALL

WIDTH = 100  # ids per fact partition: several partitions at sf0.001


def _staged(pages):
    return distinct_records(normalise(flatten_pages(pages)))


def _as_set(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def _batches(spark):
    recs = vacancy_records(spark, SF_SMALL)
    day1 = day1_batch(recs)
    # Day 2 re-publishes ids below 300 with new salaries and status, plus new ones.
    day2 = recs.where(F.col("id") < 300).withColumns(
        {"salary_from": F.col("salary_from") + 1, "is_open": ~F.col("is_open")}
    )
    return parse_pages(landed_pages(day1)), parse_pages(landed_pages(day2))


def _partition_files(root):
    return {
        os.path.basename(os.path.dirname(p)): os.path.basename(p)
        for p in glob.glob(f"{root}/fact_vacancy/id_range=*/*.parquet")
    }


def test_two_day_load(spark, scratch):
    pages1, pages2 = _batches(spark)
    with pytest.raises(D.BatchRejected):
        D.load(spark, pages1, root=scratch)  # fixture items lack keys on purpose

    D.load(spark, pages1, root=scratch, strict=False, fact_range_width=WIDTH)
    before = _partition_files(scratch)
    D.load(spark, pages2, root=scratch, strict=False, fact_range_width=WIDTH)
    after = _partition_files(scratch)

    # Only the partitions holding day-2 ids (< 300) were rewritten.
    touched = {k for k in after if int(k.split("=")[1]) < 3}
    assert touched and all(after[k] != before.get(k) for k in touched)
    assert all(after[k] == before[k] for k in after if k not in touched)

    st1, st2 = _staged(pages1), _staged(pages2)
    expected_fact = upsert_table("fact_vacancy", fact_candidates(st1), fact_candidates(st2))
    cols = ["vacancy_id", "vacancy_name", "grade", "salary_from", "is_open", "area_id"]
    assert _as_set(D.read_fact(spark, scratch), cols) == _as_set(expected_fact, cols)

    area1 = as_dim(dim_candidates(st1, "area_id", "area_name"), "area_id", "area_name")
    area2 = as_dim(dim_candidates(st2, "area_id", "area_name"), "area_id", "area_name")
    expected_area = upsert_table("dim_area", area1, area2)
    assert _as_set(D.read_stored(spark, scratch, "dim_area"), ["area_id", "name"]) == _as_set(
        expected_area, ["area_id", "name"]
    )
    # Two runs logged; NULL area keys accumulate one row per run.
    assert spark.read.parquet(f"{scratch}/setup").count() == 2
    assert D.read_stored(spark, scratch, "dim_area").where(F.col("area_id").isNull()).count() == 2

    assert set(D.verify(spark, scratch).values()) == {0}

    views = D.marts(spark, scratch)
    stored = views["de_region"]
    direct = mart(
        expected_fact,
        D.read_stored(spark, scratch, "dim_currency"),
        "area_id",
        "Инженер данных",
        D.read_stored(spark, scratch, "dim_area"),
        "area_name",
    )
    assert _as_set(stored, stored.columns) == _as_set(direct, stored.columns)
    assert spark.sql("SELECT count(*) FROM de_region").first()[0] == stored.count()

    # The reference's schema-qualified names work in Spark SQL.
    names = D.register_tables(spark, scratch)
    assert "core.fact_vacancy" in names and "data_mart.vacancies" in names
    assert spark.sql("SELECT count(*) FROM core.fact_vacancy").first()[0] == D.read_fact(spark, scratch).count()
    assert _as_set(spark.table("data_mart.de_region"), stored.columns) == _as_set(stored, stored.columns)
    joined = spark.sql(
        "SELECT v.vacancy_name, count(*) AS n, count(c.to_rub) AS priced "
        "FROM core.fact_vacancy AS v LEFT JOIN core.dim_currency AS c ON v.salary_currency = c.currency_id "
        "GROUP BY v.vacancy_name"
    )
    assert sum(r["n"] for r in joined.collect()) == D.read_fact(spark, scratch).count()


def test_stream_runs_the_same_load(spark, scratch):
    pages1, pages2 = _batches(spark)
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    root = os.path.join(scratch, "wh")

    def land(pages, tag):
        out = os.path.join(scratch, f"out-{tag}")
        pages.select(F.to_json(F.struct("page", "pages", "found", "items")).alias("value")).write.text(out)
        for i, f in enumerate(sorted(glob.glob(f"{out}/part-*"))):
            shutil.copy(f, os.path.join(landing, f"{tag}-{i}.json"))

    def run():
        q = start_landing_ingest(spark, landing, root=root, strict=False, fact_range_width=WIDTH)
        q.awaitTermination(300)
        assert q.exception() is None

    land(pages1, "d1")
    run()
    n1 = D.read_fact(spark, root).count()
    land(pages2, "d2")
    run()
    fact = D.read_fact(spark, root)
    assert n1 > 0 and fact.count() == n1 + _count_new(spark, pages1, pages2)
    st2 = _staged(pages2).select(F.col("id").alias("vacancy_id"), F.col("is_open").alias("want"))
    assert fact.join(st2, "vacancy_id").where(F.col("is_open") != F.col("want")).count() == 0
    assert spark.read.parquet(f"{root}/setup").count() == 2


def _count_new(spark, pages1, pages2):
    ids1 = _staged(pages1).select("id")
    return _staged(pages2).select("id").join(ids1, "id", "left_anti").count()


def test_command_line(spark, scratch):
    from jobsight.__main__ import main

    pages1, _ = _batches(spark)
    landing = os.path.join(scratch, "landing")
    pages1.select(F.to_json(F.struct("page", "pages", "found", "items")).alias("value")).write.text(landing)
    root = os.path.join(scratch, "wh")
    main(["load", "--pages", landing, "--root", root, "--lenient"])
    main(["marts", "--root", root, "--out", os.path.join(scratch, "marts")])
    written = spark.read.parquet(os.path.join(scratch, "marts", "de_region"))
    assert written.count() > 0 and len(written.columns) == 32
    main(["verify", "--root", root])  # exits non-zero on a violation
    stream_root = os.path.join(scratch, "stream-wh")
    main(["stream", "--landing", landing, "--root", stream_root, "--lenient"])
    assert D.read_fact(spark, stream_root).count() == D.read_fact(spark, root).count()
    out = os.path.join(scratch, "sql-out")
    main(["sql", "SELECT area_id, cnt_vacancy FROM data_mart.de_region", "--root", root, "--out", out])
    assert spark.read.parquet(out).count() == written.count()
    assert sorted(os.listdir(os.path.join(scratch, "marts"))) == sorted(
        ["de_region", "da_region", "ds_region", "de_employer", "da_employer", "ds_employer", "vacancies"]
    )


def test_strict_load_rejects_pages_without_items(spark, scratch):
    pages = parse_pages(spark.createDataFrame([('{"page": 3}',)], "value string"))
    with pytest.raises(D.BatchRejected, match="pages without items"):
        D.load(spark, pages, root=scratch)


ITEM = {"id": "1", "name": "Data Engineer", "published_at": "2023-11-01T10:00:00+0300", "archived": False,
        "type": {"id": "open"}, "employer": {"id": "5", "name": "E"}, "experience": {"id": "noExperience", "name": "none"},
        "area": {"id": "1", "name": "A"}, "salary": None}


def _pages_of(spark, *items):
    return parse_pages(spark.createDataFrame([(json.dumps({"page": 0, "items": list(items)}),)], "value string"))


def test_lookback_prunes_landing_folders(spark, scratch):
    from jobsight.sources.pages import read_pages

    landing = os.path.join(scratch, "landing")
    for day, pid, at in (("2023-09-01", "1", "2023-09-01"), ("2023-10-01", "2", "2023-10-02"), ("2023-11-01", "3", "2023-11-01")):
        d = os.path.join(landing, f"date={day}")
        os.makedirs(d)
        with open(os.path.join(d, "p.json"), "w") as f:
            f.write(json.dumps({"page": 0, "items": [dict(ITEM, id=pid, published_at=f"{at}T01:00:00+0300")]}) + "\n")
    pages = read_pages(spark, landing)
    # First run: a 30-day window ending 2023-11-01, and a day of margin for the folders.
    kept = D.lookback_landing(pages, "2023-11-01", has_bookmark=False)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(date#\d+\), \(date#\d+ >= 2023-10-01\)\]", plan), plan
    assert kept.count() == 2
    # The item of local time 2023-10-02 01:00 lies in the folder of the day before, by its UTC time: it stays.
    for name, option in (("pruned", "date"), ("all", None)):
        root = os.path.join(scratch, name)
        D.load(spark, pages, root=root, as_of="2023-11-01", landing_date=option)
        assert sorted(r["vacancy_id"] for r in D.read_fact(spark, root).collect()) == [2, 3]


def test_default_load_keeps_every_title_the_rules_know(spark, scratch):
    names = ["Дата-инженер", "data инженер", "Data  Engineer", "Python developer"]
    D.load(spark, _pages_of(spark, *[dict(ITEM, id=str(i), name=n) for i, n in enumerate(names)]), root=scratch)
    assert D.read_fact(spark, scratch).count() == 4
    from jobsight.functions.classify import title_matches_any

    df = spark.createDataFrame([(n,) for n in names], "t string")
    assert [r[0] for r in df.select(title_matches_any("t")).collect()] == [True, False, True, False]


def test_unreadable_tables_raise_and_keep_their_rows(spark, scratch):
    """A stray folder that makes a listing invalid must not count as an empty table."""
    D.load(spark, _pages_of(spark, *[dict(ITEM, id=str(i)) for i in range(20)]), root=scratch)
    before = D.read_fact(spark, scratch).count()
    later = _pages_of(spark, dict(ITEM, id="3", name="Data Analyst"))
    for table, broken in (
        ("fact", f"{scratch}/fact_vacancy/id_range=0/part-00000-broken.snappy.parquet"),
        ("dims", f"{scratch}/_manifest/dim_area/x/part-00000-broken.snappy.parquet"),
        ("run log", f"{scratch}/setup/part-00000-broken.snappy.parquet"),
    ):
        os.makedirs(os.path.dirname(broken), exist_ok=True)
        with open(broken, "w") as f:
            f.write("not parquet")
        with pytest.raises(Exception):  # noqa: B017 - whatever the reader says
            D.load(spark, later, root=scratch, as_of="2023-11-02")
        os.replace(broken, os.path.join(scratch, f"was-broken-{table}"))
        assert D.read_fact(spark, scratch).count() == before


def test_rejected_batches_write_nothing(spark, scratch):
    root = os.path.join(scratch, "wh")
    twice = _pages_of(spark, ITEM, dict(ITEM, name="Data Analyst"))
    with pytest.raises(D.BatchRejected, match="vacancy_id"):
        D.load(spark, twice, root=root)
    renamed = _pages_of(spark, ITEM, dict(ITEM, id="2", area={"id": "1", "name": "B"}))
    with pytest.raises(D.BatchRejected, match="area_id"):
        D.load(spark, renamed, root=root)
    assert not os.path.exists(root)
    D.load(spark, twice, root=root, on_duplicate="allow")  # as the reference's fact on first insert
    assert D.read_fact(spark, root).count() == 2


def test_a_replayed_stream_batch_is_skipped(spark, scratch):
    from jobsight.streaming.landing import EPOCHS, epoch_done

    assert not epoch_done(spark, scratch, "c", 0)
    spark.createDataFrame([("c", 0)], EPOCHS).write.parquet(f"{scratch}/_epochs")
    assert epoch_done(spark, scratch, "c", 0) and not epoch_done(spark, scratch, "c", 1) and not epoch_done(spark, scratch, "d", 0)


def test_old_versions_expire(spark, scratch):
    from jobsight.sinks.versioned import current_path, expire_versions, write_version

    paths = [write_version(spark.range(i), scratch, "t") for i in range(1, 5)]
    assert sorted(expire_versions(spark, scratch, "t", keep=2)) == sorted(paths[:2])
    assert current_path(spark, scratch, "t") == paths[3] and spark.read.parquet(paths[2]).count() == 3
    assert not os.path.exists(paths[0])


def test_roots_off_local_mode_must_be_set(monkeypatch, spark):
    import jobsight.session as S

    monkeypatch.setattr(S, "_is_local", lambda _: False)
    with pytest.raises(RuntimeError, match="warehouse"):
        S.warehouse_root(spark)


def test_strict_load_rejects_over_long_values(spark, scratch):
    item = {"id": "1", "name": "x" * 256, "published_at": "2023-11-01T10:00:00+0300", "archived": False,
            "type": {"id": "open"}, "employer": {"id": "5", "name": "E"}, "experience": {},
            "area": {}, "salary": None}
    pages = parse_pages(spark.createDataFrame([(json.dumps({"page": 0, "items": [item]}),)], "value string"))
    with pytest.raises(D.BatchRejected, match="column lengths"):
        D.load(spark, pages, root=os.path.join(scratch, "wh"))


def test_stream_backlog_in_bounded_batches_converges(spark, scratch):
    pages1, _ = _batches(spark)
    landing = os.path.join(scratch, "landing")
    out = os.path.join(scratch, "out")
    pages1.select(F.to_json(F.struct("page", "items")).alias("value")).repartition(3).write.text(out)
    os.makedirs(landing)
    for i, f in enumerate(sorted(glob.glob(f"{out}/part-*"))):
        shutil.copy(f, os.path.join(landing, f"p{i}.json"))
    root = os.path.join(scratch, "wh")
    q = start_landing_ingest(
        spark, landing, root=root, strict=False, fact_range_width=WIDTH, max_files_per_trigger=1
    )
    q.awaitTermination(300)
    assert q.exception() is None
    runs = spark.read.parquet(f"{root}/setup").count()
    assert runs == 3  # one load per file
    expected = fact_candidates(_staged(pages1))
    cols = ["vacancy_id", "vacancy_name", "grade", "salary_from", "is_open", "area_id"]
    assert _as_set(D.read_fact(spark, root), cols) == _as_set(expected, cols)
