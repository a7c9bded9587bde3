"""Plan shapes that carry the scale properties (checked on the physical plan)."""

import re

from jobsight.operators.upsert import name_changed, upsert
from jobsight.plans import daily_load as D
from jobsight.plans.marts import per_key
from jobsight.sources.fixture import landed_pages, vacancy_records
from jobsight.sources.pages import parse_pages
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _stored_star(spark, root):
    D.load(spark, parse_pages(landed_pages(vacancy_records(spark, SF_SMALL))), root=root, strict=False)
    return D.read_fact(spark, root), D.read_stored(spark, root, "dim_currency")


def test_mart_fact_side(spark, scratch):
    fact, currency = _stored_star(spark, scratch)
    plan = _plan(per_key(fact, currency, "employer_id", "Инженер данных"))
    # The role filter reaches the Parquet scan and only needed columns are read.
    assert re.search(r"PushedFilters: \[IsNotNull\(vacancy_name\), EqualTo\(vacancy_name,Инженер данных\)\]", plan)
    assert "is_archive" not in plan.split("ReadSchema:")[1].split("\n")[0]
    # The fact is pre-aggregated per (key, currency) before its only shuffle.
    first_exchange = plan.rfind("Exchange hashpartitioning(employer_id")
    assert "partial_sum" in plan[first_exchange:]
    assert "SortMergeJoin" not in plan.split("Exchange hashpartitioning(employer_id")[-1]


def test_upsert_keeps_null_keys_out_of_the_join(spark):
    t = spark.createDataFrame([(1, "a"), (None, "x")], "k int, name string")
    s = spark.createDataFrame([(1, "b"), (None, "y")], "k int, name string")
    plan = _plan(upsert(t, s, "k", name_changed))
    join_part = plan[plan.find("Join") :]
    assert "isnotnull(k" in join_part
    assert "Union" in plan


def test_fact_upsert_reads_only_touched_ranges(spark, scratch):
    """Through ``upsert_fact``: files of the other ranges cannot be read, and the merge does not mind."""
    import glob
    import os

    from pyspark.sql import functions as F

    recs = vacancy_records(spark, SF_SMALL)
    D.load(spark, parse_pages(landed_pages(recs)), root=scratch, strict=False, fact_range_width=100)
    source = D.read_fact(spark, scratch).where(F.col("vacancy_id") < 250).withColumn("grade", F.lit("X")).checkpoint()
    n = D.read_fact(spark, scratch).count()
    target = D.touched_partitions(spark, scratch, source, 100)
    ranges = {os.path.basename(os.path.dirname(f)) for f in target.inputFiles()}
    assert ranges == {"id_range=0", "id_range=1", "id_range=2"}
    others = [f for f in glob.glob(f"{scratch}/fact_vacancy/id_range=*/*.parquet") if os.path.basename(os.path.dirname(f)) not in ranges]
    held = {f: open(f, "rb").read() for f in others}
    for f in others:
        with open(f, "wb") as out:
            out.write(b"unreadable")
    D.upsert_fact(spark, scratch, source, 100)
    for f, raw in held.items():
        with open(f, "wb") as out:
            out.write(raw)
    fact = D.read_fact(spark, scratch)
    assert fact.count() == n and fact.where("grade = 'X'").count() == source.count()


def test_rouble_conversion_does_not_shuffle_the_fact(spark):
    from jobsight.plans.catalog import QUERIES

    df = QUERIES["salary_rub"](spark, SF_SMALL)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "hashpartitioning(salary_currency" not in final


def test_lookback_reaches_the_source_scan(spark):
    import __spark_entry__ as E

    plan = _plan(E.queries()["ingest_lookback"](spark, SF_SMALL))
    scan = next(line for line in plan.split("\n") if "FileScan parquet [o_orderkey" in line)
    assert "GreaterThanOrEqual(o_orderdate" in scan
    assert "o_totalprice" not in scan.split("ReadSchema:")[1]


def test_hot_key_beyond_broadcast_is_split_by_aqe(spark):
    """A third of the fact on one key, broadcasts disabled: AQE splits the hot partition."""
    from pyspark.sql import functions as F

    from jobsight.operators.checks import nullify_orphans

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500 + 2).cast("int")
        fact = spark.range(30000).select(F.col("id").alias("vacancy_id"), hot.alias("area_id"))
        dim = spark.range(1, 400).select(F.col("id").cast("int").alias("area_id"), F.lit("x").alias("name"))
        out = nullify_orphans(fact, dim, "area_id")
        rows = out.collect()
        assert "SortMergeJoin(skew=true)" in _plan(out)
        assert len(rows) == 30000 and sum(r["area_id"] is None for r in rows) == 30000 - fact.where("area_id < 400").count()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_mart_aggregates_run_in_whole_stage_codegen(spark):
    from jobsight.operators.aggregates import grain_stats
    from jobsight.plans.catalog import star

    s = star(spark, SF_SMALL)
    df = grain_stats(s.fact, s.currency, "employer_id")
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    aggregates = [line for line in final.split("\n") if "HashAggregate(" in line]
    assert aggregates and all(re.search(r"\*\(\d+\) HashAggregate", line) for line in aggregates)
