"""Every operator of SURVEY §2 as a query over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. Inputs are the
vacancy-shaped records Spark derives from ``orders ⟕ customer ⟕ nation``
(``sources.fixture``); the star schema is the first load of those records:
every candidate inserted into empty targets. Money leaves as DOUBLE at this
boundary (the engine keeps DECIMAL inside), so results compare by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsight.functions.classify import effective_grade, grade, grade_from_experience, rate_to_rub, role
from jobsight.operators import aggregates as A
from jobsight.operators.candidates import (
    as_currency_dim,
    as_dim,
    currency_candidates,
    dim_candidates,
    fact_candidates,
)
from jobsight.operators.checks import duplicate_keys, nullify_orphans, orphans, over_length
from jobsight.operators.normalise import distinct_records, missing_required, normalise
from jobsight.operators.numbering import numbered
from jobsight.operators.upsert import upsert_table
from jobsight.plans import daily_load
from jobsight.plans.marts import MARTS, build_mart, per_key
from jobsight.schemas import VARCHAR_LIMITS
from jobsight.session import storage_root
from jobsight.sinks.versioned import append_bookmark, refresh
from jobsight.sources.fixture import (
    AS_OF,
    day1_batch,
    day2_batch,
    duplicated_batch,
    landed_pages,
    long_name_records,
    run_log,
    vacancy_records,
    with_changed_rates,
)
from jobsight.sources.pages import (
    bookmark_state,
    flatten_pages,
    has_bookmark,
    lookback,
    parse_pages,
    title_search,
)

Query = Callable[[SparkSession, str], DataFrame]


def at_boundary(df: DataFrame) -> DataFrame:
    """DECIMAL columns as DOUBLE; everything else unchanged."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


@dataclass
class Star:
    staging: DataFrame
    fact: DataFrame
    currency: DataFrame
    dims: dict[str, DataFrame]


def first_load(staging: DataFrame) -> Star:
    """Targets after one MERGE into empty tables: every candidate is inserted."""
    dims = {
        "area": as_dim(dim_candidates(staging, "area_id", "area_name"), "area_id", "area_name"),
        # The reference never writes the accreditation flag of an employer.
        "employer": as_dim(dim_candidates(staging, "employer_id", "employer_name"), "employer_id", "employer_name")
        .withColumn("is_accredited_it_employer", F.lit(None).cast("boolean")),
        "experience": as_dim(
            dim_candidates(staging, "experience_id", "experience_name"), "experience_id", "experience_name"
        ),
    }
    return Star(staging, fact_candidates(staging), as_currency_dim(currency_candidates(staging)), dims)


def star(spark: SparkSession, sf_dir: str) -> Star:
    return first_load(vacancy_records(spark, sf_dir))


# ---------------------------------------------------------------- classification
def q_class_title(spark, sf_dir):
    return vacancy_records(spark, sf_dir).select("id", role("vacancy_name").alias("role"))


def q_class_grade(spark, sf_dir):
    return vacancy_records(spark, sf_dir).select("id", grade("vacancy_name").alias("grade"))


def q_class_grade_experience(spark, sf_dir):
    return vacancy_records(spark, sf_dir).select(
        "id", grade_from_experience("experience_id").alias("grade_experience")
    )


def q_class_currency_rate(spark, sf_dir):
    recs = vacancy_records(spark, sf_dir)
    return at_boundary(recs.select("id", "salary_currency", rate_to_rub("salary_currency").alias("to_rub")))


def q_effective_grade(spark, sf_dir):
    fact = star(spark, sf_dir).fact
    return fact.select("vacancy_id", effective_grade("grade", "grade_experience").alias("effective_grade"))


def q_salary_rub(spark, sf_dir):
    s = star(spark, sf_dir)
    # Stored before it is joined, as the load does: its size is known then, and the fact stays where it is.
    rates = refresh(s.currency, _fresh_root(spark), "dim_currency")
    rows = A.priced(s.fact, rates)
    return at_boundary(
        rows.select("vacancy_id", F.col("_rub_from").alias("salary_from_rub"), F.col("_rub_to").alias("salary_to_rub"))
    )


# ---------------------------------------------------------------- candidates
def q_dim_area_candidates(spark, sf_dir):
    return dim_candidates(vacancy_records(spark, sf_dir), "area_id", "area_name")


def q_dim_employer_candidates(spark, sf_dir):
    return dim_candidates(vacancy_records(spark, sf_dir), "employer_id", "employer_name")


def q_dim_experience_candidates(spark, sf_dir):
    return dim_candidates(vacancy_records(spark, sf_dir), "experience_id", "experience_name")


def q_dim_currency_candidates(spark, sf_dir):
    return at_boundary(currency_candidates(vacancy_records(spark, sf_dir)))


def q_fact_candidates(spark, sf_dir):
    return at_boundary(fact_candidates(vacancy_records(spark, sf_dir)))


# ---------------------------------------------------------------- aggregates
# The single aggregates run over the whole fact (all roles) by employer, the
# largest grain; the NULL employer is a group of its own, as in the stats CTE.
GRAIN = "employer_id"


def _agg(columns):
    def q(spark, sf_dir):
        s = star(spark, sf_dir)
        return at_boundary(A.grain_stats(s.fact, s.currency, GRAIN).select(GRAIN, *columns))

    return q


q_agg_salary_avg = _agg(A.AVG_COLS)
q_agg_salary_min = _agg(A.MIN_COLS)
q_agg_salary_max = _agg(A.MAX_COLS)
q_agg_salary_overall = _agg(A.OVERALL_COLS)
q_agg_salary_by_key = _agg(A.STAT_COLS)
q_agg_open_count = _agg(["cnt_vacancy"])
q_agg_salary_count = _agg(["cnt_vac_salary"])
q_agg_grade_counts = _agg([c for _, c in A.COUNTED_GRADES])
q_agg_lead_count = _agg(["cnt_lead"])


def q_salary_ratio(spark, sf_dir):
    s = star(spark, sf_dir)
    stats = A.grain_stats(s.fact, s.currency, GRAIN)
    return at_boundary(stats.select(GRAIN, *A.salary_ratio_final()))


def q_mart_row_number(spark, sf_dir):
    s = star(spark, sf_dir)
    keys = per_key(s.fact, s.currency, GRAIN).select(GRAIN, "cnt_vacancy")
    return numbered(keys, [F.col(GRAIN).asc_nulls_last()])


# ---------------------------------------------------------------- marts
def _mart(name):
    def q(spark, sf_dir):
        s = star(spark, sf_dir)
        return at_boundary(build_mart(name, s.fact, s.currency, s.dims))

    return q


# ---------------------------------------------------------------- upserts
# Targets: the first load of the day-1 batch. Source: candidates of the day-2
# batch, which overlaps day 1 and renames / re-prices / re-opens (fixture).
def _days(spark, sf_dir):
    recs = vacancy_records(spark, sf_dir)
    return first_load(day1_batch(recs)), day2_batch(recs)


def q_upsert_dim_employer_exact(spark, sf_dir):
    """Day 2 beside the stored names of its keys: two source rows a key, at most one of which updates, as MERGE takes them."""
    old, batch = _days(spark, sf_dir)
    source = as_dim(dim_candidates(batch, "employer_id", "employer_name"), "employer_id", "employer_name")
    again = old.dims["employer"].select("employer_id", "name").join(source.select("employer_id").distinct(), "employer_id", "left_semi")
    return upsert_table("dim_employer", old.dims["employer"], source.unionByName(again), on_duplicate="merge")


def _dim_upsert(table, dim, key, name):
    def q(spark, sf_dir):
        old, batch = _days(spark, sf_dir)
        source = as_dim(dim_candidates(batch, key, name), key, name)
        return upsert_table(table, old.dims[dim], source)

    return q


q_upsert_dim_area = _dim_upsert("dim_area", "area", "area_id", "area_name")
q_upsert_dim_employer = _dim_upsert("dim_employer", "employer", "employer_id", "employer_name")
q_upsert_dim_experience = _dim_upsert("dim_experience", "experience", "experience_id", "experience_name")


def q_upsert_dim_currency(spark, sf_dir):
    old, batch = _days(spark, sf_dir)
    source = as_currency_dim(currency_candidates(batch))
    return at_boundary(upsert_table("dim_currency", with_changed_rates(old.currency), source))


def q_upsert_fact_vacancy(spark, sf_dir):
    old, batch = _days(spark, sf_dir)
    return at_boundary(upsert_table("fact_vacancy", old.fact, fact_candidates(batch)))


# ---------------------------------------------------------------- checks
# Every declared constraint over all rows. The violations are the fixture's:
# each vacancy twice, dimensions with the day-2 names next to the first ones,
# a star whose dimensions hold day 1 only, and employer names beyond VARCHAR(255).
def q_chk_unique(spark, sf_dir):
    recs = vacancy_records(spark, sf_dir)
    return duplicate_keys(fact_candidates(duplicated_batch(recs)), "vacancy_id")


def _unique(key, name):
    def q(spark, sf_dir):
        recs = vacancy_records(spark, sf_dir)
        both = dim_candidates(recs, key, name).unionByName(dim_candidates(day2_batch(recs), key, name))
        return duplicate_keys(both, key)

    return q


q_chk_unique_area = _unique("area_id", "area_name")
q_chk_unique_employer = _unique("employer_id", "employer_name")
q_chk_unique_experience = _unique("experience_id", "experience_name")


def q_chk_unique_currency(spark, sf_dir):
    dim = as_currency_dim(currency_candidates(vacancy_records(spark, sf_dir)))
    return duplicate_keys(dim.unionByName(with_changed_rates(dim)).distinct(), "currency_id")


# fact column -> (dimension, its key)
REFERENCES = {
    "employer_id": ("employer", "employer_id"),
    "experience_id": ("experience", "experience_id"),
    "area_id": ("area", "area_id"),
    "salary_currency": ("currency", "currency_id"),
}


def _partial_dim(spark, sf_dir, column):
    """The fact of all records, a dimension that lacks some of its keys, and the dimension's key."""
    recs = vacancy_records(spark, sf_dir)
    fact = first_load(recs).fact
    if column == "employer_id":
        old = first_load(day1_batch(recs))
    else:  # few keys, all seen on day 1: leave out those whose first character has an odd code
        old = first_load(recs.where(F.ascii(F.col(column).cast("string")) % 2 == 0))
    dim, key = REFERENCES[column]
    return fact, old.currency if dim == "currency" else old.dims[dim], key


def _fk(column):
    def q(spark, sf_dir):
        fact, dim, key = _partial_dim(spark, sf_dir, column)
        return orphans(fact, dim, column, key).select("vacancy_id", column)

    return q


def _set_null(column):
    def q(spark, sf_dir):
        fact, dim, key = _partial_dim(spark, sf_dir, column)
        return nullify_orphans(fact, dim, column, key).select("vacancy_id", column)

    return q


q_chk_fk = _fk("employer_id")
q_fk_set_null = _set_null("employer_id")


def q_chk_length(spark, sf_dir):
    recs = long_name_records(vacancy_records(spark, sf_dir))
    return over_length(recs, VARCHAR_LIMITS["staging"], ["id"])


def _dim_length(table):
    """Dimension rows over their bounds, with names (currency: codes) repeated."""

    def q(spark, sf_dir):
        recs = vacancy_records(spark, sf_dir)
        if table == "dim_currency":
            dim = as_currency_dim(currency_candidates(recs)).select(F.repeat("currency_id", F.lit(4)).alias("currency_id"))
            return over_length(dim, VARCHAR_LIMITS[table], ["currency_id"])
        key, name = {"dim_area": ("area_id", "area_name"), "dim_employer": ("employer_id", "employer_name"),
                     "dim_experience": ("experience_id", "experience_name")}[table]
        dim = as_dim(dim_candidates(recs, key, name), key, name)
        # As many repeats as the key's first character says: some names stay within the bound.
        times = F.ascii(F.col(key).cast("string")) - 20
        dim = dim.withColumn("name", F.repeat(F.col("name"), times))
        return over_length(dim, VARCHAR_LIMITS[table], [key])

    return q


def q_chk_length_fact(spark, sf_dir):
    fact = first_load(vacancy_records(spark, sf_dir)).fact
    fact = fact.withColumn("salary_currency", F.repeat("salary_currency", (F.col("vacancy_id") % 5).cast("int")))
    return over_length(fact, VARCHAR_LIMITS["fact_vacancy"], ["vacancy_id"])


# ---------------------------------------------------------------- stored star
# The production path: landed pages, daily load into a warehouse folder of its
# own (fresh for each call), then the marts published from what is stored.
def _fresh_root(spark):
    return f"{storage_root(spark)}/stored-{uuid.uuid4().hex[:12]}"


def _stored_mart(view):
    def q(spark, sf_dir):
        root = _fresh_root(spark)
        pages = parse_pages(landed_pages(vacancy_records(spark, sf_dir)))
        daily_load.load(spark, pages, root=root, strict=False, fact_range_width=STORED_RANGE)
        return at_boundary(daily_load.marts(spark, root, [view])[view])

    return q


def q_stored_fact_upsert(spark, sf_dir):
    """Two days merged into a stored fact; what the folder holds afterwards."""
    root, recs = _fresh_root(spark), vacancy_records(spark, sf_dir)
    for batch in (day1_batch(recs), day2_batch(recs)):
        daily_load.upsert_fact(spark, root, fact_candidates(batch), width=STORED_RANGE)
    return at_boundary(daily_load.read_fact(spark, root))


STORED_RANGE = 50_000


def _loaded_over_two_days(spark, sf_dir, names=False):
    """A warehouse whose second load brings what the first lacked or held otherwise; SQL names made in between."""
    root, recs = _fresh_root(spark), vacancy_records(spark, sf_dir)
    late, other = F.col("id") % 7 == 0, F.col("id") % 3 == 0
    before = recs.where(~late).withColumns(
        {
            "salary_from": F.when(other, F.col("salary_from") / 2).otherwise(F.col("salary_from")).cast("decimal(18,2)"),
            "salary_to": F.when(other, F.col("salary_to") * 2).otherwise(F.col("salary_to")).cast("decimal(18,2)"),
            "is_open": F.when(other, ~F.col("is_open")).otherwise(F.col("is_open")),
        }
    )
    for day, batch in enumerate((before, recs.where(late | other))):
        daily_load.load(spark, parse_pages(landed_pages(batch)), root=root, strict=False, fact_range_width=STORED_RANGE)
        if names and not day:
            daily_load.register_tables(spark, root)
    return root


def _by_name(query):
    """SQL over names that were made after the first of two loads."""

    def q(spark, sf_dir):
        _loaded_over_two_days(spark, sf_dir, names=True)
        return at_boundary(spark.sql(query))

    return q


def q_stored_set_null_area(spark, sf_dir):
    """Areas deleted from the stored star; the fact afterwards."""
    root = _loaded_over_two_days(spark, sf_dir)
    gone = daily_load.read_stored(spark, root, "dim_area").where("area_id % 5 = 0").select("area_id")
    daily_load.delete_dimension_rows(spark, root, "dim_area", gone)
    return at_boundary(daily_load.read_fact(spark, root))


# ---------------------------------------------------------------- ingest
# Pages are landed from the records as API-shaped JSON (fixture), then read
# back through the same path a real landing takes.
def _items(spark, sf_dir):
    return flatten_pages(parse_pages(landed_pages(vacancy_records(spark, sf_dir))))


def q_ingest_flatten_pages(spark, sf_dir):
    items = _items(spark, sf_dir)
    return items.select(
        "page",
        F.try_variant_get("item", "$.id", "string").alias("id"),
        F.try_variant_get("item", "$.name", "string").alias("name"),
        F.try_variant_get("item", "$.published_at", "string").alias("published_at"),
    )


def q_ingest_normalise(spark, sf_dir):
    return at_boundary(normalise(_items(spark, sf_dir)))


def q_ingest_distinct(spark, sf_dir):
    return at_boundary(distinct_records(normalise(_items(spark, sf_dir))))


def q_chk_required(spark, sf_dir):
    return missing_required(_items(spark, sf_dir))


def q_stage_refresh(spark, sf_dir):
    staged = refresh(distinct_records(normalise(_items(spark, sf_dir))), storage_root(spark))
    return at_boundary(staged)


def q_ingest_title_search(spark, sf_dir):
    return title_search(vacancy_records(spark, sf_dir)).select("id", "vacancy_name")


def q_ingest_lookback(spark, sf_dir):
    """First run: no bookmark, the 30-day window."""
    return lookback(vacancy_records(spark, sf_dir), AS_OF, has_bookmark=False).select("id", "published_at")


def q_ingest_lookback_daily(spark, sf_dir):
    """Later run: the run log holds runs, so the 1-day window."""
    recs = vacancy_records(spark, sf_dir)
    return lookback(recs, AS_OF, has_bookmark(run_log(recs))).select("id", "published_at")


def q_bookmark_probe(spark, sf_dir):
    return bookmark_state(run_log(vacancy_records(spark, sf_dir)))


def q_bookmark_append(spark, sf_dir):
    return append_bookmark(run_log(vacancy_records(spark, sf_dir)), AS_OF)


QUERIES: dict[str, Query] = {
    "ingest_flatten_pages": q_ingest_flatten_pages,
    "ingest_title_search": q_ingest_title_search,
    "ingest_lookback": q_ingest_lookback,
    "ingest_lookback_daily": q_ingest_lookback_daily,
    "ingest_normalise": q_ingest_normalise,
    "ingest_distinct": q_ingest_distinct,
    "chk_required": q_chk_required,
    "stage_refresh": q_stage_refresh,
    "bookmark_probe": q_bookmark_probe,
    "bookmark_append": q_bookmark_append,
    "class_title": q_class_title,
    "class_grade": q_class_grade,
    "class_grade_experience": q_class_grade_experience,
    "class_currency_rate": q_class_currency_rate,
    "effective_grade": q_effective_grade,
    "salary_rub": q_salary_rub,
    "dim_area_candidates": q_dim_area_candidates,
    "dim_employer_candidates": q_dim_employer_candidates,
    "dim_experience_candidates": q_dim_experience_candidates,
    "dim_currency_candidates": q_dim_currency_candidates,
    "fact_candidates": q_fact_candidates,
    "agg_salary_avg": q_agg_salary_avg,
    "agg_salary_min": q_agg_salary_min,
    "agg_salary_max": q_agg_salary_max,
    "agg_salary_overall": q_agg_salary_overall,
    "agg_salary_by_key": q_agg_salary_by_key,
    "agg_open_count": q_agg_open_count,
    "agg_salary_count": q_agg_salary_count,
    "agg_grade_counts": q_agg_grade_counts,
    "agg_lead_count": q_agg_lead_count,
    "salary_ratio": q_salary_ratio,
    "mart_row_number": q_mart_row_number,
    **{name: _mart(name) for name in MARTS},
    "upsert_dim_area": q_upsert_dim_area,
    "upsert_dim_employer": q_upsert_dim_employer,
    "upsert_dim_experience": q_upsert_dim_experience,
    "upsert_dim_currency": q_upsert_dim_currency,
    "upsert_fact_vacancy": q_upsert_fact_vacancy,
    "chk_unique": q_chk_unique,
    "chk_fk": q_chk_fk,
    "fk_set_null": q_fk_set_null,
    "chk_length": q_chk_length,
    "chk_unique_area": q_chk_unique_area,
    "chk_unique_employer": q_chk_unique_employer,
    "chk_unique_experience": q_chk_unique_experience,
    "chk_unique_currency": q_chk_unique_currency,
    **{f"chk_fk_{c}": _fk(c) for c in REFERENCES if c != "employer_id"},
    **{f"fk_set_null_{c}": _set_null(c) for c in REFERENCES if c != "employer_id"},
    **{f"chk_length_{t}": _dim_length(t) for t in ("dim_area", "dim_employer", "dim_experience", "dim_currency")},
    "chk_length_fact": q_chk_length_fact,
    **{f"stored_{name}": _stored_mart(spec.view) for name, spec in MARTS.items()},
    "stored_fact_upsert": q_stored_fact_upsert,
    "upsert_dim_employer_exact": q_upsert_dim_employer_exact,
    **{f"named_{m}": _by_name(f"SELECT * FROM data_mart.{MARTS[m].view}") for m in ("mart_de_region", "mart_da_employer", "mart_vacancies")},
    "function_mart_region": _by_name("SELECT * FROM mart_region('Data scientist')"),
    "stored_set_null_area": q_stored_set_null_area,
}
