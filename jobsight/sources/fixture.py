"""Vacancy-shaped records derived from the driver's TPC-H-like tables.

One record per order: ``orders ⟕ customer ⟕ nation`` (FIXTURES.md §2). The
moduli of the order key are pairwise coprime so the conditions they drive
vary independently. Everything here is derived by Spark from the given
tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.schemas import MONEY, RATE
from jobsight.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the fixture (FIXTURES.md §2).
# ---------------------------------------------------------------------------
TITLE_PREFIXES = ["Стажер ", "Junior ", "Старший ", "Senior ", "Team Lead ", "", ""]  # by key % 7
TITLES = [  # by key % 8
    "Data Engineer",
    "Дата-инженер",
    "АНАЛИТИК ДАННЫХ",
    "data analyst",
    "Data Scientist",
    "Исследователь данных",
    "Data Engineer / Data Analyst",
    "Python developer",
]
PRIORITY_EXPERIENCE = [
    ("5-LOW", "noExperience"),
    ("4-NOT SPECIFIED", "between1And3"),
    ("3-MEDIUM", "between3And6"),
    ("2-HIGH", "moreThan6"),
]
CURRENCY_BY_KEY_MOD_9 = [(4, "USD"), (5, "KZT"), (6, "BYR"), (7, "EUR")]  # 8 -> NULL, else RUR
NO_EXPERIENCE_PRIORITY = "1-URGENT"

# The day-1 / day-2 batches of the upsert fixtures, split by publication date
# with half a year of overlap (re-published vacancies).
DAY1_BEFORE = "1999-01-01"
DAY2_FROM = "1998-07-01"

RENAME_SUFFIX = " (new)"
# Existing currency rows before day 2: USD must move to the standard rate,
# EUR must keep its rate (the standard rule has none for it).
CHANGED_RATES = [("USD", "80"), ("EUR", "100")]

# Orders that one task is dealt at most; fewer ones are spread over some tasks nevertheless.
DEALT_ROWS = 100_000
SPREAD_ROWS, SPREAD = 25_000, 24

# Lookback fixture: the run date.
AS_OF = "2001-08-01"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def vacancy_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging-shaped records (schema ``schemas.STAGING``) over the driver tables."""
    # Orders drive the row count (one vacancy per order).
    orders = read_table(
        spark,
        sf_dir,
        "orders",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    )
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    v = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").join(
        nation, F.col("c_nationkey") == nation.n_nationkey, "left"
    )
    # Dealt by key once, whatever the number of splits: the DISTINCT by vacancy further up needs that
    # partitioning anyway. The number of parts follows the rows, so a task's hash tables do not grow with them.
    n = orders.count()
    v = v.repartition(max(1, -(-n // DEALT_ROWS), min(-(-n // SPREAD_ROWS), SPREAD)), "o_orderkey")
    k = F.col("o_orderkey")
    experience = None
    for priority, code in PRIORITY_EXPERIENCE:
        cond = F.col("o_orderpriority") == priority
        experience = F.when(cond, code) if experience is None else experience.when(cond, code)
    currency = F.when((k % 9) == 8, F.lit(None).cast("string"))
    for m, code in CURRENCY_BY_KEY_MOD_9:
        currency = currency.when((k % 9) == m, code)
    currency = currency.otherwise("RUR")
    no_salary = (k % 9) == 8
    salary_from = F.when(~(no_salary | (k % 11).isin(0, 1)), F.floor(F.col("o_totalprice") / 1000))
    salary_to = F.when(~(no_salary | (k % 11).isin(1, 2, 3)), F.floor(F.col("o_totalprice") / 800))
    has_employer = (k % 19) != 0
    has_area = (k % 17) != 0
    return v.select(
        k.alias("id"),
        F.concat(_pick(k % 7, TITLE_PREFIXES), _pick(k % 8, TITLES)).alias("vacancy_name"),
        F.col("o_orderdate").alias("published_at"),
        ((k % 13) == 0).alias("is_archive"),
        (F.col("o_orderstatus") != "F").alias("is_open"),
        F.when(has_employer, F.col("c_custkey")).alias("employer_id"),
        F.when(has_employer, F.col("c_name")).alias("employer_name"),
        ((k % 23) == 0).alias("is_accredited_it_employer"),
        experience.alias("experience_id"),
        F.when(F.col("o_orderpriority") != NO_EXPERIENCE_PRIORITY, F.col("o_orderpriority")).alias(
            "experience_name"
        ),
        F.when(has_area, F.col("n_nationkey")).cast("int").alias("area_id"),
        F.when(has_area, F.col("n_name")).alias("area_name"),
        salary_from.cast(MONEY).alias("salary_from"),
        salary_to.cast(MONEY).alias("salary_to"),
        currency.alias("salary_currency"),
        (~no_salary & ((k % 29) == 0)).alias("is_gross"),
    )


def day1_batch(records: DataFrame) -> DataFrame:
    """Vacancies already loaded before day 2 (the existing targets)."""
    return records.where(F.col("published_at") < F.lit(DAY1_BEFORE).cast("timestamp_ntz"))


def day2_batch(records: DataFrame) -> DataFrame:
    """The day-2 batch: overlaps day 1 for half a year.

    Changed on every row: ``salary_from + 1`` and ``is_open`` negated (so
    re-published vacancies must be overwritten), and dimension names renamed
    with a `` (new)`` suffix where the area / employer key is even or the
    experience name has even length (so matched dimension rows change).
    """
    renamed = F.lit(RENAME_SUFFIX)
    return records.where(F.col("published_at") >= F.lit(DAY2_FROM).cast("timestamp_ntz")).withColumns(
        {
            "salary_from": (F.col("salary_from") + F.lit(1)).cast(MONEY),
            "is_open": ~F.col("is_open"),
            "area_name": F.when((F.col("area_id") % 2) == 0, F.concat("area_name", renamed)).otherwise(
                F.col("area_name")
            ),
            "employer_name": F.when((F.col("employer_id") % 2) == 0, F.concat("employer_name", renamed)).otherwise(
                F.col("employer_name")
            ),
            "experience_name": F.when(
                (F.length("experience_name") % 2) == 0, F.concat("experience_name", renamed)
            ).otherwise(F.col("experience_name")),
        }
    )


def with_changed_rates(currency_dim: DataFrame) -> DataFrame:
    """Existing currency rows with rates that differ from the standard ones."""
    rate = F.col("to_rub")
    for code, value in CHANGED_RATES:
        rate = F.when(F.col("currency_id") == code, F.lit(value).cast(RATE)).otherwise(rate)
    return currency_dim.withColumn("to_rub", rate.cast(RATE))


def duplicated_batch(batch: DataFrame) -> DataFrame:
    """The batch twice, the copy with ``salary_to + 1``: duplicate vacancy ids."""
    return batch.unionByName(batch.withColumn("salary_to", (F.col("salary_to") + F.lit(1)).cast(MONEY)))


def long_name_records(records: DataFrame) -> DataFrame:
    """Records whose employer names are repeated to exceed VARCHAR bounds for some rows."""
    k = F.col("id")
    repeated = F.concat_ws(" ", F.array_repeat(F.col("employer_name"), ((k % 20) + 1).cast("int")))
    return records.withColumn("employer_name", F.when(F.col("employer_name").isNotNull(), repeated))


# ---------------------------------------------------------------------------
# Landed API pages built from the records (FIXTURES.md "JSON pages").
# ---------------------------------------------------------------------------
PAGE_SIZE = 100
# Page drift: items at positions >= 95 of a page are served again at the top
# of the next page (identical copies the loader must drop).
DRIFT_FROM = 95
# Vacancies without salary carry ``"salary": null``, except every fifth one,
# whose ``salary`` key is absent (a malformed item the required-key check reports).
ABSENT_SALARY_EVERY = 5
ZONE_SUFFIX = "+0300"


def item_json(records: DataFrame) -> Column:
    """One record as an API item: ids as text, ISO time with zone, NULL inner keys omitted."""
    k = F.col("id")
    archived = (
        F.when(F.col("is_archive") & ((k % 2) == 0), F.parse_json(F.lit('"true"')))
        .when(F.col("is_archive"), F.parse_json(F.lit("true")))
        .otherwise(F.parse_json(F.lit("false")))
    )
    salary_obj = F.to_json(
        F.struct(
            F.col("salary_from").alias("from"),
            F.col("salary_to").alias("to"),
            F.col("salary_currency").alias("currency"),
            F.col("is_gross").alias("gross"),
        ),
        {"ignoreNullFields": "false"},
    )
    salary = F.when(F.col("salary_currency").isNotNull(), salary_obj).when((k % ABSENT_SALARY_EVERY) != 0, "null")
    item = F.struct(
        k.cast("string").alias("id"),
        F.col("vacancy_name").alias("name"),
        F.concat(F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(ZONE_SUFFIX)).alias("published_at"),
        archived.alias("archived"),
        F.struct(F.when(F.col("is_open"), "open").otherwise("closed").alias("id")).alias("type"),
        F.struct(
            F.col("employer_id").cast("string").alias("id"),
            F.col("employer_name").alias("name"),
            F.col("is_accredited_it_employer").alias("accredited_it_employer"),
        ).alias("employer"),
        F.struct(F.col("experience_id").alias("id"), F.col("experience_name").alias("name")).alias("experience"),
        F.struct(F.col("area_id").cast("string").alias("id"), F.col("area_name").alias("name")).alias("area"),
    )
    # The salary keeps its NULL keys, the rest omits them: joined as text, neither is parsed and written again.
    return F.concat(F.lit("{"), F.coalesce(F.concat(F.lit('"salary":'), salary, F.lit(",")), F.lit("")), F.substring(F.to_json(item), 2, 1 << 30))


def landed_pages(records: DataFrame) -> DataFrame:
    """Pages as JSON text (column ``value``), ``page = floor(id / 100)`` plus drift.

    Grouping by page collects at most PAGE_SIZE + drift items per group
    (ids are unique), so no group grows with the data.
    """
    k = F.col("id")
    items = records.select(
        F.floor(k / PAGE_SIZE).cast("int").alias("page"), (k % PAGE_SIZE).alias("_pos"), item_json(records).alias("_j")
    )
    drift = items.where(F.col("_pos") >= DRIFT_FROM).withColumn("page", F.col("page") + 1)
    every = items.unionByName(drift)
    grouped = every.groupBy("page").agg(F.sort_array(F.collect_list("_j")).alias("_items"))
    # The API's "pages"/"found" header only drove its paging loop; landed
    # pages carry the page number and the items.
    text = F.concat(
        F.lit('{"page":'),
        F.col("page").cast("string"),
        F.lit(',"items":['),
        F.array_join("_items", ","),
        F.lit("]}"),
    )
    return grouped.select(text.alias("value"))


def run_log(records: DataFrame) -> DataFrame:
    """A run log with one completed run per publication day."""
    return records.select(F.to_date("published_at").cast("timestamp_ntz").alias("date_start")).distinct()
