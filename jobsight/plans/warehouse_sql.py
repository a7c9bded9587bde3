"""The warehouse in SQL: the reference's names as views that are current on every read, marts as table functions.

``register`` needs to run once per catalog. A view over a versioned dataset
reads the version that its manifest names at that moment (a scalar subquery,
by which Spark prunes the other version folders), so the next ``load`` shows in
the same SQL, and ``expire_versions`` removes nothing that a name points to:

* ``staging.vacancy``, ``settings.setup``, ``core.dim_*``, ``core.fact_vacancy``,
* ``core.mart_stats``: the figures the loads keep current (``plans.mart_feed``),
* ``mart_region(role)``, ``mart_employer(role)``, ``mart_vacancies()``: the marts
  as SQL table functions over them, for any role (created in the current
  database: Spark calls table functions without a database name),
* ``data_mart.<view>``: the seven marts, views on those functions.

A mart on read costs its figures per key, not the fact. Its rows are numbered
without a window over all of them: key by key within blocks of ``BLOCK`` keys,
after the number of rows in the blocks before.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from jobsight.operators.aggregates import COUNT_COLS, RATIO_COLS, STAT_COLS
from jobsight.plans import mart_feed
from jobsight.plans.fact_store import FACT_DIR
from jobsight.plans.marts import MART_GRAINS, MARTS, MartSpec
from jobsight.schemas import DIM_AREA, DIM_CURRENCY, DIM_EMPLOYER, DIM_EXPERIENCE, FACT_VACANCY, SETUP, STAGING
from jobsight.sinks.versioned import MANIFEST, current_path

DATABASES = ["staging", "settings", "core", "data_mart"]
VERSIONED = {
    "staging.vacancy": ("staging", STAGING), "core.dim_area": ("dim_area", DIM_AREA), "core.dim_employer": ("dim_employer", DIM_EMPLOYER),
    "core.dim_experience": ("dim_experience", DIM_EXPERIENCE), "core.dim_currency": ("dim_currency", DIM_CURRENCY),
}
BLOCK = 10_000
#: Blocks for rows without a key, dealt by their figures.
LOOSE = 1024
FUNCTIONS = {"area_id": "mart_region", "employer_id": "mart_employer", "vacancy_name": "mart_vacancies"}


def _view(spark: SparkSession, name: str, query: str) -> None:
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # external, of an earlier registration: the files stay
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def _current(root: str, dataset: str, schema: T.StructType) -> str:
    """The newest committed version of a dataset, looked up on read."""
    version = f"SELECT max_by(regexp_extract(path, 'v=([^/]+)$', 1), committed_at) FROM parquet.`{root}/{MANIFEST}/{dataset}/*`"
    return f"SELECT {', '.join(schema.names)} FROM parquet.`{root}/{dataset}` WHERE v = ({version})"


def _quotient_functions(spark: SparkSession) -> None:
    """``ROUND(num / den, 2)`` half away from zero, exact: see ``functions.money``."""
    q = "CAST(floor(n / d) AS DECIMAL(38,0))"
    spark.sql(
        "CREATE OR REPLACE FUNCTION data_mart.floor_quotient(n DECIMAL(38,0), d DECIMAL(38,0)) RETURNS DECIMAL(38,0) "
        f"RETURN CASE WHEN {q} * d > n THEN CAST({q} - 1 AS DECIMAL(38,0)) ELSE {q} END"
    )
    spark.sql(
        "CREATE OR REPLACE FUNCTION data_mart.rounded_ratio(part DECIMAL(38,2), whole DECIMAL(38,8)) RETURNS DECIMAL(38,2) RETURN "
        "CAST(CASE WHEN (part < 0) <> (whole < 0) THEN -1 ELSE 1 END * data_mart.floor_quotient("
        "CAST(abs(part) * 100 AS DECIMAL(38,0)) * 200000000 + CAST(abs(whole) * 100000000 AS DECIMAL(38,0)), "
        "2 * CAST(abs(whole) * 100000000 AS DECIMAL(38,0))) / 100 AS DECIMAL(38,2))"
    )


def _mart_function(spark: SparkSession, spec: MartSpec) -> None:
    """The table function of one grain."""
    key, name, function = spec.grain_key, spec.name_col, FUNCTIONS[spec.grain_key]
    grain = [key] if spec.dim is None else ["vacancy_name", key]
    kind = {"area_id": "INT", "employer_id": "BIGINT", "vacancy_name": "STRING"}[key]
    stats = [f"CASE WHEN s.{key} IS NOT NULL THEN s.{c} END AS {c}" for c in STAT_COLS]  # a NULL key has counts only
    where = f"s._set = {MART_GRAINS.index(grain)}" + (f" AND s.vacancy_name = {function}.role" if spec.dim else "")
    known = ", ".join(f"s.{c}" for c in COUNT_COLS) + ", " + ", ".join(stats)
    if spec.dim:
        dim = f"(SELECT {key}, name FROM core.dim_{spec.dim} WHERE {key} IS NOT NULL)"
        rows = f"SELECT d.{key} AS k, d.name AS label, {known} FROM core.mart_stats s LEFT JOIN {dim} d ON s.{key} = d.{key} WHERE {where}"
        block = f"CASE WHEN k IS NOT NULL THEN k DIV {BLOCK} ELSE 9000000000000000 + pmod(xxhash64(*), {LOOSE}) END"
    else:
        rows = f"SELECT s.{key} AS k, CAST(NULL AS STRING) AS label, {known} FROM core.mart_stats s WHERE {where}"
        block = "CASE WHEN k IS NOT NULL THEN 0 ELSE 1 END"
    group = ", ".join(["k", "label", *STAT_COLS])
    sums = ", ".join(f"sum({c}) AS {c}" for c in COUNT_COLS)
    block = block.replace("xxhash64(*)", f"xxhash64({', '.join(COUNT_COLS + STAT_COLS)})")
    out = [f"{key} {kind}", *([f"{name} STRING"] if name else []), *[f"{c} BIGINT" for c in COUNT_COLS]]
    out += [f"{c} DECIMAL(38,{2 if c.startswith('avg') else 8})" for c in STAT_COLS] + [f"{c} DECIMAL(38,2)" for c in RATIO_COLS]
    ratios = [f"data_mart.rounded_ratio(avg_sal_{c[len('ratio_sal_'):]}, max_salary)" for c in RATIO_COLS]
    picked = ["k", *(["label"] if name else []), *COUNT_COLS, *STAT_COLS, *ratios]
    spark.sql(f"DROP FUNCTION IF EXISTS {function}")
    spark.sql(
        f"CREATE FUNCTION {function}({'role STRING' if spec.dim else ''}) RETURNS TABLE (id BIGINT, {', '.join(out)}) RETURN "
        f"WITH merged AS (SELECT {group}, {sums} FROM ({rows}) GROUP BY {group}), "
        f"dealt AS (SELECT *, {block} AS block FROM merged), "
        "sizes AS (SELECT block AS b, count(*) AS n FROM dealt GROUP BY block), "
        "starts AS (SELECT b, coalesce(sum(n) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sizes) "
        f"SELECT before + row_number() OVER (PARTITION BY block ORDER BY k) AS id, {', '.join(picked)} FROM dealt JOIN starts ON block = b"
    )


def register(spark: SparkSession, root: str, with_marts: bool = True) -> list[str]:
    """Create the names over the warehouse at ``root``; returns the tables and views that there are data for."""
    for db in DATABASES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/_catalog/{db}.db'")
    names = []
    for name, (dataset, schema) in VERSIONED.items():
        if current_path(spark, root, dataset):
            _view(spark, name, _current(root, dataset, schema))
            names.append(name)
    _view(spark, "settings.setup", f"SELECT {', '.join(SETUP.names)} FROM parquet.`{root}/setup`")
    _view(spark, "core.fact_vacancy", f"SELECT {', '.join(FACT_VACANCY.names)} FROM parquet.`{root}/{FACT_DIR}`")
    names += ["settings.setup", "core.fact_vacancy"]
    if not with_marts:
        return names
    if not mart_feed.current(spark, root):
        mart_feed.rebuild(spark, root)
    _view(spark, "core.mart_stats", _current(root, mart_feed.STATS, mart_feed.stored_stats(spark, root).schema))
    names.append("core.mart_stats")
    _quotient_functions(spark)
    for spec in {s.grain_key: s for s in MARTS.values()}.values():
        _mart_function(spark, spec)
    for spec in MARTS.values():
        role = f"'{spec.role}'" if spec.role else ""
        _view(spark, f"data_mart.{spec.view}", f"SELECT * FROM {FUNCTIONS[spec.grain_key]}({role})")
        names.append(f"data_mart.{spec.view}")
    return names
