"""The daily load, in the reference's task order:

    pages -> required-key check -> normalise -> search + lookback predicates
          -> DISTINCT -> staging refresh (U1) -> run log (U2)
          -> dim_area, dim_employer, dim_experience, dim_currency (U3-U6)
          -> fact_vacancy (U7)

Everything that can reject a batch is checked before the first write, so a
rejected batch leaves no file and no bookmark.

Storage layout under ``root`` (``session.warehouse_root`` by default):

* staging and the four dimensions are small: each load writes a new version
  directory and commits it in a manifest (``sinks.versioned``); readers see
  either the old or the new version, never a half-written one;
* the fact grows without bound, so it is not rewritten daily. It is stored
  partitioned by ``id_range = vacancy_id div fact_range_width``; a load opens
  only the folders of the ranges its batch touches, by path (no listing of
  the others), merges them with the batch, checkpoints the result (cutting
  the lineage to the partitions about to be replaced) and swaps just those
  partitions in with dynamic partition overwrite. The fact merge is idempotent
  (vacancy ids are never NULL, matches always take the source), so a retried
  load converges;
* publishing (``marts``) scans the fact once, eight columns of it, and
  pre-aggregates before its only shuffle.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.operators.candidates import (
    as_currency_dim,
    as_dim,
    currency_candidates,
    dim_candidates,
    fact_candidates,
)
from jobsight.operators.checks import duplicate_keys, over_length
from jobsight.operators.normalise import distinct_records, missing_required, normalise
from jobsight.operators.upsert import DUPLICATE, LOADS, merge_rows
from jobsight.plans import mart_feed
from jobsight.plans.fact_store import (
    FACT_RANGE_WIDTH,
    FOREIGN_KEYS,
    IMAGE,
    RANGE_COL,
    fact_path,
    key_counts,
    marked,
    merge_fact,
    ranges_holding,
    read_fact,
    read_ranges,
    read_ranges_with_id,
    rebuild_keys,
    touched_ranges,
)
from jobsight.schemas import DIM_AREA, DIM_CURRENCY, DIM_EMPLOYER, DIM_EXPERIENCE, FACT_VACANCY, VARCHAR_LIMITS
from jobsight.session import storage_root, warehouse_root
from jobsight.sinks.versioned import (
    read_current,
    read_run_log,
    record_run,
    refresh,
    write_version,
)
from jobsight.sources.pages import (
    flatten_pages,
    has_bookmark,
    lookback,
    lookback_landing,
    pages_without_items,
    title_search,
)

DIMENSIONS = [
    # (table, key, staging name column, schema)
    ("dim_area", "area_id", "area_name", DIM_AREA),
    ("dim_employer", "employer_id", "employer_name", DIM_EMPLOYER),
    ("dim_experience", "experience_id", "experience_name", DIM_EXPERIENCE),
]


DIMENSION_COLUMNS = {t: (k, n) for t, k, n, _ in DIMENSIONS}


class BatchRejected(ValueError):
    pass


@dataclass
class LoadResult:
    staging_rows: DataFrame
    tables: dict[str, str] = field(default_factory=dict)  # table -> path written


def read_stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    schemas = {t: s for t, _, _, s in DIMENSIONS}
    schemas["dim_currency"] = DIM_CURRENCY
    if table == "fact_vacancy":
        return read_fact(spark, root)
    return read_current(spark, root, table, schemas[table])


def touched_partitions(spark: SparkSession, root: str, source: DataFrame, width: int = FACT_RANGE_WIDTH) -> DataFrame:
    """The stored fact rows in the id ranges ``source`` (computed, e.g. checkpointed) touches."""
    return read_ranges(spark, root, touched_ranges(source, width))


def upsert_fact(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    width: int = FACT_RANGE_WIDTH,
    on_duplicate: str = "error",
) -> str:
    """U7 on the range-partitioned fact: merge, replace only touched ranges, keep the marts' groups current."""
    mart_feed.apply_change(spark, root, merge_fact(spark, root, source, width, on_duplicate))
    return fact_path(root)


def batch_sources(records: DataFrame) -> dict[str, DataFrame]:
    """What one batch merges into each table (MERGE sources D2-D6)."""
    out = {t: as_dim(dim_candidates(records, k, n), k, n) for t, (k, n) in DIMENSION_COLUMNS.items()}
    out["dim_currency"] = as_currency_dim(currency_candidates(records))
    out["fact_vacancy"] = fact_candidates(records)
    return out


def merge_batch(
    spark: SparkSession, root: str, records: DataFrame, width: int, on_duplicate: str
) -> tuple[dict[str, DataFrame], DataFrame]:
    """What every table holds after the batch, computed but not written: the dimensions, and the fact's touched ranges.

    The merges find the duplicates they refuse as they run, so a batch is
    rejected before anything is written, without a check job for each table.
    """
    sources = batch_sources(records)

    def dimension(table: str) -> tuple[str, DataFrame]:
        key, changed, unique = LOADS[table]
        merged = merge_rows(read_stored(spark, root, table), sources[table], key, changed, on_duplicate, unique)
        return table, merged.drop("_op").checkpoint(eager=True)

    try:
        # The four dimensions depend only on the batch, not on each other: their jobs run concurrently.
        with ThreadPoolExecutor(max_workers=4) as pool:
            dims = dict(pool.map(dimension, [t for t, *_ in DIMENSIONS] + ["dim_currency"]))
        return dims, merge_fact(spark, root, sources["fact_vacancy"], width, on_duplicate)
    except (PySparkException, Py4JJavaError) as e:
        if (at := str(e).find(DUPLICATE)) >= 0:
            raise BatchRejected(str(e)[at:].splitlines()[0]) from e
        raise


def load(
    spark: SparkSession,
    pages: DataFrame,
    root: str | None = None,
    as_of: dt.datetime | str | None = None,
    run_ts: dt.datetime | None = None,
    phrases: list[str] | None = None,
    strict: bool = True,
    on_duplicate: str = "error",
    fact_range_width: int = FACT_RANGE_WIDTH,
    landing_date: str | None = None,
) -> LoadResult:
    """Run one daily load of landed ``pages`` (columns of ``schemas.PAGE``).

    ``as_of`` is the run date the lookback window ends at (None: no window).
    ``landing_date`` names the folder column of pages landed in
    ``<landing_date>=YYYY-MM-DD`` folders, to leave folders outside the window
    unread (None: read all). ``phrases`` repeats the source's title search;
    by default landed pages count as searched already and nothing is dropped.
    With ``strict``, a page without items, or an item lacking a key the
    reference reads unconditionally (or holding a value its tables reject:
    a non-numeric id or amount, an unparsable time, a string over its VARCHAR
    bound), stops the load. So does a key with several differing rows unless
    ``on_duplicate='allow'``. All checks come before the first write.
    """
    root = root or warehouse_root(spark)
    storage_root(spark)
    bookmarked = None
    if as_of is not None:
        bookmarked = has_bookmark(read_run_log(spark, root))
        if landing_date:
            pages = lookback_landing(pages, as_of, bookmarked, landing_date)
    if strict:
        # The checks and the load each read the pages: parse the JSON once
        # into a reliable checkpoint and let all three read that.
        pages = pages.checkpoint(eager=True)
    items = flatten_pages(pages)
    if strict:
        no_items = pages_without_items(pages)
        if not no_items.isEmpty():
            raise BatchRejected("pages without items, e.g. " + str(no_items.limit(5).collect()))
        bad = missing_required(items)
        if not bad.isEmpty():
            raise BatchRejected("items lack required keys, e.g. " + str(bad.limit(5).collect()))
    records = normalise(items)
    if strict:
        too_long = over_length(records, VARCHAR_LIMITS["staging"], ["id"])
        # Staging bounds every string the dimensions and the fact take over, at the same lengths
        # (VARCHAR_LIMITS); role and grades are the classification's own short values.
        if not too_long.isEmpty():
            raise BatchRejected("values exceed the staging column lengths, e.g. " + str(too_long.limit(5).collect()))
    if phrases:
        records = title_search(records, phrases)
    if as_of is not None:
        records = lookback(records, as_of, bookmarked)
    # Computed once, into the scratch folder: staging and every merge read it.
    records = distinct_records(records).checkpoint(eager=True)
    dims, fact_rows = merge_batch(spark, root, records, fact_range_width, on_duplicate)
    staging = refresh(records, root, "staging")
    record_run(spark, root, run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    result = LoadResult(staging)
    with ThreadPoolExecutor(max_workers=4) as pool:
        result.tables.update(pool.map(lambda t: (t, write_version(dims[t], root, t)), dims))
    # The fact follows the dimensions, as its references require, and the marts' figures follow the fact.
    mart_feed.apply_change(spark, root, fact_rows)
    mart_feed.refresh_stats(spark, root)
    result.tables["fact_vacancy"] = fact_path(root)
    return result


def delete_dimension_rows(spark: SparkSession, root: str, table: str, keys: DataFrame) -> list[int]:
    """Remove the rows of ``keys`` (one column) from a stored dimension; the fact's references become NULL (Q3).

    Only the id ranges that hold one of the keys are read and rewritten
    (returned). The fact goes first: a run that ends in between leaves no
    reference without its row, and is repeated as it is.
    """
    (column,) = [c for c, t in FOREIGN_KEYS if t == table]
    storage_root(spark)
    key, schema = DIMENSION_KEYS[table], FACT_VACANCY[column].dataType
    gone = keys.select(F.col(keys.columns[0]).cast(schema).alias("_gone")).where("_gone is not null").distinct().checkpoint(eager=True)
    if marked(spark, root):
        rebuild_keys(spark, root)
    ranges = ranges_holding(spark, root, column, gone)
    if ranges:
        rows = read_ranges_with_id(spark, root, ranges).join(gone, F.col(column) == F.col("_gone"), "left")
        hit = F.col("_gone").isNotNull()
        rows = rows.select(
            *[F.when(~hit, F.col(c)).alias(c) if c == column else F.col(c) for c in FACT_VACANCY.names], RANGE_COL,
            F.when(hit, F.lit("update")).otherwise(F.lit("keep")).alias("_op"),
            F.when(hit, F.struct(*IMAGE)).alias("_before"),
        )
        mart_feed.apply_change(spark, root, rows.checkpoint(eager=True))
    dim = read_stored(spark, root, table).join(gone, F.col(key) == F.col("_gone"), "left_anti")
    write_version(dim.checkpoint(eager=True), root, table)
    mart_feed.refresh_stats(spark, root)
    return ranges


# Declared integrity of the stored star: unique dimension keys and the fact's
# four references (NULL keys exempt in both).
DIMENSION_KEYS = {"dim_area": "area_id", "dim_employer": "employer_id", "dim_experience": "experience_id",
                  "dim_currency": "currency_id"}


def verify(spark: SparkSession, root: str | None = None, fact: DataFrame | None = None, full: bool = False) -> dict[str, int]:
    """Q1/Q2 over the stored star: duplicate dimension keys and orphan fact keys.

    Returns the number of violations per constraint (all 0 for a healthy
    star). The references are checked on ``fact_keys``, which every load keeps
    with the ranges it touches: the fact is not read. It is with ``full``, and
    where a change of the fact did not end; ``fact`` checks just those rows.
    """
    root = root or warehouse_root(spark)
    dims = {table: read_stored(spark, root, table) for table in DIMENSION_KEYS}
    report = {f"unique:{t}": duplicate_keys(dims[t], key).count() for t, key in DIMENSION_KEYS.items()}
    counts = None if full or fact is not None else key_counts(spark, root)
    if counts is not None:
        known = reduce(
            DataFrame.unionByName,
            [dims[t].select(F.lit(c).alias("column"), F.col(DIMENSION_KEYS[t]).cast("string").alias("key")) for c, t in FOREIGN_KEYS],
        )
        loose = counts.where("key is not null").join(known.distinct(), ["column", "key"], "left_anti").groupBy("column").agg(F.sum("n").alias("n"))
        found = {r["column"]: r["n"] for r in loose.collect()}
        return report | {f"fk:{c}": found.get(c, 0) for c, _ in FOREIGN_KEYS}
    # All references in one pass over the fact: a dimension's distinct keys joined to it, misses counted.
    fact = read_fact(spark, root) if fact is None else fact
    rows, misses = fact.select(*[c for c, _ in FOREIGN_KEYS]), []
    for column, table in FOREIGN_KEYS:
        key = DIMENSION_KEYS[table]
        known = dims[table].where(F.col(key).isNotNull()).select(F.col(key).alias(f"_{column}")).distinct()
        rows = rows.join(known, F.col(column) == F.col(f"_{column}"), "left")
        misses.append(F.count_if(F.col(column).isNotNull() & F.col(f"_{column}").isNull()).alias(f"fk:{column}"))
    return report | rows.agg(*misses).first().asDict()


def marts(spark: SparkSession, root: str | None = None, views: list[str] | None = None) -> dict[str, DataFrame]:
    """U8: the seven marts (or those named in ``views``) over the stored star, registered as temp views.

    From the figures the loads keep current; where a run ended in between and
    they are not, from one scan of the fact that serves all seven.
    """
    from jobsight.plans.marts import publish

    root = root or warehouse_root(spark)
    dims = {
        "area": read_stored(spark, root, "dim_area"),
        "employer": read_stored(spark, root, "dim_employer"),
    }
    stats = mart_feed.stored_stats(spark, root) if mart_feed.current(spark, root) else None
    return publish(spark, read_fact(spark, root), read_stored(spark, root, "dim_currency"), dims, views, stats)


# SQL surface: see ``plans.warehouse_sql``.
def register_tables(spark: SparkSession, root: str | None = None, with_marts: bool = True) -> list[str]:
    """Expose the stored star and the marts under the reference's names for Spark SQL; see ``plans.warehouse_sql``."""
    from jobsight.plans.warehouse_sql import register

    return register(spark, root or warehouse_root(spark), with_marts)
