"""Landed API pages and the source-side predicates.

The reference pulls pages of 100 vacancies from a JSON API. Here the pages
are already landed as JSON documents, one page per line (or one text column
holding a page), and read with a declared schema: no inference pass over
the data. Items stay VARIANT so key presence and JSON types survive.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.functions.classify import SEARCH_PHRASES, title_matches_any
from jobsight.schemas import PAGE

# Lookback periods in days: the first run reaches back a month, later runs
# (a bookmark exists) one day.
FIRST_RUN_DAYS = 30
DAILY_DAYS = 1


def read_pages(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Pages landed under ``path`` (columns of ``schemas.PAGE``).

    JSON lines by default (splittable, one page per line); ``multiline`` reads
    one whole JSON document per file, as an API response saved verbatim.
    """
    return spark.read.schema(PAGE).option("multiLine", str(multiline).lower()).json(path)


def parse_pages(df: DataFrame, text_col: str = "value") -> DataFrame:
    """Pages held as JSON text in ``text_col`` (e.g. read as text or from a queue)."""
    return df.select(F.from_json(F.col(text_col), PAGE).alias("_p")).select("_p.*")


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per (page, position, item). A page without ``items`` yields
    nothing here and is reported by ``pages_without_items``."""
    return pages.select("page", F.posexplode("items").alias("pos", "item"))


def pages_without_items(pages: DataFrame) -> DataFrame:
    """Pages lacking the ``items`` key (the reference fails the run on them)."""
    return pages.where(F.col("items").isNull()).select("page")


def title_search(df: DataFrame, phrases: list[str] = SEARCH_PHRASES, title: str = "vacancy_name") -> DataFrame:
    """Keep rows whose title contains any phrase (``functions.classify.title_matches_any``)."""
    return df.where(title_matches_any(title, phrases))


def lookback_days(has_bookmark: bool) -> int:
    return DAILY_DAYS if has_bookmark else FIRST_RUN_DAYS


def lookback(df: DataFrame, as_of: dt.datetime | str, has_bookmark: bool, column: str = "published_at") -> DataFrame:
    """S3: rows published within the lookback window ending at ``as_of``.

    The window start is a literal, so the predicate reaches the Parquet scan
    (and prunes date-partitioned landings).
    """
    start = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(lookback_days(has_bookmark)))
    return df.where(F.col(column) >= start)


def lookback_landing(
    pages: DataFrame, as_of: dt.datetime | str, has_bookmark: bool, landing_date: str = "date"
) -> DataFrame:
    """S3 on the landing folders: drop pages landed before the window starts.

    With pages landed under ``<landing_date>=YYYY-MM-DD/`` folders this is a
    partition filter, so those folders are never listed or read. A page is
    landed no earlier than its items were published, but the folder's date and
    the items' local times may be of different zones, so the bound leaves a
    day of margin; ``lookback`` decides about the items.
    """
    start = F.to_date(F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(lookback_days(has_bookmark))))
    return pages.where(F.col(landing_date) >= F.date_sub(start, 1))


def has_bookmark(run_log: DataFrame) -> bool:
    """Has any run completed staging? Reads at most one row."""
    return not run_log.isEmpty()


def bookmark_state(run_log: DataFrame) -> DataFrame:
    """S4 as a one-row DataFrame: ``has_bookmark`` and the ``lookback_days`` it implies."""
    probe = run_log.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_bookmark"))
    days: Column = F.when(F.col("has_bookmark"), F.lit(DAILY_DAYS)).otherwise(F.lit(FIRST_RUN_DAYS))
    return probe.select("has_bookmark", days.alias("lookback_days"))
