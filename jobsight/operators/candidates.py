"""MERGE source projections over staging.

Each is a ``SELECT DISTINCT``: NULLs compare equal, so one NULL-keyed row per
batch survives. ``distinct`` is a hash aggregate with a map-side partial step,
so identical copies (a hot group) collapse before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsight.functions.classify import grade, grade_from_experience, rate_to_rub, role


def dim_candidates(staging: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct (key, name) pairs of one dimension."""
    return staging.select(key, name).distinct()


def currency_candidates(staging: DataFrame) -> DataFrame:
    """Distinct currencies with their rate to roubles."""
    return staging.select("salary_currency", rate_to_rub("salary_currency").alias("to_rub")).distinct()


def fact_columns(staging: DataFrame) -> DataFrame:
    """The 14 fact columns derived from staging, before the DISTINCT."""
    return staging.select(
        F.col("id").alias("vacancy_id"),
        role("vacancy_name").alias("vacancy_name"),
        grade("vacancy_name").alias("grade"),
        grade_from_experience("experience_id").alias("grade_experience"),
        "published_at",
        "is_archive",
        "is_open",
        "employer_id",
        "experience_id",
        "area_id",
        "salary_from",
        "salary_to",
        "is_gross",
        "salary_currency",
    )


def fact_candidates(staging: DataFrame) -> DataFrame:
    """Distinct classified fact rows (names and accreditation dropped)."""
    return fact_columns(staging).distinct()


def as_dim(candidates: DataFrame, key: str, name: str, dim_key: str | None = None) -> DataFrame:
    """Candidates renamed to dimension columns (``key``, ``name``)."""
    return candidates.select(F.col(key).alias(dim_key or key), F.col(name).alias("name"))


def as_currency_dim(candidates: DataFrame) -> DataFrame:
    return candidates.select(F.col("salary_currency").alias("currency_id"), "to_rub")
