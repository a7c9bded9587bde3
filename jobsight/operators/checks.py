"""Declared integrity as data checks.

Spark cannot enforce UNIQUE or FOREIGN KEY on files, so each constraint is a
query returning the offending rows; callers fail when it is non-empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsight.operators.joins import lookup


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Q1: non-NULL keys held by more than one row, with their row count ``n``.

    A hash aggregate with a map-side partial count: a key on a third of all
    rows is counted in every map task and shuffled as one row per task.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def _dim_keys(dim: DataFrame, dim_key: str) -> DataFrame:
    return lookup(dim, dim_key, []).withColumnRenamed(dim_key, "_dim_key")


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Q2: fact rows whose non-NULL ``key`` has no row in ``dim``.

    Left-anti join against the dimension's keys: broadcast when the key list
    is small, else a shuffle join where AQE splits a skewed fact partition.
    """
    keys = _dim_keys(dim, dim_key or key)
    rows = fact.where(F.col(key).isNotNull())
    return rows.join(keys, rows[key] == keys["_dim_key"], "left_anti")


def nullify_orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Q3: ON DELETE SET NULL — a fact key with no dimension row becomes NULL."""
    keys = _dim_keys(dim, dim_key or key)
    joined = fact.join(keys, fact[key] == keys["_dim_key"], "left")
    return joined.select(
        *[F.when(F.col("_dim_key").isNotNull(), fact[c]).alias(c) if c == key else fact[c] for c in fact.columns]
    )


def over_length(df: DataFrame, limits: dict[str, int], id_cols: list[str]) -> DataFrame:
    """Q4: rows with a string longer than its VARCHAR bound.

    Returns ``id_cols`` and ``violations``: the offending column names joined
    by commas, in the order of ``limits``.
    """
    flags = [F.when(F.length(c) > n, F.lit(c)) for c, n in limits.items()]
    any_over = reduce(lambda a, b: a | b, [F.coalesce(F.length(c) > n, F.lit(False)) for c, n in limits.items()])
    return df.where(any_over).select(*id_cols, F.concat_ws(",", *flags).alias("violations"))
