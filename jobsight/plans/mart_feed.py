"""Mart figures kept current from the fact's change feed (U8).

Stored beside the star, as versioned datasets:

* ``mart_groups``: level 1 of the marts (``aggregates.group_partials``) by
  (role, area, employer, currency, effective grade), in the vacancies' own
  currencies. Every mart is merged from it, so the fact is not read for them.
* ``mart_stats``: counts and statistics in roubles per (role, area), (role,
  employer) and (role), from ``mart_groups`` and the current rates.

A load hands over the images of the rows it changed. Counts and sums follow by
adding the after images and taking off the before images. A least or greatest
value follows too, unless it left with a before image and no after image
reaches it; where every row of the group came with the change, it is that of the
after images. Any other such group is marked (``_lost``) and, when the figures
are next wanted, computed again from the id ranges that ``fact_keys`` names for its
employer. So a day costs its batch, the ranges it touches and the group table,
whatever the fact holds.

If a run ended while the fact was being changed, or there are no groups yet, the
groups are built from the whole fact once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.operators.aggregates import (
    ADDED,
    GREATEST,
    LEAST,
    grain_stats_sets,
    graded,
    group_keys,
    group_partials,
    partial_stats_sets,
    row_measures,
)
from jobsight.plans import fact_store as S
from jobsight.plans.marts import MART_GRAINS
from jobsight.schemas import DIM_CURRENCY, FACT_VACANCY
from jobsight.session import storage_root
from jobsight.sinks.versioned import current_path, read_current, write_version

GROUPS, STATS = "mart_groups", "mart_stats"
KEYS = group_keys(MART_GRAINS)
GROUP = [*KEYS, "salary_currency", "_grade"]
_SIGN = "_sign"
#: Each bound with the fact column it is taken of.
BOUNDS = {c: "salary_" + c.partition("_")[2] for c in [*LEAST, *GREATEST]}


LOST = "_lost"


def _fresh(fact: DataFrame) -> DataFrame:
    return group_partials(fact, KEYS).withColumn(LOST, F.lit(False))


def stored_groups(spark: SparkSession, root: str) -> DataFrame:
    return read_current(spark, root, GROUPS, _fresh(spark.createDataFrame([], FACT_VACANCY)).schema)


def _bound(c: str, value: Column) -> Column:
    return F.min(value) if c in LEAST else F.max(value)


def delta(rows: DataFrame) -> DataFrame:
    """What each image of the changed ``rows`` (of ``merge_rows``) adds to its group, and the bounds that came (``in_``) and went (``out_``) with it."""
    before = rows.where(F.col("_before").isNotNull()).select("_before.*", F.lit(-1).alias(_SIGN))
    after = rows.where(F.col("_op") != "keep").select(*S.IMAGE, F.lit(1).alias(_SIGN))
    images = graded(before.unionByName(after))
    sums = [m.alias(f"d_{c}") for m, c in zip(row_measures(F.col(_SIGN)), ADDED, strict=True)]
    moved = [F.when(F.col(_SIGN) == sign, F.col(of)).alias(f"{name}_{c}") for name, sign in (("in", 1), ("out", -1)) for c, of in BOUNDS.items()]
    return images.select(*GROUP, *sums, F.greatest(F.col(_SIGN), F.lit(0)).cast("bigint").alias("n_in"), *moved)


def apply_delta(groups: DataFrame, change: DataFrame) -> DataFrame:
    """``groups`` after ``change``; where a bound left and must be looked for, ``_lost``. Emptied groups are gone.

    Stored groups and changes meet in one aggregation: one shuffle, nothing sorted.
    """
    stored = groups.select(*GROUP, *[F.col(c).alias(f"d_{c}") for c in ADDED], *BOUNDS, LOST)
    every = stored.unionByName(change, allowMissingColumns=True)
    # SUM(pay) of a group without any pay is NULL in a fresh aggregate; 0 counts for nothing either.
    sums = [F.coalesce(F.sum(f"d_{c}"), F.lit(0)).cast(groups.schema[c].dataType).alias(c) for c in ADDED]
    bounds = [_bound(c, F.col(c)).alias(c) for c in BOUNDS]  # of the one stored row
    came_went = [_bound(c, F.col(f"{name}_{c}")).alias(f"{name}_{c}") for name in ("in", "out") for c in BOUNDS]
    n_in, was_lost = F.coalesce(F.sum("n_in"), F.lit(0)).alias("n_in"), F.coalesce(F.max(LOST), F.lit(False)).alias(LOST)
    met = every.groupBy(*GROUP).agg(*sums, *bounds, *came_went, n_in, was_lost).where("n > 0")
    # All rows of the group are after images: the bounds are theirs, whatever left.
    replaced = F.col("n") == F.col("n_in")
    out, lost = [], F.col(LOST)
    for c in BOUNDS:
        now, came, went = F.col(c), F.col(f"in_{c}"), F.col(f"out_{c}")
        pick, reaches = (F.least, came <= now) if c in LEAST else (F.greatest, came >= now)
        left = F.coalesce(went <= now if c in LEAST else went >= now, F.lit(False))
        out.append(F.when(replaced, came).otherwise(pick(now, came)).alias(c))  # if the bound left, right only where another one reaches it
        lost = lost | (left & ~F.coalesce(reaches, F.lit(False)))
    return met.select(*GROUP, *ADDED, *out, (lost & ~replaced).alias(LOST))


def _of_groups(spark: SparkSession, root: str, lost: DataFrame) -> DataFrame:
    """The groups named by ``lost`` computed again, from the id ranges that hold their employers."""
    ranges = S.ranges_holding(spark, root, "employer_id", lost.select("employer_id"))
    names = lost.select(*[F.col(c).alias(f"_{c}") for c in GROUP])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in GROUP])
    fact = graded(S.read_ranges(spark, root, ranges)).join(names, same, "left_semi")
    return _fresh(fact.drop("_grade"))


def apply_change(spark: SparkSession, root: str, rows: DataFrame) -> None:
    """Write the changed ranges of ``rows`` (``merge_fact``) and bring the stored groups up to date with them."""
    storage_root(spark)
    whole = S.marked(spark, root) or current_path(spark, root, GROUPS) is None
    change = None if whole else delta(rows)
    S.reached(spark, root, "writing")
    S.write_ranges(spark, root, rows)
    if whole:
        S.rebuild_keys(spark, root)
        groups = _fresh(S.read_fact(spark, root))
    else:
        groups = apply_delta(stored_groups(spark, root), change)
    write_version(groups, root, GROUPS)
    S.reached(spark, root, "groups")


def rebuild(spark: SparkSession, root: str) -> None:
    """Everything derived from the stored fact, built from it."""
    S.rebuild_keys(spark, root)
    write_version(_fresh(S.read_fact(spark, root)), root, GROUPS)
    S.reached(spark, root, "groups")
    refresh_stats(spark, root)


def settle(spark: SparkSession, root: str) -> DataFrame:
    """The stored groups with every lost bound found again (and stored so)."""
    groups = stored_groups(spark, root)
    lost = groups.where(LOST).select(*GROUP)
    if not lost.isEmpty():
        write_version(groups.where(~F.col(LOST)).unionByName(_of_groups(spark, root, lost)), root, GROUPS)
        groups = stored_groups(spark, root)
    return groups.drop(LOST)


def refresh_stats(spark: SparkSession, root: str) -> None:
    """``mart_stats`` of the stored groups at the stored rates."""
    currency = read_current(spark, root, "dim_currency", DIM_CURRENCY)
    write_version(partial_stats_sets(settle(spark, root), currency, MART_GRAINS), root, STATS)
    S.reached(spark, root, "stats")


def current(spark: SparkSession, root: str) -> bool:
    """Whether ``mart_stats`` follows the stored fact."""
    return S.state(spark, root) == "stats"


def stored_stats(spark: SparkSession, root: str) -> DataFrame:
    schema = grain_stats_sets(spark.createDataFrame([], FACT_VACANCY), spark.createDataFrame([], DIM_CURRENCY), MART_GRAINS).schema
    return read_current(spark, root, STATS, schema)
