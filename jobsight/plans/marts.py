"""The seven salary / demand marts as one parameterised plan.

The reference computes each mart as a stats CTE (scan 1, aggregate 1) joined
back to the fact (scan 2) and grouped again by the dimension key, name and
all 17 stats. Here the fact is scanned and aggregated once per grain key;
only the small per-key result is joined to the dimension and regrouped:

    scan(fact, role filter, pruned)
      -> partial agg -> exchange(grain key, currency) -> agg  # the only fact shuffle
      -> ⟕ currency on aggregated rows, convert exactly
      -> exchange(grain key) -> agg                           # aggregated rows only
      -> ⟕ dimension (per-key rows; broadcast if small, else only the dim moves)
      -> exchange(range of dim key)                           # per-key rows only
      -> regroup by (dim key, dim name, stats), ratios
      -> numbering (sorted within the range partitions, no 1-task window)

The regroup reproduces the reference exactly even for fact keys missing
from the dimension: those rows fall into NULL-key rows, merged when their
stats agree. The NULL grain key keeps its counts but gets NULL stats, since
the reference's stats join is on ``=``.

``mart`` builds one mart (the registered queries); ``publish`` builds all
seven from a single GROUPING SETS scan of the fact (the daily path).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsight.functions.classify import ROLE_DATA_ANALYST, ROLE_DATA_ENGINEER, ROLE_DATA_SCIENTIST
from jobsight.operators.aggregates import (
    COUNT_COLS,
    STAT_COLS,
    grain_stats,
    grain_stats_sets,
    salary_ratio_final,
)
from jobsight.operators.joins import lookup
from jobsight.operators.numbering import numbered
from jobsight.session import storage_root


@dataclass(frozen=True)
class MartSpec:
    view: str
    grain_key: str  # fact column the mart groups by
    role: str | None  # vacancy_name filter; None = all roles, NULL role included
    dim: str | None  # "area" / "employer" / None
    name_col: str | None  # output name of the dimension name column


MARTS = {
    "mart_de_region": MartSpec("de_region", "area_id", ROLE_DATA_ENGINEER, "area", "area_name"),
    "mart_da_region": MartSpec("da_region", "area_id", ROLE_DATA_ANALYST, "area", "area_name"),
    "mart_ds_region": MartSpec("ds_region", "area_id", ROLE_DATA_SCIENTIST, "area", "area_name"),
    "mart_de_employer": MartSpec("de_employer", "employer_id", ROLE_DATA_ENGINEER, "employer", "employer_name"),
    "mart_da_employer": MartSpec("da_employer", "employer_id", ROLE_DATA_ANALYST, "employer", "employer_name"),
    "mart_ds_employer": MartSpec("ds_employer", "employer_id", ROLE_DATA_SCIENTIST, "employer", "employer_name"),
    "mart_vacancies": MartSpec("vacancies", "vacancy_name", None, None, None),
}


def _finish(keyed: DataFrame, grain_key: str, dim: DataFrame | None, name_col: str | None) -> DataFrame:
    """Dimension names, the reference's regroup, ratios and numbering."""
    if dim is None:
        out = keyed
        head = [grain_key]
    else:
        names = lookup(dim, grain_key, ["name"]).withColumnRenamed(grain_key, "_dim_key")
        joined = keyed.join(names, keyed[grain_key] == names["_dim_key"], "left")
        # Range-partition by the output key once: it clusters the regroup
        # below and is already the order the numbering sorts by, so neither
        # needs a shuffle of its own.
        joined = joined.repartitionByRange(F.col("_dim_key").asc_nulls_last())
        out = joined.groupBy(
            F.col("_dim_key").alias(grain_key), F.col("name").alias(name_col), *STAT_COLS
        ).agg(*[F.sum(c).alias(c) for c in COUNT_COLS])
        head = [grain_key, name_col]
    out = out.select(*head, *COUNT_COLS, *STAT_COLS, *salary_ratio_final())
    return numbered(out, [F.col(grain_key).asc_nulls_last()])


def _blank_null_key(stats: DataFrame, grain_key: str) -> DataFrame:
    key_known = F.col(grain_key).isNotNull()
    return stats.select(grain_key, *COUNT_COLS, *[F.when(key_known, F.col(c)).alias(c) for c in STAT_COLS])


def per_key(fact: DataFrame, currency: DataFrame, grain_key: str, role: str | None = None) -> DataFrame:
    """Counts and stats per grain key in one aggregation; NULL key gets NULL stats."""
    rows = fact if role is None else fact.where(F.col("vacancy_name") == role)
    return _blank_null_key(grain_stats(rows, currency, grain_key), grain_key)


def mart(
    fact: DataFrame,
    currency: DataFrame,
    grain_key: str,
    role: str | None = None,
    dim: DataFrame | None = None,
    name_col: str | None = None,
) -> DataFrame:
    """One mart. ``dim`` has columns (``grain_key``, ``name``) with unique keys."""
    return _finish(per_key(fact, currency, grain_key, role), grain_key, dim, name_col)


def build_mart(name: str, fact: DataFrame, currency: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    spec = MARTS[name]
    dim = None if spec.dim is None else dims[spec.dim]
    return mart(fact, currency, spec.grain_key, spec.role, dim, spec.name_col)


# Groupings that serve all seven marts.
MART_GRAINS = [["vacancy_name", "area_id"], ["vacancy_name", "employer_id"], ["vacancy_name"]]


def _grain(spec: MartSpec) -> list[str]:
    return [spec.grain_key] if spec.grain_key == "vacancy_name" else ["vacancy_name", spec.grain_key]


def publish(
    spark,
    fact: DataFrame,
    currency: DataFrame,
    dims: dict[str, DataFrame],
    views: list[str] | None = None,
    stats: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """U8: the seven marts (or those named in ``views``), registered as temp views named like the reference's.

    The fact is scanned once: one GROUPING SETS aggregation yields the
    per-key counts and stats of the groupings that the wanted marts need,
    checkpointed (per-key rows only); each mart is a slice of it. With
    ``stats`` (``_set`` an index into ``MART_GRAINS``) the fact is not read.
    """
    wanted = [m for m in MARTS.values() if views is None or m.view in views]
    if stats is None:
        grains = [g for g in MART_GRAINS if any(_grain(m) == g for m in wanted)]
        storage_root(spark)
        stats = grain_stats_sets(fact, currency, grains).checkpoint(eager=True)
    else:
        grains = MART_GRAINS

    def finish(spec: MartSpec) -> tuple[str, DataFrame]:
        rows = stats.where(F.col("_set") == grains.index(_grain(spec)))
        if spec.role is not None:
            rows = rows.where(F.col("vacancy_name") == spec.role)
        keyed = _blank_null_key(rows, spec.grain_key)
        dim = None if spec.dim is None else dims[spec.dim]
        return spec.view, _finish(keyed, spec.grain_key, dim, spec.name_col)

    # The seven slices are independent: their (small) jobs run concurrently.
    with ThreadPoolExecutor(max_workers=len(MARTS)) as pool:
        out = dict(pool.map(finish, wanted))
    for view, df in out.items():
        df.createOrReplaceTempView(view)
    return out
