"""Conditional aggregates of the marts.

Every aggregate here is algebraic (sum / count / min / max), so Spark runs a
partial aggregate before the shuffle on the grain key: a key holding a third
of all rows still leaves each map task with a few rows per key, and no group is
ever collected into one task.

``grain_stats`` computes all counts (A5-A8) and stats (A1-A4) per grain key
(A9) in one two-level aggregation; ``salary_ratio_final`` derives the ratios.
``priced`` is the per-row rouble conversion (K6, J1).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.functions.classify import GRADE_SUFFIXES, effective_grade
from jobsight.functions.money import avg_from_units, ratio
from jobsight.operators.joins import lookup

# Grades counted on the effective grade, with their column names.
COUNTED_GRADES = [("Intern", "cnt_intern"), ("Junior", "cnt_junior"), ("Middle", "cnt_middle"), ("Senior", "cnt_senior")]
LEAD_GRADE = "Team Lead"

AVG_COLS = [f"avg_sal_{s}" for _, s in GRADE_SUFFIXES]
MIN_COLS = [f"min_sal_{s}" for _, s in GRADE_SUFFIXES]
MAX_COLS = [f"max_sal_{s}" for _, s in GRADE_SUFFIXES]
OVERALL_COLS = ["min_salary", "max_salary"]
STAT_COLS = AVG_COLS + MIN_COLS + MAX_COLS + OVERALL_COLS
COUNT_COLS = ["cnt_vacancy", "cnt_vac_salary"] + [c for _, c in COUNTED_GRADES] + ["cnt_lead"]
RATIO_COLS = [f"ratio_sal_{s}" for _, s in GRADE_SUFFIXES]

def _per_context(build: Callable[[], list[Column]]) -> Callable[[], list[Column]]:
    """Cache an expression list per active SparkContext.

    The mart expression lists hold a few thousand small JVM objects; building
    them through py4j costs tenths of a second per query. Columns are
    immutable, unresolved expressions, so one list serves every plan of the
    same context; a new context (new JVM gateway) builds its own.
    """
    cache: dict[str, list[Column]] = {}
    lock = Lock()  # marts are published from several threads

    @wraps(build)
    def cached() -> list[Column]:
        session = SparkSession.getActiveSession()
        key = session.sparkContext.applicationId if session is not None else ""  # unique per context, unlike id()
        with lock:
            if key not in cache:
                cache.clear()
                cache[key] = build()
            return list(cache[key])

    return cached


_GRADE = "_grade"
_FROM = "_rub_from"
_TO = "_rub_to"


def priced(fact: DataFrame, currency: DataFrame) -> DataFrame:
    """Fact rows with the effective grade and salaries in roubles.

    The currency dimension is a short code list. Pass a stored one: its size is
    known before planning, so Spark's size check (``operators.joins``)
    broadcasts it and the fact is not shuffled for it (a shuffle on the
    currency would put every rouble-priced row in one task). An unlisted or missing currency leaves the rouble amounts NULL.
    """
    rates = lookup(currency, "currency_id", ["to_rub"])
    joined = fact.join(rates, fact["salary_currency"] == rates["currency_id"], "left")
    return joined.withColumns(
        {
            _GRADE: effective_grade("grade", "grade_experience"),
            _FROM: F.col("salary_from") * F.col("to_rub"),
            _TO: F.col("salary_to") * F.col("to_rub"),
        }
    )


def _is(grade_value: str) -> Column:
    return F.col(_GRADE) == grade_value


# A1: ROUND(AVG(COALESCE(to, from)), 2) per grade (upper bound preferred),
# from the exact sums and counts of ``_level2_aggs``. A2-A4 (MIN of the lower
# bound, MAX of the upper bound per grade, and both over all rows) come out
# of it directly.
@_per_context
def salary_avg_final() -> list[Column]:
    return [avg_from_units(F.col(f"_sum_{s}"), F.col(f"_n_{s}")).alias(f"avg_sal_{s}") for _, s in GRADE_SUFFIXES]


@_per_context
def stat_final() -> list[Column]:
    """The 17 published stat columns from the aggregated ones."""
    return salary_avg_final() + [F.col(c) for c in MIN_COLS + MAX_COLS + OVERALL_COLS]


@_per_context
def salary_ratio_final() -> list[Column]:
    """ROUND(avg_sal_x / max_salary, 2) per grade; may exceed 1 (the average
    may use a lower bound, the maximum never does). A zero maximum raises."""
    return [ratio(F.col(f"avg_sal_{s}"), F.col("max_salary")).alias(f"ratio_sal_{s}") for _, s in GRADE_SUFFIXES]


# ---------------------------------------------------------------------------
# Two-level form used by the marts. Level 1 groups the fact by (key, currency,
# effective grade) with nine plain aggregates; level 2 works on those groups
# only: it converts to roubles and spreads the grades over columns.
#
# Exact, because decimal arithmetic is: SUM(s * r) = r * SUM(s), and for
# r >= 0 MIN(s * r) = r * MIN(s) (for r < 0 the bounds swap; a NULL rate gives
# NULL, which MIN/MAX/COUNT skip, as they skip the per-row NULL products).
# Per fact row only long-backed DECIMAL(18,2) sums, counts and comparisons
# remain, none of them conditional on a grade; wide decimal products happen
# once per group, and the fact is never joined to the currency table.
# ---------------------------------------------------------------------------
_CUR = "salary_currency"
#: Level 1 columns that add up, and those that take the least or the greatest.
ADDED = ["n", "n_open", "n_paid", "n_lead", "pay"]
LEAST, GREATEST = ["lo_from", "lo_to"], ["hi_from", "hi_to"]


def graded(fact: DataFrame) -> DataFrame:
    return fact.withColumn(_GRADE, effective_grade("grade", "grade_experience"))


def row_measures(sign: Column | None = None) -> list[Column]:
    """What one fact row adds to its group's ``ADDED`` columns, times ``sign``.

    ``n_open`` is A5, ``n_paid`` A6 (any raw bound: unlisted currencies count
    too), ``n`` A7 by effective grade, ``n_lead`` A8 by title grade; ``pay`` over
    ``n_paid`` makes A1.
    """
    s = F.lit(1) if sign is None else sign
    one = s.cast("bigint")
    frm, to = F.col("salary_from"), F.col("salary_to")

    def count_if(c: Column) -> Column:
        return F.when(c, one).otherwise(F.lit(0).cast("bigint"))

    paid = frm.isNotNull() | to.isNotNull()
    pay = F.coalesce(to, frm)
    return [
        one.alias("n"), count_if(F.col("is_open")).alias("n_open"), count_if(paid).alias("n_paid"),
        count_if(F.col("grade") == LEAD_GRADE).alias("n_lead"),
        (pay if sign is None else pay * s.cast("decimal(1,0)")).cast("decimal(18,2)").alias("pay"),
    ]


@_per_context
def _level1_aggs() -> list[Column]:
    # A plain row's measures, aggregated without first being made columns.
    sums = [F.sum(c).alias(n) for c, n in zip(row_measures(), ADDED, strict=True)]
    frm, to = F.col("salary_from"), F.col("salary_to")
    return sums + [F.min(frm).alias("lo_from"), F.min(to).alias("lo_to"), F.max(frm).alias("hi_from"), F.max(to).alias("hi_to")]


@_per_context
def merge_aggs() -> list[Column]:
    """Level 1 groups merged into coarser ones."""
    return [f(c).alias(c) for f, cols in ((F.sum, ADDED), (F.min, LEAST), (F.max, GREATEST)) for c in cols]


def _priced_groups(level1: DataFrame, currency: DataFrame) -> DataFrame:
    """Level 1 groups with their sum as an exact integer of 1e-8 roubles and their bounds in roubles."""
    rates = lookup(currency, "currency_id", ["to_rub"])
    r = F.col("to_rub")
    units = (F.col("pay") * F.lit(100)).cast("decimal(38,0)") * (r * F.lit(1_000_000)).cast("decimal(38,0)")
    return level1.join(rates, level1[_CUR] == rates["currency_id"], "left").withColumns(
        {
            "_units": units,
            "_n_rub": F.when(r.isNotNull(), F.col("n_paid")).otherwise(F.lit(0)),
            "_low": F.when(r >= 0, F.col("lo_from") * r).otherwise(F.col("hi_from") * r),
            "_high": F.when(r >= 0, F.col("hi_to") * r).otherwise(F.col("lo_to") * r),
        }
    )


@_per_context
def _level2_aggs() -> list[Column]:
    lead = F.col("n_lead")
    # A5 and A6 are 0 when none, A7 and A8 NULL.
    out = [F.sum("n_open").alias("cnt_vacancy"), F.sum("n_paid").alias("cnt_vac_salary")]
    out += [F.sum(F.when(_is(g), F.col("n"))).alias(c) for g, c in COUNTED_GRADES]
    out += [F.sum(F.when(lead > 0, lead)).alias("cnt_lead")]
    for g, s in GRADE_SUFFIXES:
        out += [
            F.sum(F.when(_is(g), F.col("_units"))).alias(f"_sum_{s}"),
            F.sum(F.when(_is(g), F.col("_n_rub")).otherwise(F.lit(0))).alias(f"_n_{s}"),
        ]
    out += [F.min(F.when(_is(g), F.col("_low"))).alias(f"min_sal_{s}") for g, s in GRADE_SUFFIXES]
    out += [F.max(F.when(_is(g), F.col("_high"))).alias(f"max_sal_{s}") for g, s in GRADE_SUFFIXES]
    out += [F.min("_low").alias("min_salary"), F.max("_high").alias("max_salary")]
    return out


def grain_stats(fact: DataFrame, currency: DataFrame, key: str) -> DataFrame:
    """The 7 counts (A5-A8) and 17 stats (A1-A4) per grain key.

    The NULL key is a group with its stats, as in the reference's stats CTE.
    Two exchanges: (key, currency, grade) after a map-side partial aggregate of
    the fact, then key over the already aggregated rows.
    """
    level1 = graded(fact).groupBy(key, _CUR, _GRADE).agg(*_level1_aggs())
    level2 = _priced_groups(level1, currency).groupBy(key).agg(*_level2_aggs())
    return level2.select(key, *COUNT_COLS, *stat_final())


def group_keys(grains: list[list[str]]) -> list[str]:
    return sorted({k for g in grains for k in g})


def group_partials(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Level 1 by all ``keys``, currency and grade at once: groups that every coarser grain can be merged from."""
    return graded(fact).groupBy(*keys, _CUR, _GRADE).agg(*_level1_aggs())


def _by_sets(rows: DataFrame, grains: list[list[str]], aggs: list[Column], numbers: list[int] | None = None) -> DataFrame:
    """``aggs`` for several groupings (and currency and grade) in one scan of ``rows``.

    The result has every key column (NULL where a grouping does not use it) and
    ``_set``, the grouping's index in ``grains`` (or its entry in ``numbers``). GROUPING SETS expands each row
    once per grouping in memory before one partial aggregate, so the rows are
    read and shuffled once for all groupings.
    """
    keys = group_keys(grains)
    level1 = rows.groupingSets([[*g, _CUR, _GRADE] for g in grains], *keys, _CUR, _GRADE).agg(F.grouping_id().alias("_gid"), *aggs)
    # grouping_id sets bit i (from the left of ``keys + [currency, grade]``) when that
    # column is not grouped; map each bit pattern back to its grouping.
    width = len(keys) + 2
    gid_of = {
        sum(1 << (width - 1 - i) for i, k in enumerate(keys) if k not in g): n
        for n, g in zip(numbers or range(len(grains)), grains, strict=True)
    }
    set_index = F.element_at(F.create_map(*[F.lit(x) for kv in gid_of.items() for x in kv]), F.col("_gid"))
    return level1.select(set_index.alias("_set"), *[c for c in level1.columns if c != "_gid"])


def _finish_sets(level1: DataFrame, currency: DataFrame, keys: list[str]) -> DataFrame:
    level2 = _priced_groups(level1, currency).groupBy("_set", *keys).agg(*_level2_aggs())
    return level2.select("_set", *keys, *COUNT_COLS, *stat_final())


def grain_stats_sets(fact: DataFrame, currency: DataFrame, grains: list[list[str]]) -> DataFrame:
    """``grain_stats`` for several groupings in one scan of the fact."""
    return _finish_sets(_by_sets(graded(fact), grains, _level1_aggs()), currency, group_keys(grains))


#: Keys with so many values that level 1 of their grain has about as many rows as the stored groups.
FINE_KEYS = {"employer_id"}


def partial_stats_sets(partials: DataFrame, currency: DataFrame, grains: list[list[str]]) -> DataFrame:
    """``grain_stats_sets`` from stored ``group_partials``, without the fact.

    Coarse grains are merged by level 1 first, which leaves few rows to price.
    A fine grain would only be copied by it: its groups (for one key at most
    one per other key, currency and grade, whatever the fact holds) are dealt
    by key once, priced as they are, and aggregated where they lie.
    """
    keys, out = group_keys(grains), []
    types = {f.name: f.dataType for f in partials.schema.fields}

    def whole(stats: DataFrame) -> DataFrame:
        held = [F.col(k) if k in stats.columns else F.lit(None).cast(types[k]).alias(k) for k in keys]
        return stats.select("_set", *held, *COUNT_COLS, *STAT_COLS)

    coarse = [n for n, g in enumerate(grains) if not FINE_KEYS & set(g)]
    if coarse:
        some = [grains[n] for n in coarse]
        out.append(whole(_finish_sets(_by_sets(partials, some, merge_aggs(), coarse), currency, group_keys(some))))
    for n, g in enumerate(grains):
        if n not in coarse:
            # Rates are looked up after the deal: level 2 needs no further shuffle.
            level2 = _priced_groups(partials.repartition(*g), currency).groupBy(*g).agg(*_level2_aggs())
            out.append(whole(level2.select(F.lit(n).alias("_set"), *g, *COUNT_COLS, *stat_final())))
    return reduce(DataFrame.unionByName, out)
