"""SCD type-1 upsert on plain files.

Spark's ``MERGE INTO`` needs a row-level table format, so the merge is a
join: ``target ⟗ source`` on the key, each output column chosen from the
source where the row is inserted or the match counts as changed, else kept
from the target. Rules reproduced from the reference MERGE:

* the match is ``=``: NULL keys never match. NULL-keyed rows of both sides
  bypass the join and are kept as they are (a run whose batch holds a NULL
  key adds one more NULL-keyed row). Keeping them out of the join also keeps
  them from piling into one shuffle partition;
* a target column the source does not carry keeps its value on update and
  is NULL on insert;
* unmatched target rows are never deleted;
* two source rows with one key (``on_duplicate``): ``error`` refuses them
  always; ``merge`` only where the MERGE fails, that is where a target row is
  hit by two source rows that both take its update branch, or, under a unique
  key, where two are inserted; ``allow`` takes them all.

One shuffle of both sides on the key; AQE picks sort-merge or shuffled hash.
``merge_rows`` finds duplicates inside that join, without a job of its own: what
a source row must know about the others of its key is counted by a window over
the partitioning that the join needs anyway.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsight.operators.checks import duplicate_keys

Side = Callable[[str], Column]


class DuplicateKeyError(ValueError):
    pass


#: What the message of a refused row begins with.
DUPLICATE = "duplicate merge key"


@dataclass(frozen=True)
class Differs:
    """When a match counts as changed: where ``value`` of both sides differs by ``<>``; always without one."""

    value: Callable[[Side], Column] | None = None

    def __call__(self, t: Side, s: Side) -> Column:
        return F.lit(True) if self.value is None else self.value(t) != self.value(s)


#: Dimension rule: the name differs, NULL and '' counting as equal.
name_changed = Differs(lambda side: F.coalesce(side("name"), F.lit("")))
#: Currency rule: plain ``<>``, so a NULL rate on either side is no change.
rate_changed = Differs(lambda side: side("to_rub"))
#: Fact rule: every match overwrites.
always = Differs()


def _refuse(bad: Column, key: str, value: Column) -> Column:
    """A filter that lets every row through, or fails the job on a bad one."""
    why = F.concat(F.lit(f"{DUPLICATE}: several rows for one {key}, e.g. "), value.cast("string"))
    return F.when(bad, F.raise_error(why).cast("boolean")).otherwise(F.lit(True))


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    key: str,
    changed: Differs = always,
    on_duplicate: str = "merge",
    unique: bool = False,
    before: list[str] | None = None,
) -> DataFrame:
    """The rows of ``target`` after the merge, with ``_op`` (``keep``, ``update``, ``insert``).

    With ``before``, also ``_before``: those columns as they were in a row that
    is updated (NULL otherwise). Duplicates fail the job that computes the rows.
    """
    if on_duplicate not in ("error", "merge", "allow"):
        raise ValueError(f"on_duplicate must be 'error', 'merge' or 'allow', not {on_duplicate!r}")
    missing = [c for c in source.columns if c not in target.columns]
    if missing:
        raise ValueError(f"source columns not in target: {missing}")
    cols = target.columns
    types = {f.name: f.dataType for f in target.schema.fields}

    def tc(c: str) -> Column:
        return F.col(f"t__{c}")

    def sc(c: str) -> Column:
        return F.col(f"s__{c}")

    t = target.where(F.col(key).isNotNull()).select(*[F.col(c).alias(f"t__{c}") for c in cols])
    s = source.where(F.col(key).isNotNull()).select(*[F.col(c).alias(f"s__{c}") for c in source.columns])
    same_key = Window.partitionBy(sc(key))
    if on_duplicate != "allow":
        s = s.withColumn("_rows", F.count(F.lit(1)).over(same_key))
    if on_duplicate == "error":
        s = s.where(_refuse(F.col("_rows") > 1, key, sc(key)))
    if on_duplicate == "merge" and changed.value is not None:
        v = changed.value(sc)
        s = s.withColumns({"_n": F.count(v).over(same_key), "_low": F.min(v).over(same_key), "_high": F.max(v).over(same_key)})
        s = s.withColumns({f"_n{e}": F.count(F.when(v == F.col(e), 1)).over(same_key) for e in ("_low", "_high")})
        s = s.withColumn("_nth", F.row_number().over(same_key.orderBy(sc(key))))

    joined = t.join(s, tc(key) == sc(key), "full_outer")
    here, there = tc(key).isNotNull(), sc(key).isNotNull()
    update = here & there & F.coalesce(changed(tc, sc), F.lit(False))
    if on_duplicate == "merge":
        if changed.value is None:
            hits = F.col("_rows")
        else:  # source rows of the key whose value differs from the target row's
            v, n, low, high = changed.value(tc), F.col("_n"), F.col("_low"), F.col("_high")
            hits = (
                F.when(v.isNull() | (n == 0), F.lit(0)).when(low == high, F.when(v == low, F.lit(0)).otherwise(n))
                .when(v == low, n - F.col("_n_low")).when(v == high, n - F.col("_n_high")).otherwise(F.lit(2))
            )
            # A target row met by several source rows stays one row: the updated one, or the first of those that change nothing.
            joined = joined.where(~(here & there) | update | ((hits == 0) & (F.col("_nth") == 1)))
        bad = update & (hits > 1)
        if unique:
            bad = bad | (~here & there & (F.col("_rows") > 1))
        joined = joined.where(_refuse(F.coalesce(bad, F.lit(False)), key, sc(key)))
    take_source = update | (there & ~here)
    merged = joined.select(
        *[
            (F.when(take_source, sc(c)).otherwise(tc(c)) if c in source.columns else tc(c)).cast(types[c]).alias(c)
            for c in cols
        ],
        F.when(update, F.lit("update")).when(here, F.lit("keep")).otherwise(F.lit("insert")).alias("_op"),
        *([F.when(update, F.struct(*[tc(c).alias(c) for c in before])).alias("_before")] if before else []),
    )
    no_image = [F.lit(None).cast(merged.schema["_before"].dataType).alias("_before")] if before else []
    null_target = target.where(F.col(key).isNull()).select(*cols, F.lit("keep").alias("_op"), *no_image)
    null_source = source.where(F.col(key).isNull()).select(
        *[(F.col(c) if c in source.columns else F.lit(None)).cast(types[c]).alias(c) for c in cols],
        F.lit("insert").alias("_op"), *no_image,
    )
    return merged.unionByName(null_target).unionByName(null_source)


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    changed: Differs = always,
    on_duplicate: str = "error",
    unique: bool = False,
) -> DataFrame:
    """Merge ``source`` into ``target``; returns the new target (target schema).

    ``error`` looks for duplicate keys at once, in a job of its own, so that
    the caller gets a ``DuplicateKeyError`` here; the other modes are those of
    ``merge_rows``.
    """
    if on_duplicate not in ("error", "merge", "allow"):
        raise ValueError(f"on_duplicate must be 'error', 'merge' or 'allow', not {on_duplicate!r}")
    if on_duplicate == "error":
        if not duplicate_keys(source, key).isEmpty():
            raise DuplicateKeyError(f"source holds several rows for one {key}")
        on_duplicate = "allow"
    return merge_rows(target, source, key, changed, on_duplicate, unique).select(*target.columns)


# Configurations of the five loads (U3-U7), in load order: key, rule, whether the key is declared unique.
LOADS = {
    "dim_area": ("area_id", name_changed, True),
    "dim_employer": ("employer_id", name_changed, True),
    "dim_experience": ("experience_id", name_changed, True),
    "dim_currency": ("currency_id", rate_changed, True),
    "fact_vacancy": ("vacancy_id", always, False),
}


def upsert_table(table: str, target: DataFrame, source: DataFrame, on_duplicate: str = "error") -> DataFrame:
    key, changed, unique = LOADS[table]
    return upsert(target, source, key, changed, on_duplicate, unique)
