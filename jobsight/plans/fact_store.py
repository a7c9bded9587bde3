"""The stored fact: id ranges, the merge that reads and replaces only touched ones, and what tells which those are.

``fact_vacancy/id_range=<n>`` holds the vacancies of ``FACT_RANGE_WIDTH`` ids.
A merge opens the ranges its batch touches, computes their new rows with the
images of what changed (a reliable checkpoint), and swaps those ranges in.

``fact_keys/id_range=<n>`` beside it counts the rows of each dimension key in
each range. It is written with its range and answers which ranges hold a key,
so that a deleted dimension row (``ON DELETE SET NULL``) or a group to recompute
costs its ranges and not the fact, and how many rows refer to a key that no
dimension has, so that the references are checked without reading the fact.

While a change is being written the warehouse is marked as such (``marked``);
where a run ended in between, nothing trusts ``fact_keys`` or what was derived
from the changes before, until both are built anew from the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsight.operators.upsert import LOADS, merge_rows
from jobsight.schemas import FACT_VACANCY
from jobsight.session import storage_root
from jobsight.sinks.versioned import commit, current_path, read_if_exists

FACT_RANGE_WIDTH = 1_000_000
FACT_DIR, KEYS_DIR = "fact_vacancy", "fact_keys"
RANGE_COL = "id_range"
#: Fact columns that reference a dimension, and the dimension's table.
FOREIGN_KEYS = [
    ("employer_id", "dim_employer"),
    ("experience_id", "dim_experience"),
    ("area_id", "dim_area"),
    ("salary_currency", "dim_currency"),
]
#: What the marts read of a fact row: the columns of a change's images.
IMAGE = ["vacancy_name", "grade", "grade_experience", "is_open", "employer_id", "area_id", "salary_from", "salary_to", "salary_currency"]
FACT_KEYS = T.StructType([T.StructField("column", T.StringType()), T.StructField("key", T.StringType()), T.StructField("n", T.LongType()), T.StructField(RANGE_COL, T.LongType())])
STORED_FACT = T.StructType([*FACT_VACANCY.fields, T.StructField(RANGE_COL, T.LongType())])
STATE = "fact_state"
#: Touched ranges from which one listing of their parent is cheaper than asking for each.
PROBES = 16


def fact_path(root: str) -> str:
    return f"{root}/{FACT_DIR}"


def read_fact(spark: SparkSession, root: str) -> DataFrame:
    """The current fact (without the storage-only ``id_range`` column); empty only if there is none yet."""
    df = read_if_exists(spark, FACT_VACANCY, fact_path(root))
    return spark.createDataFrame([], FACT_VACANCY) if df is None else df.select(*FACT_VACANCY.names)


def range_of(width: int) -> Column:
    return F.floor(F.col("vacancy_id") / F.lit(width)).cast("bigint")


def _stored(spark: SparkSession, root: str, ranges: list[int]) -> list[str]:
    """The folders of those of ``ranges`` that are stored."""
    path = fact_path(root)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    parent = jvm.org.apache.hadoop.fs.Path(path)
    fs = parent.getFileSystem(conf)
    names = [f"{RANGE_COL}={r}" for r in ranges]
    if len(names) <= PROBES:
        return [f"{path}/{n}" for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(parent, n))]
    if not fs.exists(parent):
        return []
    there = {s.getPath().getName() for s in fs.listStatus(parent)}
    return [f"{path}/{n}" for n in names if n in there]


def read_ranges(spark: SparkSession, root: str, ranges: list[int]) -> DataFrame:
    """The stored fact rows of ``ranges``: one relation over their folders, no other is listed or read."""
    return read_ranges_with_id(spark, root, ranges).select(*FACT_VACANCY.names)


def read_ranges_with_id(spark: SparkSession, root: str, ranges: list[int]) -> DataFrame:
    folders = _stored(spark, root, ranges)
    if not folders:
        return spark.createDataFrame([], STORED_FACT)
    return spark.read.schema(STORED_FACT).option("basePath", fact_path(root)).parquet(*folders)


def touched_ranges(source: DataFrame, width: int = FACT_RANGE_WIDTH) -> list[int]:
    """The id ranges of ``source`` (computed, e.g. checkpointed): at most one per ``width`` ids of the batch."""
    found = source.select(range_of(width).alias(RANGE_COL)).where(F.col(RANGE_COL).isNotNull()).distinct()
    return sorted(r[0] for r in found.collect())


def merge_fact(
    spark: SparkSession, root: str, source: DataFrame, width: int = FACT_RANGE_WIDTH, on_duplicate: str = "error"
) -> DataFrame:
    """The new rows of the touched ranges, with ``_op``, ``_before`` (``IMAGE``) and their range; nothing is written.

    The rows are a reliable checkpoint (shared storage): they no longer depend
    on the ranges they replace, and a retried write re-reads them.
    """
    storage_root(spark)
    # The touched-range probe and the merge both read the batch: compute its DISTINCT candidates once.
    source = source.checkpoint(eager=True)
    target = read_ranges(spark, root, touched_ranges(source, width))
    key, changed, unique = LOADS["fact_vacancy"]
    rows = merge_rows(target, source, key, changed, on_duplicate, unique, before=IMAGE)
    return rows.withColumn(RANGE_COL, range_of(width)).checkpoint(eager=True)


def state(spark: SparkSession, root: str) -> str | None:
    """How far the last change came: ``writing``, then ``groups`` (the marts' groups follow it), then ``stats``."""
    return current_path(spark, root, STATE)


def reached(spark: SparkSession, root: str, step: str) -> None:
    commit(spark, root, STATE, step)


def marked(spark: SparkSession, root: str) -> bool:
    """Whether a change began and did not end: what is derived from the fact is out of step with it."""
    return state(spark, root) == "writing"


def write_ranges(spark: SparkSession, root: str, rows: DataFrame) -> None:
    """Replace the ranges of ``rows`` (checkpointed, with ``id_range``) and their entries in ``fact_keys``.

    One task writes each range: with unique ids a range holds at most its
    width of rows, so no task grows with the data.
    """
    _swap(
        # Role-clustered row groups: a mart's pushed role filter skips the
        # row groups of other roles by their min/max statistics.
        rows.select(*FACT_VACANCY.names, RANGE_COL).repartition(RANGE_COL).sortWithinPartitions(RANGE_COL, "vacancy_name"),
        fact_path(root),
    )
    _swap(_keys(rows).repartition(RANGE_COL).sortWithinPartitions(RANGE_COL, "column", "key"), f"{root}/{KEYS_DIR}")


def _keys(rows: DataFrame) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("key")) for c, _ in FOREIGN_KEYS])
    return rows.select(RANGE_COL, F.explode(pairs).alias("p")).groupBy("p.column", "p.key", RANGE_COL).agg(F.count(F.lit(1)).alias("n"))


def _swap(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RANGE_COL).parquet(path)


def rebuild_keys(spark: SparkSession, root: str) -> None:
    """``fact_keys`` of the whole stored fact."""
    stored = read_if_exists(spark, STORED_FACT, fact_path(root))
    if stored is not None:
        _swap(_keys(stored).repartition(RANGE_COL).sortWithinPartitions(RANGE_COL, "column", "key"), f"{root}/{KEYS_DIR}")


def key_counts(spark: SparkSession, root: str) -> DataFrame | None:
    """``column, key, n, id_range`` of the stored fact; None without one, or while a change has not ended."""
    return None if marked(spark, root) else read_if_exists(spark, FACT_KEYS, f"{root}/{KEYS_DIR}")


def ranges_holding(spark: SparkSession, root: str, column: str, keys: DataFrame) -> list[int]:
    """The id ranges whose rows hold any of ``keys`` (one column; NULL is a key) in ``column``."""
    index = read_if_exists(spark, FACT_KEYS, f"{root}/{KEYS_DIR}")
    if index is None:
        return []
    wanted = keys.select(F.col(keys.columns[0]).cast("string").alias("_wanted")).distinct()
    found = index.where(F.col("column") == column).join(wanted, F.col("key").eqNullSafe(F.col("_wanted")), "left_semi")
    return sorted(r[0] for r in found.select(RANGE_COL).distinct().collect())  # one number a range
