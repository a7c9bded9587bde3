"""Versioned datasets under the shared storage folder.

A refresh never overwrites what readers may be reading: each write goes to a
fresh version directory, and only after the write has committed is a manifest
entry written for it (its own one-row directory). Readers take the newest
entry. A failed or retried task leaves at most an uncommitted directory
nobody points at, so the reference's truncate-then-insert retry hazard cannot
occur. Old versions stay readable until ``expire_versions`` removes them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsight.schemas import SETUP

MANIFEST = "_manifest"
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("committed_at", T.TimestampNTZType()),
    ]
)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def read_if_exists(spark: SparkSession, schema: T.StructType, *paths: str, **options: str) -> DataFrame | None:
    """The Parquet files at ``paths``, or None if there is no such path.

    Only a missing path means "nothing yet". Any other failure (no permission,
    an unreadable listing, a broken file) is raised: taken for an empty table
    it would make the next write replace what is stored.
    """
    try:
        return spark.read.schema(schema).options(**options).parquet(*paths)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def new_version_path(root: str, dataset: str) -> str:
    stamp = _now().strftime("%Y%m%dT%H%M%S%f")
    return f"{root}/{dataset}/v={stamp}-{uuid.uuid4().hex[:8]}"


def commit(spark: SparkSession, root: str, dataset: str, path: str) -> None:
    """Make ``path`` the current version of ``dataset``.

    Each commit writes its own one-row entry directory, so commits of
    different datasets (or processes) never share an output committer.
    """
    now = _now()
    entry = f"{root}/{MANIFEST}/{dataset}/{now.strftime('%Y%m%dT%H%M%S%f')}-{uuid.uuid4().hex[:8]}"
    spark.createDataFrame([(dataset, path, now)], MANIFEST_SCHEMA).coalesce(1).write.parquet(entry)


def current_path(spark: SparkSession, root: str, dataset: str) -> str | None:
    """Newest committed version of ``dataset`` (one small aggregate)."""
    manifest = read_if_exists(spark, MANIFEST_SCHEMA, f"{root}/{MANIFEST}/{dataset}/*")
    if manifest is None:
        return None
    row = manifest.agg(F.max_by("path", "committed_at").alias("path")).first()
    return None if row is None else row["path"]


def write_version(
    df: DataFrame, root: str, dataset: str, partition_by: list[str] | None = None
) -> str:
    """Write ``df`` as a new version of ``dataset`` and commit it."""
    path = new_version_path(root, dataset)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    commit(df.sparkSession, root, dataset, path)
    return path


def read_current(spark: SparkSession, root: str, dataset: str, schema: T.StructType) -> DataFrame:
    """The current version, or an empty frame of ``schema`` before the first write."""
    path = current_path(spark, root, dataset)
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def refresh(df: DataFrame, root: str, dataset: str = "staging") -> DataFrame:
    """Replace the dataset's content with ``df``; returns the re-read rows.

    Re-reading the written files also cuts the lineage of everything that
    produced ``df``: later stages restart from the committed files.
    """
    path = write_version(df, root, dataset)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def expire_versions(spark: SparkSession, root: str, dataset: str, keep: int = 7) -> list[str]:
    """Remove all but the newest ``keep`` committed versions of ``dataset`` and their manifest entries.

    The entry goes first, so no reader is pointed at files being removed.
    Returns the paths removed. Uncommitted version folders are left alone: a
    load may be writing them.
    """
    if keep < 1:
        raise ValueError("the current version cannot expire")
    entries = read_if_exists(spark, MANIFEST_SCHEMA, f"{root}/{MANIFEST}/{dataset}/*")
    if entries is None:
        return []
    rows = entries.select("path", "committed_at", F.col("_metadata.file_path").alias("entry")).collect()  # one per load
    old = sorted(rows, key=lambda r: r["committed_at"], reverse=True)[keep:]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for r in old:
        for p in (jvm.org.apache.hadoop.fs.Path(r["entry"]).getParent(), jvm.org.apache.hadoop.fs.Path(r["path"])):
            p.getFileSystem(conf).delete(p, True)
    return [r["path"] for r in old]


# ----------------------------------------------------------------- run log
def append_bookmark(run_log: DataFrame, ts: dt.datetime | str) -> DataFrame:
    """U2 as a DataFrame: the run log with one more completed run at ``ts``."""
    new = run_log.sparkSession.range(1).select(F.lit(ts).cast("timestamp_ntz").alias("date_start"))
    return run_log.select(*[F.col(f.name).cast(f.dataType) for f in SETUP.fields]).unionByName(new)


def record_run(spark: SparkSession, root: str, ts: dt.datetime) -> None:
    """U2 as a sink: append one row to the run log dataset."""
    spark.createDataFrame([(ts,)], SETUP).coalesce(1).write.mode("append").parquet(f"{root}/setup")


def read_run_log(spark: SparkSession, root: str) -> DataFrame:
    runs = read_if_exists(spark, SETUP, f"{root}/setup")
    return spark.createDataFrame([], SETUP) if runs is None else runs
