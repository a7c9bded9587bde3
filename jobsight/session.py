"""Session defaults, the shared scratch folder and the warehouse root."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Session settings every job in this package assumes. AQE re-plans joins and
# splits skewed shuffle partitions at run time; ANSI makes bad casts and
# division by zero fail instead of yielding NULL (the reference's database
# raises in both cases).
SESSION_DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpointed rows go through the RDD serializer; Kryo writes UnsafeRow
    # natively instead of through Java serialization.
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # Remove reliable checkpoints once no DataFrame refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "jobsight",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def storage_root(spark: SparkSession) -> str:
    """The shared scratch folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at storage every executor can reach, so
    lineage cuts and intermediate tables written below it survive executor
    loss; leaving it unset there is an error. Only a local session (one
    process, one disk) gets a private folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception as e:  # noqa: BLE001 - a remote (Connect) session: the server owns checkpoints
        if root:
            return root.rstrip("/")
        raise RuntimeError("set spark.checkpoint.dir to a shared folder") from e
    if not root:
        root = sc.getCheckpointDir()
        if not root and not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = root or tempfile.mkdtemp(prefix="jobsight-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def warehouse_root(spark: SparkSession) -> str:
    """Where durable tables (fact, dimensions, run log) live: ``spark.jobsight.warehouse``.

    Checkpoints come and go; the warehouse must not, so it has a setting of its
    own, required off local mode.
    """
    root = spark.conf.get("spark.jobsight.warehouse", None)
    if root:
        return root.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.jobsight.warehouse to the durable folder of the tables")
    return f"{storage_root(spark)}/warehouse"
