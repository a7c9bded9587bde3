"""The daily load driven by Structured Streaming.

The reference is a daily batch; late items are caught only by the next
day's lookback window. Here new page files in a landing folder are picked up
by a file stream: ``Trigger.AvailableNow`` processes everything landed since
the last run (in bounded micro-batches) and stops, which is the daily batch
with exactly-once bookkeeping of which files were processed in the stream's
checkpoint. Each micro-batch runs the same load as the batch path
(``plans.daily_load.load``) through ``foreachBatch``.

Replays: each loaded epoch is recorded under the warehouse, and a micro-batch
whose epoch is recorded already is skipped. A batch that failed half-way is
applied again whole: the fact and non-NULL dimension keys converge (the merge
is idempotent on them).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from jobsight.plans.daily_load import load
from jobsight.schemas import PAGE
from jobsight.session import warehouse_root
from jobsight.sinks.versioned import read_if_exists

EPOCHS = T.StructType([T.StructField("checkpoint", T.StringType()), T.StructField("epoch", T.LongType())])


def page_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(PAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(landing_dir)


def epoch_done(spark: SparkSession, root: str, checkpoint: str, epoch_id: int) -> bool:
    """Whether the stream with this checkpoint has loaded this micro-batch before."""
    done = read_if_exists(spark, EPOCHS, f"{root}/_epochs")
    return done is not None and not done.where((F.col("checkpoint") == checkpoint) & (F.col("epoch") == epoch_id)).isEmpty()


def start_landing_ingest(
    spark: SparkSession,
    landing_dir: str,
    root: str | None = None,
    checkpoint: str | None = None,
    as_of: Callable[[], dt.datetime] | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    **load_options,
) -> StreamingQuery:
    """Start the stream; ``as_of()`` gives each micro-batch its run date.

    ``max_files_per_trigger`` bounds a micro-batch, so a backlog of landed
    pages is worked off in several loads instead of one oversized one.
    """
    root = root or warehouse_root(spark)
    checkpoint = checkpoint or f"{root}/_streams/landing_ingest"

    def run_batch(pages: DataFrame, epoch_id: int) -> None:
        if pages.isEmpty() or epoch_done(spark, root, checkpoint, epoch_id):
            return
        load(spark, pages, root=root, as_of=as_of() if as_of else None, **load_options)
        spark.createDataFrame([(checkpoint, epoch_id)], EPOCHS).coalesce(1).write.mode("append").parquet(f"{root}/_epochs")

    writer = page_stream(spark, landing_dir, max_files_per_trigger).writeStream.foreachBatch(run_batch).option(
        "checkpointLocation", checkpoint
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
