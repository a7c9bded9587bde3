"""Row numbering without a single-partition window.

``row_number() OVER (ORDER BY k)`` with no partition moves every row into one
task. Here the rows are range-partitioned and sorted by ``k`` (one shuffle)
and written to a reliable checkpoint in the shared ``spark.checkpoint.dir``.
A small job then counts the rows of each partition; like
``RDD.zipWithIndex``, only those counts (one number per partition) reach the
driver, which turns them into offsets. Each row's number is its partition's
offset plus its position inside the partition (``monotonically_increasing_id``),
computed on the executors in one narrow pass over the stored rows.

The checkpoint matters: the counting pass and the numbering pass read the
same stored rows instead of recomputing (and re-shuffling) the input, and
the numbering is stable if a task is retried. The order must be total (the
grain keys of the marts are unique after aggregation).
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsight.session import storage_root

_POS_MASK = (1 << 33) - 1  # monotonically_increasing_id = partition_id << 33 | position


def numbered(df: DataFrame, order: list[Column], id_col: str = "id") -> DataFrame:
    """Prepend ``id_col`` (BIGINT, 1..n) numbering rows in ``order``."""
    storage_root(df.sparkSession)  # a checkpoint dir exists (set by the cluster, or a local one)
    ranked = df.orderBy(*order).checkpoint(eager=True)
    sizes = dict(ranked.groupBy(F.spark_partition_id().alias("p")).count().collect())
    n_parts = max(sizes, default=0) + 1  # trailing empty partitions need no offset
    offsets = [0, *accumulate(sizes.get(p, 0) for p in range(n_parts))][:n_parts]
    offset = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.spark_partition_id() + 1)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK))
    return ranked.select((offset + position + F.lit(1)).cast("bigint").alias(id_col), *df.columns)
