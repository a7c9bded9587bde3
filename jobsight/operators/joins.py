"""Dimension lookups.

Whether a dimension is broadcast is left to Spark's size check, never to an
unconditional hint:

* a stored dimension is broadcast when its estimated size (file size) is
  under ``spark.sql.autoBroadcastJoinThreshold``;
* a dimension computed in the same plan (e.g. a DISTINCT over staging) is
  measured at run time: AQE materialises its shuffle stage first and turns
  the sort-merge join into a broadcast join when the measured size is under
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``, before the large side
  is shuffled for the join.

Beyond the threshold the join stays a shuffle join, and AQE splits a
partition swollen by a hot key (``spark.sql.adaptive.skewJoin.enabled``).
Lookups keep only the needed columns, so the measured size is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The non-NULL-keyed rows of a dimension, pruned to ``key`` + ``columns``.

    NULL keys never satisfy an equality join, so dropping them first loses
    nothing; it also keeps the NULL-keyed rows the reference lets accumulate
    out of the join.
    """
    return df.where(F.col(key).isNotNull()).select(key, *columns)
