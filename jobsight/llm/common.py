"""Helpers the corpus operators share: table reads, tables written in the shared folder, Arrow access."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.session import storage_root

#: Bytes of text a Python task works on at once; bounds numpy temporaries whatever the Arrow batch holds.
CHUNK_BYTES = 2 << 20


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver did (a cluster has it installed)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach."""
    return f"{storage_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` as long, ``text`` with null as empty, and the named extra columns; all others are left out."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *extra,
    )


def mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with the barrier of an exact schema; ``fn`` gets record batches, yields dicts of columns."""
    workers_find_package(df.sparkSession)
    fields = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[f.name], type=f.type) if not isinstance(cols[f.name], pa.Array) else cols[f.name].cast(f.type) for f in fields],
                schema=fields,
            )

    return df.mapInArrow(run, schema)


def _arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of whole rows of about ``limit`` bytes of ``column`` (one longer row stays whole)."""
    n = batch.num_rows
    if not n:
        return
    off, _ = flat(batch.column(column))
    start = 0
    while start < n:
        end = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
        end = min(n, max(end, start + 1))
        yield batch.slice(start, end - start)
        start = end


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64, n + 1) and the bytes they point into, without a copy of the bytes; no nulls expected."""
    if not (pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type)):
        width = np.int32
    else:
        width = np.int64
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], width)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return off, data


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits (the public splitmix64 step)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x
