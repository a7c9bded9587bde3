"""Document sharding on a consistent-hash ring with virtual nodes and bounded loads (native).

The ring has ``POINTS`` places. Every shard owns ``vnodes`` of them; a document
sits at the place its id hashes to and belongs to the first virtual node at or
after it. All documents of one arc meet the shards in the same clockwise order,
so the bounded-load rule works on arcs: each shard has a capacity, an arc fills
its first shard up to that, and what overflows continues clockwise to the next
different shard. Law ``rows``: the capacities are ``n // shards``, the first
``n % shards`` shards one more, so they add up to ``n`` and the rule ends with
every shard exactly full and counts at most one apart.

Only counts per (arc, sub-bucket) reach the driver: ``POINTS * SUB`` rows at
most, whatever the corpus. Ranks are numbered per (arc, sub-bucket), never over
an arc as a whole, so no task holds more than a sliver even if a third of the
rows shared one id (the sub-bucket also hashes the text's checksum).

Nulls: a null text has no bytes (size 1, checksum 0); null ids hash as the
empty string and are placed like any id. Repeated rows each get a slot. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsight.llm.common import read, saved

POINTS = 4096
SUB = 16


def ring(shards: int, vnodes: int) -> list[list[int]]:
    """For each occupied place in ring order: [place, then all shards in clockwise order of first meeting]."""
    owner: dict[int, int] = {}
    for s in range(shards):
        for v in range(vnodes):
            place = int(hashlib.md5(f"{s}#{v}".encode()).hexdigest()[:8], 16) % POINTS
            owner[place] = min(s, owner.get(place, s))
    places = sorted(owner)
    for s in sorted(set(range(shards)) - set(owner.values())):  # every place lost to a smaller shard
        places = sorted({*places, free := next(p for p in range(POINTS) if p not in owner)})
        owner[free] = s
    out = []
    for i, p in enumerate(places):
        order = list(dict.fromkeys(owner[q] for q in places[i:] + places[:i]))
        out.append([p, *order])
    return out


def fill(ring_: list[list[int]], counts: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot): who takes which ranks of each arc, overflow going clockwise."""
    n = sum(counts)
    free = [n // shards + (s < n % shards) for s in range(shards)]
    used, left, out = [0] * shards, list(counts), []
    for step in range(shards):
        for arc, (_, *order) in enumerate(ring_):
            s = order[step]
            take = min(left[arc], free[s])
            if take:
                first = counts[arc] - left[arc]
                out.append((arc, first, first + take, s, used[s]))
                left[arc] -= take
                free[s] -= take
                used[s] += take
    return out


def shard_documents(docs: DataFrame, shards: int = 8, vnodes: int = 64) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` (law ``rows``)."""
    spark = docs.sparkSession
    ring_ = ring(shards, vnodes)
    arc_of, i = [], 0
    for place in range(POINTS):
        while i < len(ring_) and ring_[i][0] < place:
            i += 1
        arc_of.append(i % len(ring_))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    place = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % POINTS
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        F.element_at(F.lit(arc_of), (place + 1).cast("int")).alias("arc"),
    ).withColumn("sub", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(SUB)).cast("int"))
    base = saved(base, "shard-base")
    counted = base.groupBy("arc", "sub").agg(F.count("*").alias("n"))
    per_arc = [0] * len(ring_)
    for r in counted.groupBy("arc").agg(F.sum("n").alias("n")).collect():  # one row per arc at most
        per_arc[r["arc"]] = r["n"]
    pieces = fill(ring_, per_arc, shards)
    plan = _rows(
        spark, [dict(zip(("arc", "lo", "hi", "shard", "slot0"), p, strict=True)) for p in pieces],
        "array<struct<arc:int,lo:long,hi:long,shard:int,slot0:long>>",
    )
    before = Window.partitionBy("arc").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("arc", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("arc", "sub").orderBy("doc_id", "text_crc32", "size")
    ranked = base.withColumn("rn", F.row_number().over(within)).join(
        F.broadcast(offsets), ["arc", "sub"]  # POINTS * SUB rows at most
    ).select("doc_id", "size", "text_crc32", "arc", (F.col("offset") + F.col("rn") - 1).alias("rank"))
    hit = (ranked["arc"] == plan["arc"]) & (ranked["rank"] >= plan["lo"]) & (ranked["rank"] < plan["hi"])
    return ranked.join(F.broadcast(plan), hit).select(  # one row per arc and shard at most
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("slot0") + F.col("rank") - F.col("lo")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from a literal, without a Python-side RDD."""
    one = spark.range(1).select(F.from_json(F.lit(json.dumps(rows)), schema).alias("r"))
    return one.select(F.inline("r"))


def op4_consistent_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"))
