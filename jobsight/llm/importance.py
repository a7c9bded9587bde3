"""Target-distribution importance resampling: documents drawn by how much their words resemble a target's.

1. Counts. A feature is a run of 1 to ``runs`` consecutive words; its bucket is
   a checksum of its bytes. Every task adds up one array of ``buckets`` numbers
   over its whole texts and passes on the buckets it met, so a shuffle holds at
   most ``buckets`` rows a task, and the sums over all documents and over all
   target texts are ``buckets`` numbers each, whatever the corpus.
2. Weights. A bucket's gain is the scaled log ratio of its smoothed shares in
   target and corpus. The gains are one array sent to the tasks; a slice's
   features become one vector of buckets, numpy gathers their gains and adds
   them up by document. The weight is the floored mean; the score adds a Gumbel
   draw from the document's id, so the highest scores are a sample without
   replacement by weight.
3. Selection. The ``k`` best of all drawable documents are found by distributed
   quickselect on the composite key (score downwards, id upwards, features,
   place in the written table: no two rows are equal). A round picks
   ``PIVOTS`` random pivot keys, counts the rows below, at and between them
   exactly, and goes on with the one interval that holds the ``k``-th key,
   written as a table of its own; rounds grow with the logarithm of the rows.
   A round's counts and next pivots are all that reaches the driver.
4. Ranks. Only the winners are sorted (by range, into many tasks) and
   numbered; all other rows are passed on as they are.

A null text has no words (weight 0); a null id is drawn as the empty string and
comes after all ids where scores tie; repeated rows are documents of their
own, and tie by their place. Fewer than ``min_words`` words: never drawn. With
an empty target the gains are those of counts of zero. An empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.llm.common import mapped, read, saved, slices, texts
from jobsight.operators.numbering import numbered

BUCKETS = 10_000
SCALE = 1000
SEED = 2024
PERCENT = 10
MIN_WORDS = 20
PIVOTS = 12
#: Words whose bucket a task keeps, and the longest of them in bytes.
CACHE_WORDS, CACHE_BYTES = 300_000, 64

#: Byte to byte: A-Z to lower case, whatever is no word byte to a blank. All bytes beyond ASCII are word bytes.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


class Buckets(dict):
    """Bucket of a feature's bytes, kept for those met before."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.buckets
        if len(feature) <= CACHE_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[feature] = bucket
        return bucket


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split()


def _features(text: str, runs: int, known: Buckets) -> tuple[int, np.ndarray]:
    """(number of words, bucket of every feature)."""
    own = words(text)
    some = own if runs == 1 else [b" ".join(own[i : i + k]) for k in range(1, runs + 1) for i in range(len(own) - k + 1)]
    return len(own), np.fromiter(map(known.__getitem__, some), np.int64, len(some))


def _count(batches, runs: int, buckets: int):
    known, total = Buckets(buckets), np.zeros(buckets, np.int64)
    for b in batches:
        for t in b.column("text").to_pylist():
            total += np.bincount(_features(t, runs, known)[1], minlength=buckets)
    met = np.flatnonzero(total)
    yield {"bucket": met, "n": total[met]}


def bucket_counts(rows: DataFrame, runs: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all texts of ``rows`` (a column ``text``)."""
    own = rows.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    met = mapped(own, lambda it: _count(it, runs, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in met.collect():  # one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored ``SCALE`` times the log ratio of each bucket's smoothed shares."""
    n = len(corpus)
    s, t = float(corpus.sum() + n), float(target.sum() + n)
    ratio = [((b + 1.0) * s) / ((a + 1.0) * t) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(SCALE * math.log(r)) for r in ratio], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(batches, gain: np.ndarray, runs: int, seed: int):
    known = Buckets(len(gain))
    for whole in batches:
        for b in slices(whole):
            ids = b.column("doc_id").to_pylist()
            found = [_features(t, runs, known) for t in b.column("text").to_pylist()]
            n = np.array([len(f) for _, f in found], np.int64)
            sums = np.zeros(len(n), np.int64)
            full = np.flatnonzero(n)
            if len(full):
                sums[full] = np.add.reduceat(gain[np.concatenate([f for _, f in found])], (np.cumsum(n) - n)[full])
            weight = sums // np.maximum(n, 1)
            score = weight + np.array([gumbel(d, seed) for d in ids], np.int64)
            yield {"doc_id": b.column("doc_id"), "n_words": [w for w, _ in found], "n_features": n, "weight": weight, "score": score}


def scored(docs: DataFrame, target: DataFrame, runs: int = 1, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    gain = gains(bucket_counts(docs, runs, buckets), bucket_counts(target, runs, buckets))
    kind = "doc_id long, n_words long, n_features long, weight long, score long"
    return mapped(texts(docs), lambda it: _score(it, gain, runs, seed), kind)


#: The composite key: what comes first is smaller. ``row`` is the place in the written table.
KEY = ("less", "no_id", "id", "n_features", "row")


def _key() -> F.Column:
    return F.struct(
        (-F.col("score")).alias("less"), F.col("doc_id").isNull().cast("int").alias("no_id"),
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("n_features"), F.col("row"),
    )


def _literal(key) -> F.Column:
    kinds = ("long", "int", "long", "long", "long")
    return F.struct(*[F.lit(key[c]).cast(t).alias(c) for c, t in zip(KEY, kinds, strict=True)])


def kth_key(keys: DataFrame, k: int):
    """The ``k``-th smallest (from 1) of the column ``key`` of ``keys``, whose rows are all different."""
    rounds = 0

    def draw() -> list[F.Column]:
        return [F.min_by("key", F.xxhash64("key", F.lit(rounds * PIVOTS + j))).alias(f"p{j}") for j in range(PIVOTS)]

    first = keys.agg(*draw()).first()
    pivots = sorted({tuple(p) for p in first if p is not None})
    while True:
        rounds += 1
        lit = [_literal(dict(zip(KEY, p, strict=True))) for p in pivots]
        # 0 below the first pivot, 1 at it, 2 between it and the second, and so on.
        place = sum(((F.col("key") >= p).cast("int") + (F.col("key") > p).cast("int") for p in lit), F.lit(0))
        parts = {r["place"]: r for r in keys.groupBy(place.alias("place")).agg(F.count("*").alias("n"), *draw()).collect()}
        for at in sorted(parts):
            n = parts[at]["n"]
            if k <= n:
                break
            k -= n
        else:
            raise ValueError("fewer rows than asked for")
        if at % 2:
            return pivots[at // 2]
        pivots = sorted({tuple(parts[at][f"p{j}"]) for j in range(PIVOTS)})
        keys = saved(keys.where(place == at), "quickselect")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, runs: int = 1,
    buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row; ``rank`` is null where a row is not drawn."""
    table = saved(scored(docs, target, runs, buckets, seed).withColumn("row", F.monotonically_increasing_id()), "importance")
    able = F.col("n_words") >= min_words
    k = table.where(able).count() * percent // 100
    out = [c for c in table.columns if c != "row"]
    if not k:
        return table.select(*out, F.lit(None).cast("long").alias("rank"))
    last = kth_key(table.where(able).select(_key().alias("key")), k)
    won = able & (_key() <= _literal(dict(zip(KEY, last, strict=True))))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("row")]
    winners = numbered(table.where(won), order, "rank").select(*out, "rank")
    return winners.unionByName(table.where(~won).select(*out, F.lit(None).cast("long").alias("rank")))


def op12_quickselect(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = """
WITH w AS (
    SELECT 'd' AS side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
    UNION ALL
    SELECT 'b', NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark
), counted AS (
    SELECT side, doc_id, word, count(*) AS n FROM (SELECT side, doc_id, unnest(words) AS word FROM w) GROUP BY ALL
), crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS UBIGINT), CAST(range(8) AS UBIGINT[])),
        lambda c, bit: CASE WHEN c % 2 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END)) AS step
), word AS (
    SELECT word, CAST(xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(range(octet_length(encode(word))),
                     lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS UBIGINT))),
        lambda c, byte: xor(c >> 8, step[CAST(xor(c, byte) & 255 AS INT) + 1]))) % 10000 AS INT) AS bucket
    FROM (SELECT DISTINCT word FROM counted), crc
), bucket AS (
    SELECT b AS bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
    FROM range(10000) r(b) LEFT JOIN (counted JOIN word USING (word)) ON bucket = b GROUP BY b
), gain AS (
    SELECT bucket, CAST(floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000)) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
    FROM bucket
), weighed AS (
    SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain)::DOUBLE / sum(n)) AS BIGINT) AS weight
    FROM counted JOIN word USING (word) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY doc_id
), scored AS (
    SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || d.doc_id)[1:8] AS UBIGINT) + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM documents d LEFT JOIN weighed USING (doc_id)
), ranked AS (
    SELECT *, n_features >= 20 AS able, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
           count(*) OVER (PARTITION BY n_features >= 20) AS n
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 10 * n // 100 THEN place END AS rank FROM ranked
"""
