"""Best-fit packing of tokenised documents into sequences of at most ``length`` tokens.

Pieces. A document's ids and one closing id 0; only longer documents are cut,
into pieces of ``length`` whose first may be shorter. Null text is an empty
document (one token); repeated rows are packed one by one; an empty table
gives no rows. Extra columns are ignored.

Packing is bulk-synchronous best-fit. Pieces are sorted by size and, within a
size, ranked; open sequences (gaps) likewise. One superstep sweeps the sorted
pieces against the sorted gaps: each piece, longest first, takes its successor,
the smallest gap that holds it; pieces that meet the same gap are resolved by
rank, the next going to the next gap; a gap takes one piece a superstep. Then
gaps shrink and the sweep repeats until nothing fits; what is left seeds new
sequences, longest first and as many as its tokens need, and the sweeps go on.

Sizes are whole numbers up to ``length``, and pieces of one size can stand for
each other, so both sorted sides consist of runs: (size, range of ranks). The
sweep moves runs, splitting them where ranks part. The sizes' counts, at most
``length`` numbers whatever the corpus, are all that leaves the executors.
Ranking and placing the pieces themselves is distributed: ranks are numbered
per (size, bucket) with ``BUCKETS`` buckets a size, so a size that a third of
all pieces share is not one task, and every piece finds its run by a join on
its size with the table of runs.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsight.llm.common import mapped, read, saved, scratch_path, slices, texts

LENGTH = 2048
BUCKETS = 32
#: Fixed value: the pattern by which byte-level BPE files cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: White space in a row from which a text is left to the file's own library; each run is looked at once.
RUN = 100_000
_RUN = re.compile(r"(?<!\s)\s{%d,}" % RUN)


class Ids:
    """Ids of whole texts under a byte-level BPE file of the ``tokenizers`` library.

    The file's vocabulary lists its tokens in the order of their merges, so the
    ids are also the merge ranks, and ``tiktoken`` run on them gives the ids the
    file's own library gives, four times as fast; the tests hold both against
    each other. A text with a run of ``RUN`` or more white-space characters goes
    to the ``tokenizers`` library itself, as ``tiktoken``'s pattern matcher gives
    up on runs of about a million. With ``added``, as the query and the pipeline run it, the file's
    added tokens (``<|endoftext|>``) are found in a text first and get their own
    ids, as the library does by default; without, they are ordinary text, as
    under the library's ``encode_special_tokens``.
    """

    def __init__(self, path: str, added: bool = False):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        if file["model"]["type"] != "BPE" or file["pre_tokenizer"]["type"] != "ByteLevel" or file["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        byte_of = {c: b for b, c in enumerate(_byte_letters())}
        ranks = {bytes(byte_of[c] for c in token): rank for token, rank in file["model"]["vocab"].items()}
        special = {}
        for t in file["added_tokens"] if added else ():
            if t["single_word"] or t["lstrip"] or t["rstrip"] or any(a.startswith(t["content"]) or t["content"].startswith(a) for a in special):
                raise ValueError(f"{path} has added tokens that are not plain strings apart from each other: {t['content']}")
            special[t["content"]] = t["id"]
        self.path, self.added, self.own = path, set(special), None
        self.encoding = tiktoken.Encoding(path, pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)

    def batch(self, texts_: list[str]) -> list[np.ndarray]:
        encode = self.encoding.encode_to_numpy
        return [
            self._by_library(t) if len(t) >= RUN and _RUN.search(t)
            else encode(t, allowed_special=self.added, disallowed_special=()).astype("<u4", copy=False)
            for t in texts_
        ]

    def _by_library(self, text: str) -> np.ndarray:
        if self.own is None:
            from tokenizers import Tokenizer

            self.own = Tokenizer.from_file(self.path)
            self.own.encode_special_tokens = not self.added
        return np.array(self.own.encode(text, add_special_tokens=False).ids, "<u4")


def _byte_letters() -> list[str]:
    """The visible letter that stands for each byte in a byte-level vocabulary: itself, or the next free one from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


_IDS: dict[str, Ids] = {}


def _tokenise(batches, path: str, length: int, with_ids: bool):
    if path not in _IDS:
        _IDS[path] = Ids(path, added=True)
    for whole in batches:
        for b in slices(whole):
            out = {k: [] for k in ("doc_id", "row", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []))}
            columns = (b.column(c).to_pylist() for c in ("doc_id", "row", "text"))
            docs, rows, txt = columns
            for d, r, ids in zip(docs, rows, _IDS[path].batch(txt), strict=True):
                ids = np.append(ids, np.zeros(1, ids.dtype))
                at, end = 0, len(ids) % length or length
                piece = 0
                while at < len(ids):
                    part = ids[at:end]
                    out["doc_id"].append(d)
                    out["row"].append(r)
                    out["piece"].append(piece)
                    out["start"].append(at)
                    out["length"].append(end - at)
                    out["ids_crc32"].append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        out["ids"].append(part.tolist())
                    at, end, piece = end, end + length, piece + 1
            yield out


def pieces(docs: DataFrame, path: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """``doc_id, row, piece, start, length, ids_crc32`` (and ``ids``); ``row`` tells rows of one id apart."""
    own = texts(docs, F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"))
    kind = "doc_id long, row long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return mapped(own, lambda it: _tokenise(it, path, length, with_ids), kind)


def best_fit(counts: dict[int, int], length: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Packs ``counts[size]`` pieces of each size.

    Returns runs (size, first rank, end rank, first sequence, offset), a run's
    k-th piece lying in sequence ``first + k`` at ``offset``, and the number of
    sequences.
    """
    out: list[tuple[int, int, int, int, int]] = []
    left = {s: n for s, n in counts.items() if n}
    done = dict.fromkeys(left, 0)  # ranks of a size already placed
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap size -> runs of sequences (first, count)
    made = 0

    def place(size: int, n: int, first: int, offset: int) -> None:
        out.append((size, done[size], done[size] + n, first, offset))
        done[size] += n
        left[size] -= n
        if not left[size]:
            del left[size]

    while left:
        # Open sequences for what fits nowhere: longest first, as many as its tokens need.
        need = -(-sum(s * n for s, n in left.items()) // length)
        for size in sorted(left, reverse=True):
            n = left[size] if size * 2 > length else min(need, left[size])
            if n <= 0:
                break
            place(size, n, made, 0)
            if size < length:
                gaps.setdefault(length - size, []).append((made, n))
            made += n
            need -= n
        moved = True
        while moved and left:
            moved, later = False, []
            sizes = sorted(gaps)  # this superstep's gaps; those it leaves come into `later`
            for size in sorted(left, reverse=True):
                i = bisect_left(sizes, size)
                while size in left and i < len(sizes):
                    gap = sizes[i]
                    first, n = gaps[gap].pop()
                    take = min(n, left[size])
                    place(size, take, first, length - gap)
                    moved = True
                    if take < n:
                        gaps[gap].append((first + take, n - take))
                    if gap > size:
                        later.append((gap - size, (first, take)))
                    if not gaps[gap]:
                        del gaps[gap]
                        sizes.pop(i)
            for gap, run in later:
                gaps.setdefault(gap, []).append(run)
    return out, made


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """``cut`` (pieces, saved) with ``sequence_id`` and ``offset``; sequences are numbered from 0."""
    spark = cut.sparkSession
    bucket = F.pmod(F.xxhash64("doc_id", "row", "piece", "ids_crc32"), F.lit(BUCKETS)).cast("int")
    cut = cut.withColumn("bucket", bucket)
    counted = cut.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = best_fit(counts, length)
    path = scratch_path(spark, "packing-runs")
    kind = "r_length long, lo long, hi long, first long, offset long"
    one = "array<struct<" + ",".join(f"{c.split()[0]}:long" for c in kind.split(", ")) + ">>"
    names = [c.split()[0] for c in kind.split(", ")]
    lines = [json.dumps([dict(zip(names, r, strict=True)) for r in runs[i : i + 5000]]) for i in range(0, len(runs), 5000)] or ["[]"]
    parts = [spark.range(1).select(F.inline(F.from_json(F.lit(x), one))) for x in lines]
    for p in parts:
        p.coalesce(1).write.mode("append").parquet(path)
    plan = spark.read.schema(kind).parquet(path)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "row", "piece", "start")
    ranked = (
        cut.withColumn("rank", F.row_number().over(within) - 1)
        .join(F.broadcast(starts), ["length", "bucket"])  # `length` * BUCKETS rows at most
        .withColumn("rank", F.col("rank") + F.col("before"))
    )
    hit = (F.col("length") == F.col("r_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    return ranked.join(F.broadcast(plan), hit).withColumn(  # as many rows as runs: bounded by `length`, not by pieces
        "sequence_id", F.col("first") + F.col("rank") - F.col("lo")
    ).select(*[c for c in cut.columns if c != "bucket"], "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """One row per piece with its sequence and place; ``path`` is the tokenizer file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(saved(pieces(docs, path, length, with_ids), "pieces"), length).drop("row")


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
