"""Removal of repeated 50-byte strings across documents by sorting suffixes deep-shallow.

A byte goes if a ``SPAN``-byte string covering it also starts in a document
with a smaller id. All whole texts are compared, as UTF-8 bytes.

*Which suffixes can matter.* Every ``SPAN``-byte window of a text names one of
its ``GRAM``-byte grams, the one with the smallest hash (its anchor, chosen by
content only). Equal windows have equal anchors at equal places, so windows
can be equal only where their anchors' grams are. Anchors are about a
fourteenth of the positions; 32 bits of each anchor's hash are dealt into
buckets of a fixed expected size, and those that meet another document's come back to
their documents. Everything else cannot repeat. (A chance hit of 32 bits in one
bucket only adds candidates.) Whole texts that repeat are settled by their
digests and not compared further.

*Sorting.* A candidate anchor and the bytes its windows span (at most
``CONTEXT``) go to the bucket of its hash: all windows that may be equal meet
there. Equal contexts are one from here on. The windows, the suffixes to sort,
are ordered by multikey quicksort on characters of eight bytes down to
``SHALLOW`` bytes; suffixes that agree so far are then ordered by a blind trie:
a trie over the remaining bits that holds only branching places, is searched
without looking at skipped bits, and corrected by one comparison with the leaf
it ends in. Suffixes that end in one leaf are equal; the smallest id among
them decides about the others.

*Marks* return to the documents as one bit per window, and a scan of the same
shuffled texts (the exchange is reused) cuts the bytes out.

Bounds: a bucket holds what about ``BUCKET_BYTES`` of text send to it, so tasks
stay the same size as the corpus grows; a gram in a third of all documents
brings one record of about 100 bytes per document to its bucket, sorted in
passes of at most ``PASS`` windows. Nothing is broadcast but the number of
buckets.

Null text is empty. Rows with a null id neither remove nor lose anything.
Documents of equal ids never remove from each other. Texts shorter than
``SPAN`` stay as they are. An empty table gives no rows. Extra columns are
ignored by ``repeated_spans`` and passed through by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.llm.common import flat, mapped, mix64, read, slices, workers_find_package

SPAN, GRAM, SHALLOW = 50, 24, 24
WIDTH = SPAN - GRAM + 1  # grams in a window
CONTEXT = SPAN + WIDTH - 1
BUCKET_BYTES = 16 << 20
GROUP_BYTES = 12 << 20
#: Sorting takes a bucket in so many parts (a power of two), by the top bits of the hashes.
SPLIT = 4
PASS = 400_000

_M = mix64(np.arange(1, 4, dtype=np.uint64)) | np.uint64(1)


def anchors(x: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, number of windows, hash) of every anchor of the texts ``x[off[i]:off[i + 1]]``."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    x, off = x[off[0] : off[-1]], off - off[0]
    n = len(x) - SPAN + 1
    if n <= 0:
        return none
    words = np.ndarray((len(x) - 7,), "<u8", np.ascontiguousarray(x).data, strides=(1,))
    with np.errstate(over="ignore"):
        h = words[: len(x) - GRAM + 1] * _M[0]
        h ^= h >> np.uint64(32)
        h += words[8 : len(x) - GRAM + 9]
        h *= _M[1]
        h ^= h >> np.uint64(29)
        h += words[16 : len(x) - GRAM + 17]
        h *= _M[2]
        h ^= h >> np.uint64(32)
    # Leftmost smallest hash of every window, by doubling.
    v, at, have = h, np.arange(len(h), dtype=np.int32), 1
    while have < WIDTH:
        s = min(have, WIDTH - have)
        right = v[s:] < v[:-s]
        at = np.where(right, at[s:], at[:-s])
        v = np.where(right, v[s:], v[:-s])
        have += s
    inside = np.zeros(n, bool)
    edge = np.zeros(n + 1, np.int32)
    lens = np.diff(off)
    long = lens >= SPAN
    edge[off[:-1][long]] += 1
    edge[off[1:][long] - SPAN + 1] -= 1
    inside = np.cumsum(edge[:-1]) > 0
    p = np.flatnonzero(inside)
    if not len(p):
        return none
    a = at[p]
    first = np.append(True, (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1))
    start = np.flatnonzero(first)
    count = np.diff(np.append(start, len(p)))
    p = p[start]
    return np.searchsorted(off, p, side="right") - 1, p, count, h[a[start]]


def _routes(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32), (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _dealt(key: np.ndarray, **columns: np.ndarray):
    """One row per value of ``key`` with the matching part of each column as bytes."""
    if not len(key):
        return {"key": [], **{name: [] for name in columns}}
    order = np.argsort(key, kind="stable")
    key = key[order]
    cut = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    ends = np.append(cut[1:], len(key))
    out = {"key": key[cut].tolist()}
    for name, c in columns.items():
        c = c[order]
        out[name] = [c[a:b].tobytes() for a, b in zip(cut, ends, strict=True)]
    return out


def _send_hashes(batches, buckets: int):
    for whole in batches:
        for b in slices(whole):
            off, x = flat(b.column("text"))
            text, _, _, h = anchors(x, off)
            bucket, low = _routes(h, buckets)
            yield _dealt(
                bucket, docs=b.column("doc_id").to_numpy()[text], rows=b.column("row").to_numpy()[text], hashes=low
            )


def _by_key(batches, names: list[str]):
    """(key, rows) of a stream sorted by ``key``."""
    held, key = [], None
    for b in batches:
        cols = (b.column(c).to_pylist() for c in ("key", *names))
        for k, *r in zip(*cols, strict=True):
            if held and k != key:
                yield key, held
                held = []
            key = k
            held.append(r)
    if held:
        yield key, held


def _join(rows: list, i: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(r[i] for r in rows), kind)


def _groups(row: np.ndarray, groups: int) -> np.ndarray:
    """The group of texts a row belongs to, as in ``_grouped``."""
    return np.mod(row, groups).astype(np.int32)


def _meet(batches, buckets: int, groups: int):
    """Hashes that documents of different ids share, back by group of texts."""
    for key, rows in _by_key(batches, ["docs", "rows", "hashes"]):
        doc, row, low = _join(rows, 0, np.int64), _join(rows, 1, np.int64), _join(rows, 2, np.uint32)
        order = np.argsort(low, kind="stable")
        s, d = low[order], doc[order]
        start = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        mixed = np.minimum.reduceat(d, start) < np.maximum.reduceat(d, start)
        keep = order[np.repeat(mixed, np.diff(np.append(start, len(s))))]
        if len(keep):
            keep = keep[np.argsort(row[keep], kind="stable")]  # equal rows side by side compress well
            out = _dealt(_groups(row[keep], groups), rows=row[keep], hashes=low[keep])
            yield {**out, "bucket": [key] * len(out["key"])}


def _known(left: pa.Table) -> np.ndarray:
    """The group's rows in order; a row's place among them stands for it while marks travel."""
    return np.unique(left.column("row").to_numpy())


def _contexts(buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        copies = set(right.column("copy").drop_null().to_pylist())
        some = [r for r in zip(*(right.column(c).to_pylist() for c in ("rows", "hashes", "bucket")), strict=True) if r[0] is not None]
        out = {k: [] for k in ("key", "grp", "docs", "ranks", "places", "counts", "hashes", "bytes")}
        if some:
            of = np.repeat(np.array([r[2] for r in some], np.uint64), [len(r[1]) // 4 for r in some])
            wanted = np.unique(mix64(_join(some, 0, np.int64).view(np.uint64)) + (_join(some, 1, np.uint32) | of << np.uint64(32)))
            known = _known(left)
            for b in left.combine_chunks().to_batches():
                for part in slices(b):
                    part = pa.RecordBatch.from_arrays([part.column(c) for c in ("doc_id", "row", "text")], ["doc_id", "row", "text"])
                    part = part.filter(pa.array([d is not None and r not in copies for d, r in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]))
                    if not part.num_rows:
                        continue
                    off, x = flat(part.column("text"))
                    text, p, count, h = anchors(x, off)
                    bucket, low = _routes(h, buckets)
                    row = part.column("row").to_numpy()[text]
                    full = low.astype(np.uint64) | (bucket.astype(np.uint64) << np.uint64(32))
                    hit = np.isin(mix64(row.view(np.uint64)) + full, wanted)
                    if not hit.any():
                        continue
                    text, p, count, low, row, bucket = (c[hit] for c in (text, p, count, low, row, bucket))
                    local = x[off[0] : off[-1]]
                    at = p[:, None] + np.arange(CONTEXT)
                    span = np.where(np.arange(CONTEXT) < (count + SPAN - 1)[:, None], local[np.minimum(at, len(local) - 1)], 0).astype(np.uint8)
                    rows_ = _dealt(
                        bucket * SPLIT + (low // np.uint32(2**32 // SPLIT)).astype(np.int32),
                        docs=part.column("doc_id").to_numpy()[text], ranks=np.searchsorted(known, row).astype(np.uint32),
                        places=(p - (off - off[0])[text]).astype(np.uint32), counts=count.astype(np.uint8), hashes=low, bytes=span,
                    )
                    rows_["grp"] = [left.column("grp")[0].as_py()] * len(rows_["key"])
                    for k, v in rows_.items():
                        out[k] += v
        kinds = {"key": pa.int32(), "grp": pa.int32()}
        return pa.table({k: pa.array(v, kinds.get(k, pa.binary())) for k, v in out.items()})

    return run


class BlindTrie:
    """Bit strings of equal length, in order; a node is ``[bit, zero, one]``, a leaf ``(value, members)``."""

    def __init__(self, bits: int):
        self.bits, self.root = bits, None

    def insert(self, value: int, member: int) -> None:
        node = self.root
        if node is None:
            self.root = (value, [member])
            return
        while type(node) is list:  # blind: skipped bits are not looked at
            node = node[2 if value >> (self.bits - 1 - node[0]) & 1 else 1]
        differs = value ^ node[0]
        if not differs:
            node[1].append(member)
            return
        bit = self.bits - differs.bit_length()
        above, side, node = None, 0, self.root
        while type(node) is list and node[0] < bit:
            above, side = node, 2 if value >> (self.bits - 1 - node[0]) & 1 else 1
            node = node[side]
        leaf = (value, [member])
        new = [bit, node, leaf] if value >> (self.bits - 1 - bit) & 1 else [bit, leaf, node]
        if above is None:
            self.root = new
        else:
            above[side] = new

    def leaves(self):
        """(value, members) in ascending order."""
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if type(node) is list:
                stack += (node[2], node[1])
            else:
                yield node


def sort_deep_shallow(spans: np.ndarray, i: np.ndarray, t: np.ndarray):
    """Classes of equal suffixes ``spans[i, t:t + SPAN]`` of two or more, in order; each an index array into ``i``."""
    m, width = spans.shape
    words = np.ndarray((m, width - 7), ">u8", np.ascontiguousarray(spans).data, strides=(width, 1))
    order = np.arange(len(i))
    range_ = np.zeros(len(i), np.int64)  # which tie a suffix is in
    for depth in range(0, SHALLOW, 8):
        if not len(order):
            return
        c = words[i[order], t[order] + depth].astype(np.uint64)
        by = np.lexsort((c, range_))
        order, range_, c = order[by], range_[by], c[by]
        new = np.append(True, (range_[1:] != range_[:-1]) | (c[1:] != c[:-1]))
        size = np.diff(np.append(np.flatnonzero(new), len(new)))
        tied = np.repeat(size > 1, size)
        order, range_ = order[tied], (np.cumsum(new) - 1)[tied]
    if not len(order):
        return
    start = np.flatnonzero(np.append(True, range_[1:] != range_[:-1]))
    raw, bits = spans.tobytes(), 8 * (SPAN - SHALLOW)
    where = (i[order] * width + t[order] + SHALLOW).tolist()
    rest = SPAN - SHALLOW
    members = order.tolist()
    for a, b in zip(start.tolist(), [*start[1:].tolist(), len(order)], strict=True):
        if b - a == 2:  # a trie of two leaves is one comparison
            p, q = where[a], where[a + 1]
            if raw[p : p + rest] == raw[q : q + rest]:
                yield members[a:b]
            continue
        trie = BlindTrie(bits)
        for k in range(a, b):
            trie.insert(int.from_bytes(raw[where[k] : where[k] + rest], "big"), members[k])
        for _, same in trie.leaves():
            if len(same) > 1:
                yield same


def _decide(doc: np.ndarray, count: np.ndarray, low: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """For each candidate a bit per window: an equal window starts in a document with a smaller id."""
    out = np.zeros(len(doc), np.uint32)
    # Equal contexts (hash, number of windows, bytes) become one, with the smallest id.
    whole = np.zeros((len(doc), 8 * (-(-(CONTEXT + 5) // 8))), np.uint8)
    whole[:, :4] = low.astype(">u4")[:, None].view(np.uint8).reshape(-1, 4)
    whole[:, 4] = count
    whole[:, 5 : 5 + CONTEXT] = spans
    cells = whole.view(">u8").astype(np.uint64)
    order = np.lexsort(cells.T[::-1])
    s = cells[order]
    new = np.append(True, (s[1:] != s[:-1]).any(1))
    kind = np.empty(len(doc), np.int64)
    kind[order] = np.cumsum(new) - 1
    lead = order[new]  # one candidate of each kind, by hash
    least = np.full(len(lead), np.iinfo(np.int64).max)
    np.minimum.at(least, kind, doc)
    k_low, k_count = low[lead], count[lead].astype(np.int64)
    smallest = np.repeat(least[:, None], WIDTH, 1)
    start = np.flatnonzero(np.append(True, k_low[1:] != k_low[:-1]))
    size = np.diff(np.append(start, len(k_low)))
    several = np.repeat(size > 1, size)  # a gram with one context has nothing left to sort
    todo = np.flatnonzero(several)
    total = np.cumsum(k_count[todo])
    at = 0
    while at < len(todo):
        # Whole grams, about PASS windows at a time; a larger gram by classes of its windows' first bytes.
        end = int(np.searchsorted(total, (total[at - 1] if at else 0) + PASS, side="right"))
        end = max(end, at + 1)
        while end < len(todo) and k_low[todo[end]] == k_low[todo[end - 1]]:
            end += 1
        some = todo[at:end]
        c = spans[lead[some]]
        n = k_count[some]
        classes = max(1, int(n.sum()) // PASS)
        view = np.ndarray((len(c), CONTEXT - 7), "<u8", np.ascontiguousarray(c).data, strides=(CONTEXT, 1))
        for r in range(classes):
            valid = np.arange(WIDTH) < n[:, None]
            if classes > 1:
                for j in range(WIDTH):  # by column, to stay small
                    valid[:, j] &= mix64(view[:, j]) % np.uint64(classes) == r
            i, t = np.nonzero(valid)
            for same in sort_deep_shallow(c, i, t):
                of, place = some[i[same]], t[same]
                smallest[of, place] = least[of].min()
        at = end
    for j in range(WIDTH):
        out |= ((smallest[kind, j] < doc) & (j < count)).astype(np.uint32) << np.uint32(j)
    return out


def _sort_windows(batches):
    names = ["grp", "docs", "ranks", "places", "counts", "hashes", "bytes"]
    for _, rows in _by_key(batches, names):
        doc = _join(rows, 1, np.int64)
        grp = np.repeat(np.array([r[0] for r in rows], np.int32), [len(r[4]) for r in rows])
        count, low = _join(rows, 4, np.uint8), _join(rows, 5, np.uint32)
        marks = _decide(doc, count, low, _join(rows, 6, np.uint8).reshape(-1, CONTEXT))
        hit = marks > 0
        if hit.any():
            yield _dealt(grp[hit], ranks=_join(rows, 2, np.uint32)[hit], places=_join(rows, 3, np.uint32)[hit], marks=marks[hit])


RESULT = "doc_id long, row long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(with_text: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        copies = set(right.column("copy").drop_null().to_pylist())
        names = ("ranks", "places", "marks")
        some = [r for r in zip(*(right.column(c).to_pylist() for c in names), strict=True) if r[0] is not None]
        row, place, mark = (_join(some, k, np.uint32) for k in range(3))
        order = np.argsort(row, kind="stable")
        row, place, mark = row[order].astype(np.int64), place[order].astype(np.int64), mark[order]
        ranks = np.searchsorted(_known(left), left.column("row").to_numpy()).tolist()
        out = {c.split()[0]: [] for c in RESULT.split(", ")} | ({"kept_text": []} if with_text else {})
        for d, r, rank, text in zip(left.column("doc_id").to_pylist(), left.column("row").to_pylist(), ranks, left.column("text").to_pylist(), strict=True):
            raw = text.encode("utf-8", "replace")
            removed = spans = 0
            kept = raw
            if d is not None and r in copies and len(raw) >= SPAN:
                removed, spans, kept = len(raw), 1, b""
            elif d is not None and (b := np.searchsorted(row, rank, side="right")) > (a := np.searchsorted(row, rank)):
                edge = np.zeros(len(raw) + 1, np.int32)
                for j in range(WIDTH):
                    starts = place[a:b][mark[a:b] >> np.uint32(j) & np.uint32(1) > 0] + j
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + SPAN, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed = int(gone.sum())
                spans = int(np.count_nonzero(gone & ~np.append(False, gone[:-1])))
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            for name, v in zip(out, (d, r, len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")), strict=False):
                out[name].append(v)
        kinds = {"kept_sha256": pa.string(), "kept_text": pa.string()}
        return pa.table({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()})

    return run


def _grouped(docs: DataFrame, groups: int) -> DataFrame:
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = own.withColumn("row", F.xxhash64("doc_id", "text"))
    return own.withColumn("grp", F.pmod("row", F.lit(groups)).cast("int"))


def repeated_spans(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """``RESULT`` (and ``kept_text``) of every row; ``row`` is a hash of id and text."""
    workers_find_package(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, groups = int(size // BUCKET_BYTES) + 1, int(size // GROUP_BYTES) + 1
    own = _grouped(docs, groups)
    known = own.where("doc_id is not null").select("doc_id", "row", "text")

    def sorted_(df: DataFrame, parts: int) -> DataFrame:
        return df.repartition(parts, "key").sortWithinPartitions("key")

    sent = mapped(known, lambda it: _send_hashes(it, buckets), "key int, docs binary, rows binary, hashes binary")
    shared = mapped(sorted_(sent, buckets), lambda it: _meet(it, buckets, groups), "key int, rows binary, hashes binary, bucket int")
    # Whole texts that repeat: all but those of the smallest id are copies.
    digest = known.where(F.octet_length("text") >= SPAN).select("doc_id", "row", F.md5("text").alias("digest"), F.octet_length("text").alias("n"))
    firsts = digest.groupBy("digest", "n").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = digest.join(firsts, ["digest", "n"]).where("doc_id > first").select(
        F.pmod("row", F.lit(groups)).cast("int").alias("grp"), F.col("row").alias("copy")
    ).distinct()

    def side(df: DataFrame, *names: str) -> DataFrame:
        own_ = df.select(F.col("key").alias("grp"), F.lit(None).cast("long").alias("copy"), *names)
        return own_.unionAll(copies.select("grp", "copy", *[F.lit(None).cast(df.schema[n].dataType).alias(n) for n in names]))

    by_group = own.groupBy("grp")
    contexts = by_group.cogroup(side(shared, "rows", "hashes", "bucket").groupBy("grp")).applyInArrow(
        _contexts(buckets), "key int, grp int, docs binary, ranks binary, places binary, counts binary, hashes binary, bytes binary"
    )
    marks = mapped(sorted_(contexts, buckets * SPLIT), _sort_windows, "key int, ranks binary, places binary, marks binary")
    return by_group.cogroup(side(marks, "ranks", "places", "marks").groupBy("grp")).applyInArrow(
        _cut(with_text), RESULT + ", kept_text string" * with_text
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cut; bytes left of a character whose other bytes are gone become U+FFFD. Null text stays null."""
    cut = repeated_spans(docs, with_text=True).where("n_removed > 0").select(F.col("row").alias("_row"), "kept_text").dropDuplicates(["_row"])
    row = F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    joined = docs.join(cut, row == F.col("_row"), "left")
    return joined.select(*[F.coalesce("kept_text", docs[c]).alias(c) if c == "text" else docs[c] for c in docs.columns])


def op3_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(read(spark, sf_dir, "documents")).drop("row")
