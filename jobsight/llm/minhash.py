"""Near-duplicate groups by MinHash: one-permutation hashing with optimal densification, banded buckets, star edges.

A document's set is its distinct ``WORDS``-word shingles (of all its words, if
it has fewer), each a 64-bit hash. Documents of equal sets are one class from
the start and its smallest id stands for it. For the classes:

1. Signature. One hash function deals a set's elements into ``BINS`` bins; a
   bin keeps its smallest hash. Empty bins borrow from a bin drawn by a hash
   of (bin, attempt) until that one is not empty (optimal densification).
2. Buckets. ``bands`` runs of ``rows`` bins are the bucket keys. The classes'
   (key, id) pairs are sorted by key, and each bucket is read as a stream.
3. Stars. The first ``CENTRES`` members of a bucket are its centres, and every
   member is paired with them: at most ``CENTRES`` edges per member, whatever
   the bucket's size. Edges are confirmed on the full sets, and linked classes
   united.
4. The rest. A bucket of more members than the centres account for, still in
   different components, may hold links that no centre shows. Its members are
   dealt into chunks of about ``CHUNK``; a task holds two chunks, compares
   signatures with numpy, and where they agree on nearly the threshold the
   full sets, only across components, uniting as it goes; so components are
   united on links alone and none is passed over for a pair that is no link. A pair counts in its
   first common bucket. What leaves the task are at most as many links as it
   has members, confirmed on the full sets like the others. So no bucket is
   capped, and no pair list of a bucket is ever made.

A link is ``100 * |A and B| >= percent * |A or B|``. Links of sets so small that
only equal sets can reach the threshold need no buckets. ``rows`` and ``bands`` are
chosen so that two sets at the threshold miss every bucket with probability
below 1e-4 (two at 0.9: below 1e-7).

Null and wordless texts have the empty set and link with nothing. A null id is
kept on its own (component null, kept). Rows of one id are one node, linked
where any of its texts is, and kept or not together. An empty table gives
no rows. Extra columns are ignored by ``near_duplicates`` and passed through
by ``keep_one``.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.llm.common import mapped, mix64, read, saved, texts
from jobsight.llm.graph import components

WORDS = 5
BINS = 256
CHUNK = 192
CENTRES = 3
#: Low bits of a bucket key that tell its band.
BAND_BITS = 7
ATTEMPTS = 4096
CACHE_WORDS = 300_000
#: How far below the threshold two signatures may agree and still be compared in full: over four standard errors.
MARGIN = 0.1

_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, rows): the most rows a band can have with a miss below 1e-4 at the threshold."""
    j = percent / 100
    for rows in range(16, 0, -1):
        if (1 - j**rows) ** (BINS // rows) < 1e-4:
            return BINS // rows, rows
    raise ValueError("the threshold is too low")


class Shingles:
    """Sorted distinct shingle hashes of whole texts; a worker keeps the hashes of words it has met."""

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, {}
        self.mult = mix64(np.arange(1, words + 1, dtype=np.uint64) * _MULT[0]) | np.uint64(1)

    def of(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "replace").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        h = np.array([known[w] for w in words], np.uint64)
        n = max(1, len(h) - self.words + 1)
        with np.errstate(over="ignore"):
            s = np.full(n, min(len(h), self.words), np.uint64)
            for k in range(min(self.words, len(h))):
                s += h[k : k + n] * self.mult[k]
        return np.unique(mix64(s))


def _draws() -> np.ndarray:
    """Bin that attempt ``a`` of empty bin ``i`` looks into, [ATTEMPTS, BINS]."""
    with np.errstate(over="ignore"):
        x = np.arange(ATTEMPTS, dtype=np.uint64)[:, None] * _MULT[1] + np.arange(1, BINS + 1, dtype=np.uint64) * _MULT[2]
    return (mix64(x) >> np.uint64(56)).astype(np.int64)


def signature(s: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """16-bit values of the ``BINS`` bins of a non-empty sorted set, empty bins filled by optimal densification."""
    edges = np.searchsorted(s, np.arange(BINS, dtype=np.uint64) << np.uint64(56))
    full = np.diff(np.append(edges, len(s))) > 0
    out = np.zeros(BINS, np.uint16)
    out[full] = (s[edges[full]] >> np.uint64(32)).astype(np.uint16)
    empty = np.flatnonzero(~full)
    a = 0
    while len(empty) and a < ATTEMPTS:
        src = draws[a, empty]
        ok = full[src]
        out[empty[ok]] = out[src[ok]]
        empty = empty[~ok]
        a += 1
    if len(empty):  # as good as impossible; the next full bin
        where = np.flatnonzero(full)
        out[empty] = out[where[np.searchsorted(where, empty) % len(where)]]
    return out


def _sign(batches, words: int):
    shingles, draws = Shingles(words), _draws()
    for b in batches:
        out = {k: [] for k in ("n_shingles", "set_key", "signature")}
        for t in b.column("text").to_pylist():
            s = shingles.of(t)
            out["n_shingles"].append(len(s))
            out["set_key"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            out["signature"].append(signature(s, draws).tobytes() if len(s) else None)
        yield {"doc_id": b.column("doc_id"), **out}


def _bands(batches, bands: int, rows: int):
    with np.errstate(over="ignore"):
        mult = mix64(np.arange(1, rows + 1, dtype=np.uint64) * _MULT[3])
        band = np.arange(bands, dtype=np.uint64)
        for b in batches:
            sig = np.frombuffer(b"".join(b.column("signature").to_pylist()), np.uint16).reshape(-1, BINS)
            for at in range(0, len(sig), 2000):
                part = sig[at : at + 2000, : bands * rows].reshape(-1, bands, rows).astype(np.uint64)
                key = mix64((part * mult).sum(2, dtype=np.uint64) + mix64(band + np.uint64(1)))
                key = (key >> np.uint64(BAND_BITS) << np.uint64(BAND_BITS) | band).view(np.int64)
                ids = b.column("rep").slice(at, 2000).to_numpy(zero_copy_only=False)
                yield {"key": key.ravel(), "rep": np.repeat(ids, bands)}


def _buckets(batches):
    """Of a stream sorted by (key, rep): every member of a bucket of two or more, its place and the bucket's centres."""
    key, place, centres, held = None, 0, [], None

    def empty():
        return {"key": [], "rep": [], "place": [], "centres": []}

    for b in batches:
        if not b.num_rows:
            continue
        keys, reps = b.column("key").to_numpy(), b.column("rep").to_numpy()
        alone = np.ones(len(keys), bool)
        alone[1:-1] = (keys[1:-1] != keys[:-2]) & (keys[1:-1] != keys[2:])
        alone[[0, -1]] = False  # the neighbours are in other batches
        out = empty()

        def put(*row):
            for c, v in zip(out.values(), row, strict=True):
                c.append(v)

        for k, r in zip(keys[~alone].tolist(), reps[~alone].tolist(), strict=True):
            if k != key:
                key, place, centres, held = k, 0, [], r
            if place == 1:
                put(k, held, 0, [])
            if place:
                put(k, r, place, list(centres))
            if place < CENTRES:
                centres.append(r)
            place += 1
        yield out


def _sets(batches, words: int):
    shingles = Shingles(words)
    for b in batches:
        yield {"rep": b.column("doc_id"), "items": [shingles.of(t).tobytes() for t in b.column("text").to_pylist()]}


def _confirm(batches, percent: int):
    for b in batches:
        a_, b_ = [], []
        for x, y, p, q in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), b.column("a_items"), b.column("b_items"), strict=True):
            p, q = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
            if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
                continue
            if _linked(p, q, percent):
                a_.append(x)
                b_.append(y)
        yield {"a": a_, "b": b_}


def _first_common(x: np.ndarray, y: np.ndarray, bands: int, rows: int) -> np.ndarray:
    same = (x[:, : bands * rows] == y[:, : bands * rows]).reshape(-1, bands, rows).all(2)
    return same.argmax(1)


def _linked(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * both >= percent * (len(p) + len(q) - both)


def _compare(batches, percent: int, bands: int, rows: int):
    """Links across components within each chunk pair (rows of one ``task`` come together, in order of ``side``)."""
    need = (percent / 100 - MARGIN) * BINS
    draws = _draws()

    def links(rows_: list):
        side, rep, comp = (np.array([r[k] for r in rows_]) for k in (1, 2, 3))
        sets = [np.frombuffer(r[4], np.uint64) for r in rows_]
        sig = np.stack([signature(x, draws) for x in sets])
        left, right = np.flatnonzero(side <= 1), np.flatnonzero(side >= 1)  # side 1: a chunk with itself
        for i in left:
            js = right[(comp[right] != comp[i]) & ((side[right] != 1) | (right > i))]
            agree = (sig[js] == sig[i]).sum(1)
            js = js[agree >= need]
            if not len(js):
                continue
            # A pair meets in every bucket it shares; it counts in the first.
            js = js[_first_common(sig[js], np.broadcast_to(sig[i], (len(js), BINS)), bands, rows) == rows_[0][5]]
            for j in js.tolist():
                if comp[i] != comp[j] and _linked(sets[i], sets[j], percent):
                    yield rep[i], rep[j]
                    comp[comp == max(comp[i], comp[j])] = min(comp[i], comp[j])

    def done(rows_: list):
        found = list(links(rows_))
        if found:
            yield {"a": [f[0] for f in found], "b": [f[1] for f in found]}

    held: list = []
    for batch in batches:
        cols = (batch.column(c).to_pylist() for c in ("task", "side", "rep", "component", "items", "band"))
        for r in zip(*cols, strict=True):
            if held and held[0][0] != r[0]:
                yield from done(held)
                held = []
            held.append(r)
    if held:
        yield from done(held)


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; ``kept`` is ``doc_id = component_id``."""
    bands, rows = bands_for(percent)
    own = texts(docs)
    kind = "doc_id long, n_shingles long, set_key binary, signature binary"
    signed = saved(mapped(own, lambda it: _sign(it, words), kind), "signatures")
    member = signed.where("set_key is not null and doc_id is not null")
    reps = member.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    # A set of n can link with a different one only if n / (n + 1) reaches the threshold.
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 60
    large = member.where(F.col("n_shingles") >= least).groupBy("set_key").agg(F.min(F.struct("doc_id", "signature")).alias("s"))
    sig = saved(large.select(F.col("s.doc_id").alias("rep"), F.col("s.signature").alias("signature")), "classes")
    keyed = mapped(sig, lambda it: _bands(it, bands, rows), "key long, rep long")
    buckets = saved(
        mapped(keyed.repartition("key").sortWithinPartitions("key", "rep"), _buckets, "key long, rep long, place long, centres array<long>"),
        "buckets",
    )
    # Full sets of all that share a bucket. Joins that move texts or sets are the same kind at every size.
    some = buckets.select("rep").distinct()
    shared = own.hint("merge").join(some, F.col("doc_id") == F.col("rep"), "left_semi")
    sets = saved(mapped(shared, lambda it: _sets(it, words), "rep long, items binary"), "sets")
    stars = buckets.select(F.col("rep").alias("a"), F.explode("centres").alias("b"))
    links = _links(sets, stars, percent)
    part = components(links)

    # What no centre has shown: larger buckets with members of different components.
    now = saved(
        buckets.join(part, F.col("rep") == F.col("node"), "left").select("key", "rep", "place", F.coalesce("component", "rep").alias("component")),
        "open-buckets",
    )
    mixed = now.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("place").alias("last"))
    mixed = mixed.where((F.col("low") < F.col("high")) & (F.col("last") > CENTRES))
    rest = now.join(mixed, "key").select(
        "key", "rep", "component", F.floor(F.col("last") / CHUNK).cast("int").alias("top"),
        F.pmod(F.xxhash64("rep", "key"), F.floor(F.col("last") / CHUNK) + 1).cast("int").alias("mine"),
    )
    dealt = rest.withColumn("other", F.explode(F.sequence(F.lit(0), "top"))).select(
        F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("task"),
        F.when(F.col("mine") == F.col("other"), 1).when(F.col("mine") < F.col("other"), 0).otherwise(2).alias("side"),
        F.col("rep").alias("member"), "component", F.col("key").bitwiseAND(F.lit((1 << BAND_BITS) - 1)).cast("int").alias("band"),
    )
    filled = dealt.join(sets.hint("merge"), F.col("member") == F.col("rep")).select("task", "side", "rep", "component", "items", "band")
    more = mapped(
        filled.repartition("task").sortWithinPartitions("task", "side"),
        lambda it: _compare(it, percent, bands, rows), "a long, b long",
    )
    links = saved(links.unionAll(_links(sets, more, percent)), "all-links")
    part = components(links)
    of_rep = reps.join(part, F.col("rep") == F.col("node"), "left").select(
        F.col("set_key").alias("of_set"), F.coalesce("component", "rep").alias("component_id")
    )
    out = signed.join(of_rep, F.col("set_key") == F.col("of_set"), "left")
    component = F.when(F.col("set_key").isNull() | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _links(sets: DataFrame, edges: DataFrame, percent: int) -> DataFrame:
    """The edges (``a``, ``b``) whose full sets reach the threshold, once each."""
    edges = saved(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "candidates")
    left = sets.select(F.col("rep").alias("a"), F.col("items").alias("a_items"))
    right = sets.select(F.col("rep").alias("b"), F.col("items").alias("b_items"))
    joined = edges.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    found = mapped(joined.select("a", "b", "a_items", "b_items"), lambda it: _confirm(it, percent), "a long, b long")
    return saved(found.distinct(), "links")


def keep_one(docs: DataFrame, percent: int = 80, words: int = WORDS) -> DataFrame:
    """One row of each near-duplicate group of ``docs``: that of the group's smallest id."""
    gone = near_duplicates(docs, percent, words).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone.hint("merge"), F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), percent=85)
