"""I-Match fingerprints: distinct terms of an idf band, hashed under randomised sub-lexicons.

1. Document frequency of every term over all documents (tasks add up their own
   counts first). The lexicon is the band ``min_share <= df / N <= max_share``,
   that is idf between ``log(1 / max_share)`` and ``log(1 / min_share)``. As
   the frequencies of all terms add up to ``N`` times the mean number ``D`` of
   distinct terms a document, at most ``D / min_share`` terms are in the band,
   however many documents there are: that bound makes it fit to broadcast, and
   ``max_lexicon`` checks it; beyond it the band's lower end is raised until
   it fits.
2. I-Match: ``WHOLE`` fixed lexicons, the whole band and random two thirds of
   it, are the same for every document. All of a document's distinct terms in
   such a lexicon are sorted and hashed (all its band terms if none is in it),
   so every band term enters and any change of them changes the fingerprint.
3. Beside them, so that likeness also grades larger edits, each of ``lexicons``
   random lexicons is a chain of sub-lexicons, each a random half of the one
   before. A document uses the smallest of a chain that still holds at least
   ``terms`` of its terms, sorts those distinct terms and hashes them: so a
   document of any length is judged by about as many terms (1.44 a signature
   with ``TERMS`` 1, near to MinHash), and an edit changes only the signatures
   whose few terms it touches.
4. The fingerprint is the list of signatures; likeness is the share of equal
   ones. A document with fewer than ``terms`` terms in the band is fingerprinted
   by all its distinct terms (``x`` and one digest, likeness 1 or 0).

Equal texts have equal fingerprints; null is the empty text. Terms are runs of
letters or digits, lower-cased. ``edited`` pairs of ``fingerprint_edits`` need
each document's successor by id: rows are range-sorted by id (ties by text,
null ids first) and scanned in order; only the first and last row of each
partition are joined across partitions, in a table of two rows a partition.
Repeated rows follow each other like any others. An empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsight.llm.common import mapped, mix64, read, saved, texts

LEXICONS, TERMS = 16, 1
#: Lexicons hashed whole: the band, then random subsets with this share of its terms.
WHOLE, KEPT = 4, 2 / 3
FLUSH_TERMS = 200_000
#: ASCII other than letters and digits becomes a blank; letters become lower case; other bytes stay.
_TO_TERMS = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str) -> set[bytes]:
    return set(text.lower().encode("utf-8", "replace").translate(_TO_TERMS).split())


def term_hash(t: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True)


def _count(batches):
    seen: Counter = Counter()
    for b in batches:
        for text in b.column("text").to_pylist():
            seen.update(terms_of(text))
            if len(seen) >= FLUSH_TERMS:
                yield {"term": [term_hash(t) for t in seen], "n": list(seen.values())}
                seen = Counter()
    if seen:
        yield {"term": [term_hash(t) for t in seen], "n": list(seen.values())}


def lexicon(docs: DataFrame, min_share: float = 0.002, max_share: float = 0.2) -> np.ndarray:
    """Sorted hashes of the terms in the band.

    A band term stands in at least ``min_share`` of all documents, so there are at
    most (mean distinct terms of a document) / ``min_share`` of them, 8 bytes
    each: a bound that does not grow with the number of documents.
    """
    own = texts(docs)
    n = own.count()
    counted = mapped(own.select("text"), _count, "term long, n long").groupBy("term").agg(F.sum("n").alias("df"))
    band = saved(counted.where((F.col("df") >= max(2, math.ceil(min_share * n))) & (F.col("df") <= max_share * n)), "lexicon")
    return np.sort(np.array([r[0] for r in band.select("term").collect()], np.int64))


class Hashes(dict):
    """Hashes of terms, kept for those met."""

    def __missing__(self, term: bytes) -> int:
        self[term] = h = term_hash(term)
        return h


class Fingerprints:
    """Fingerprints of texts under one lexicon; term hashes of a worker are kept up to ``FLUSH_TERMS``."""

    def __init__(self, lexicon_: np.ndarray, lexicons: int = LEXICONS, terms: int = TERMS):
        self.known = lexicon_
        self.hashes = Hashes()
        self.seeds = mix64(np.arange(1, lexicons + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.whole_seeds = mix64(np.arange(1, WHOLE, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        self.terms = terms

    def band(self, some: set[bytes]) -> np.ndarray:
        if len(self.hashes) > FLUSH_TERMS:
            self.hashes.clear()
        h = np.sort(np.fromiter(map(self.hashes.__getitem__, some), np.int64, len(some)))
        if not len(self.known):
            return h[:0].view(np.uint64)
        at = np.searchsorted(self.known, h)
        return h[self.known[np.minimum(at, len(self.known) - 1)] == h].view(np.uint64)

    def of(self, some: set[bytes]) -> str:
        h = self.band(some)
        if len(h) < self.terms:
            return "x" + hashlib.blake2b(b" ".join(sorted(some)), digest_size=8).hexdigest()
        kept = mix64(h[None, :] ^ self.whole_seeds[:, None]) < np.uint64(int(KEPT * 2**64))
        out = [hashlib.blake2b(own.tobytes(), digest_size=4).hexdigest() for own in (h, *(h[k] if k.any() else h for k in kept))]
        r = mix64(h[None, :] ^ self.seeds[:, None])  # a term is in sub-lexicon j of chain i if r[i] < 2 ** (64 - j)
        order = np.partition(r, self.terms - 1, axis=1)[:, self.terms - 1]
        # Smallest sub-lexicon with `terms` terms: the power of two above the terms-th smallest value.
        with np.errstate(divide="ignore"):
            level = np.where(order == 0, 63, 63 - np.floor(np.log2(order.astype(np.float64))).astype(np.int64)).clip(0, 63)
        bound = (np.uint64(0xFFFFFFFFFFFFFFFF) >> level.astype(np.uint64))
        member = r <= bound[:, None]
        for i in range(len(r)):
            own = np.sort(h[member[i]])
            out.append(hashlib.blake2b(bytes([int(level[i])]) + own.tobytes(), digest_size=4).hexdigest())
        return "".join(out)


def likeness(a: str, b: str) -> float:
    """Share of equal signatures; 1 for equal fingerprints, 0 between a signature list and a digest of all terms."""
    if a == b:
        return 1.0
    if a[:1] == "x" or b[:1] == "x" or len(a) != len(b):
        return 0.0
    n = len(a) // 8
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, len(a), 8)) / n


def fingerprint(docs: DataFrame, lexicon_: np.ndarray, lexicons: int = LEXICONS, terms: int = TERMS) -> DataFrame:
    """``doc_id, fingerprint`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon_)

    def run(batches):
        f = Fingerprints(sent.value, lexicons, terms)
        for b in batches:
            yield {"doc_id": b.column("doc_id"), "fingerprint": [f.of(terms_of(t)) for t in b.column("text").to_pylist()]}

    return mapped(texts(docs), run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the beginning of ``following``."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


ROWS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
EDGES = ", part int, kind string, text string"


def _row(f: Fingerprints, doc_id, text: str, own: str, following: str, next_own: str) -> tuple:
    new = edited(text, following)
    e = f.of(terms_of(new))
    return doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), own, e, likeness(own, e), likeness(own, next_own)


def _in_order(batches, sent, lexicons: int, terms: int):
    """Complete rows, but for the partition's last; and the partition's first and last text, as kinds first and last."""
    from pyspark import TaskContext

    names = [c.split()[0] for c in (ROWS + EDGES).split(", ")]
    part = TaskContext.get().partitionId()
    f = Fingerprints(sent.value, lexicons, terms)
    held = None

    def edge(kind: str, doc_id, text: str, own: str) -> tuple:
        return doc_id, len(text), None, own, None, None, None, part, kind, text

    for b in batches:
        rows = []
        for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            own = f.of(terms_of(t))
            if held is None:
                rows.append(edge("first", d, t, own))
            else:
                rows.append((*_row(f, *held, t, own), part, "row", None))
            held = d, t, own
        yield dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)) if rows else {n: [] for n in names}
    if held is not None:
        yield dict(zip(names, ([v] for v in edge("last", *held)), strict=True))


def _at_edges(batches, sent, lexicons: int, terms: int):
    f = Fingerprints(sent.value, lexicons, terms)
    names = [c.split()[0] for c in ROWS.split(", ")]
    for b in batches:
        rows = [_row(f, *r) for r in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "fingerprint", "next_text", "next_own")), strict=True)]
        yield dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)) if rows else {n: [] for n in names}


def fingerprint_edits(docs: DataFrame, lexicon_: np.ndarray, lexicons: int = LEXICONS, terms: int = TERMS) -> DataFrame:
    """Every row's own and edited fingerprint and their likeness: ``ROWS``, as in the module text."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon_)
    ordered = texts(docs).repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    out = saved(mapped(ordered, lambda it: _in_order(it, sent, lexicons, terms), ROWS + EDGES), "imatch-rows")
    names = [c.split()[0] for c in ROWS.split(", ")]
    firsts = out.where("kind = 'first'").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_own"))
    parts = firsts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next_part"))
    last = (
        out.where("kind = 'last'").select("part", "doc_id", "text", "fingerprint").join(parts, "part")
        .join(firsts.withColumnRenamed("part", "next_part"), "next_part")
    )
    return out.where("kind = 'row'").select(*names).unionAll(mapped(last, lambda it: _at_edges(it, sent, lexicons, terms), ROWS))


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return fingerprint_edits(docs, lexicon(docs))
