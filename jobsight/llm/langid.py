"""Language identification: multinomial naive Bayes over hashed character n-grams.

Features are the 1- to 3-grams of the lower-cased text's code points, hashed
into ``BUCKETS`` counters. Learning counts them by language over a bounded
sample: at most ``per_lang`` learnable rows of each language in expectation,
the ones whose id hashes lowest, so the sample does not depend on the layout
and all rows are taken while there are fewer. Map tasks add up their own
counters; one row per task, language and block of ``BLOCK`` counters is
shuffled. The model, log-probabilities of ``BUCKETS`` x languages, has a fixed
size (``max_langs`` languages at most, else an error) and is sent to the
executors once.

Scoring is sparse and by batch: the batch's n-grams become one index vector,
numpy gathers their rows of the matrix and adds them up per document; nothing
is kept per document but one number per language. The score is the posterior
probability of the predicted language.

A null text and a text without any letter get ``und`` and score 1. Null ids
hash as the empty string. Repeated rows are scored one by one; ties go to the
alphabetically first language. Where nothing can be learned every text is
``und``. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.llm.common import mapped, read, slices

BUCKETS = 1 << 15
BLOCK = 1 << 12
ORDERS = (1, 2, 3)
#: Characters scored at once.
CHUNK = 1 << 20


def held_out() -> F.Column:
    """The rows no model may learn from."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of every text, and the number of them by text; n-grams do not cross texts."""
    points = [np.frombuffer(t.lower().encode("utf-32-le", "replace"), np.uint32) for t in texts]
    n = np.array([len(p) for p in points], np.int64)
    x = np.concatenate([*points, np.zeros(0, np.uint32)])
    owner_end = np.repeat(np.cumsum(n), n)
    place = np.arange(len(x))
    out, counts = [], np.zeros(len(texts), np.int64)
    doc = np.repeat(np.arange(len(texts)), n)
    h = np.zeros(len(x), np.uint32)
    with np.errstate(over="ignore"):
        for k in range(1, max(ORDERS) + 1):
            h = h[: max(0, len(x) - k + 1)] * np.uint32(0x9E3779B1) + x[k - 1 :] + np.uint32(k)
            if k not in ORDERS:
                continue
            ok = place[: len(h)] + k <= owner_end[: len(h)]
            b = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            out.append((doc[: len(h)][ok], (b >> np.uint32(32 - 15))[ok]))
            counts += np.bincount(out[-1][0], minlength=len(texts))
    d = np.concatenate([o[0] for o in out])
    g = np.concatenate([o[1] for o in out])
    order = np.argsort(d, kind="stable")
    return g[order].astype(np.int64), counts


def _pieces(texts: list[str]):
    """(index, text) in lists of about ``CHUNK`` characters; a longer text is counted piece by piece."""
    some, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t), 1), CHUNK):
            some.append((i, t[at : at + CHUNK]))
            size += len(some[-1][1])
            if size >= CHUNK:
                yield some
                some, size = [], 0
    if some:
        yield some


def _count(batches, langs: list[str]):
    totals = np.zeros((len(langs), BUCKETS), np.int64)
    at = {x: i for i, x in enumerate(langs)}
    for b in batches:
        which, txt = b.column("lang").to_pylist(), b.column("text").to_pylist()
        for some in _pieces(txt):
            g, n = ngrams([t for _, t in some])
            end = np.cumsum(n)
            for (i, _), e, c in zip(some, end, n, strict=True):
                totals[at[which[i]]] += np.bincount(g[e - c : e], minlength=BUCKETS)
    for x, i in at.items():
        if totals[i].any():
            blocks = range(BUCKETS // BLOCK)
            yield {"lang": [x] * len(blocks), "block": list(blocks), "counts": [totals[i, j * BLOCK : (j + 1) * BLOCK] for j in blocks]}


def _add(batches):
    sums: dict = {}
    for b in batches:
        for x, j, c in zip(b.column("lang").to_pylist(), b.column("block").to_pylist(), b.column("counts"), strict=True):
            sums[x, j] = sums.get((x, j), 0) + c.values.to_numpy()
    if sums:
        yield {"lang": [k[0] for k in sums], "block": [k[1] for k in sums], "counts": list(sums.values())}


def learn(docs: DataFrame, per_lang: int = 3000, max_langs: int = 256, smoothing: float = 0.5):
    """(languages, float32 log-probabilities [BUCKETS, languages]) from ``doc_id, text, lang`` of learnable rows."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
        (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)).alias("draw"),
    )
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).limit(max_langs + 1).collect()}
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((BUCKETS + 1, 0), np.float32)
    share = F.coalesce(*[F.when(F.col("lang") == x, F.lit(min(1.0, per_lang / n))) for x, n in sizes.items()])
    sample = usable.where(F.col("draw") < share).select("text", "lang")
    kind = "lang string, block int, counts array<long>"
    rows = mapped(mapped(sample, lambda it: _count(it, langs), kind).repartition("lang", "block"), _add, kind).collect()
    counts = np.zeros((len(langs), BUCKETS))
    for r in rows:  # languages * BUCKETS / BLOCK rows
        counts[langs.index(r["lang"]), r["block"] * BLOCK : (r["block"] + 1) * BLOCK] += r["counts"]
    p = np.log((counts + smoothing) / (counts.sum(1, keepdims=True) + smoothing * BUCKETS))
    prior = np.log(np.array([sizes[x] for x in langs]) / sum(sizes.values()))
    return langs, np.vstack([p.T, prior]).astype(np.float32)


def _score(batches, model, langs):
    table = model.value
    for whole in batches:
        for b in slices(whole):
            txt = b.column("text").to_pylist()
            ok = [any(map(str.isalpha, t)) for t in txt]
            total = np.zeros((len(txt), len(langs)))
            for some in _pieces([t if o else "" for t, o in zip(txt, ok, strict=True)]):
                g, n = ngrams([t for _, t in some])
                if not len(g):
                    continue
                full = np.flatnonzero(n)
                starts = (np.cumsum(n) - n)[full]
                of = np.array([i for i, _ in some])[full]
                for j in range(len(langs)):
                    np.add.at(total[:, j], of, np.add.reduceat(table[:, j][g], starts, dtype=np.float64))
            total += table[BUCKETS]
            if len(langs):
                best = total.argmax(1)
                score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
            pred = [langs[best[i]] if o and langs else "und" for i, o in enumerate(ok)]
            yield {
                "doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "lang_pred": pred,
                "score": [float(score[i]) if p != "und" else 1.0 for i, p in enumerate(pred)],
            }


def identify(docs: DataFrame, model: np.ndarray, langs: list[str]) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(np.asfortranarray(model))
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return mapped(own, lambda it: _score(it, sent, langs), "doc_id long, held_out boolean, lang_pred string, score double")


def op5_naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    langs, model = learn(docs)
    return identify(docs, model, langs)
