"""Quality classifier: a sparse rule ensemble over text statistics.

1. Statistics (``STATS``) of every whole text.
2. Rules. Small regression trees grown one after another on what the trees
   before left unexplained, each on its own random rows and statistics; every
   path from a root to a node is a rule, a conjunction of thresholds.
3. Weights. Logistic regression with an L1 penalty over the rules (proximal
   gradient steps with momentum); most weights come out as zero and their
   rules are dropped.
4. The model is compiled: the score of a row is one Spark column expression,
   the logistic function of the intercept plus ``CASE WHEN rule THEN weight``.

Fitting happens on the driver over a bounded sample: at most ``max_rows``
labelled rows in expectation (the ids that hash lowest; all rows while there
are fewer), ``len(STATS)`` numbers each; the sample's ids, that many at most,
are broadcast to find their texts. Scoring is one scan without a shuffle.

Only rows outside ``held_out()`` with a 0/1 label teach; an id labelled more
than once counts by the mean of its labels, and of an id's rows one teaches, that
with the smallest statistics, picked before anything reaches the driver. Without labels, or with labels of
one class only, the score is ``(ones + 1) / (labels + 1)``: nothing known to
be bad keeps everything. A null text scores as the empty text. Null ids and
repeated rows are scored row by row. An empty table gives no rows. Extra
columns are ignored by ``score_quality`` and passed through by ``keep_good``.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.llm.common import mapped, read, saved, texts, workers_find_package
from jobsight.llm.langid import held_out

STATS = (
    "words", "mean_word", "max_word", "upper", "digit", "symbol", "letter", "other_mark", "distinct_words", "top_word",
    "repeat_next", "distinct_pairs", "lines", "mean_line", "distinct_lines", "ended_lines", "marked_words",
    "capital_words", "short_words", "sentence",
)
_ENDS = (".", "!", "?", '"', "”", ":", ";")
_CLASS = np.zeros(256, np.int64)  # 0 white and control, 1 lower, 2 upper, 3 digit, 4 common mark, 5 other mark, 6 beyond ASCII
for _b in range(33, 127):
    _c = chr(_b)
    _CLASS[_b] = 1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c in ".,;:!?'\"()-" else 5
_CLASS[128:] = 6
_MARKED = re.compile(r"[^\w\s.,;:!?'\"()-]")


def statistics(text: str) -> tuple[float, ...]:
    """The values of ``STATS``; shares are of words, lines or bytes, and 0 for an empty text."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(len(raw), 1)
    kinds = np.bincount(_CLASS[raw], minlength=7)
    words = text.split()
    w = max(len(words), 1)
    lengths = list(map(len, words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    k = max(len(lines), 1)
    pairs = w - 1
    return (
        float(len(words)), sum(lengths) / w, float(max(lengths, default=0)), kinds[2] / n, kinds[3] / n, kinds[5] / n,
        (kinds[1] + kinds[2] + kinds[6]) / n, kinds[4] / n, len(counts) / w, max(counts.values(), default=0) / w,
        sum(map(str.__eq__, words, words[1:])) / w, len(set(zip(words, words[1:], strict=False))) / max(pairs, 1), float(len(lines)),
        len(text) / k, len(set(lines)) / k, sum(x.rstrip().endswith(_ENDS) for x in lines) / k,
        len(_MARKED.findall(text)) / w, sum(map(str.isupper, words)) / w, sum(x <= 3 for x in lengths) / w,
        w / (text.count(".") + text.count("!") + text.count("?") + 1),
    )


def _statistics(batches):
    for b in batches:
        rows = [statistics(t) for t in b.column("text").to_pylist()]
        out = {s: [float(r[i]) for r in rows] for i, s in enumerate(STATS)}
        yield {"doc_id": b.column("doc_id"), **out}


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``STATS``, one row per row."""
    return mapped(texts(docs), _statistics, "doc_id long, " + ", ".join(f"{s} double" for s in STATS))


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, at most?, threshold), in order


def _grow(x: np.ndarray, cuts: list[np.ndarray], target: np.ndarray, rows: np.ndarray, stats: np.ndarray, depth: int, rule: Rule, out: list):
    """Nodes of a regression tree below ``rule``: appends (rule, rows, mean)."""
    if rule:
        out.append((rule, rows, target[rows].mean()))
    if depth == 0 or len(rows) < 20:
        return
    total, n, best = target[rows].sum(), len(rows), (1e-9, None)
    for s in stats:
        at = np.searchsorted(cuts[s], x[rows, s], side="left")  # x <= cuts[i] for at <= i
        size = np.bincount(at, minlength=len(cuts[s]) + 1).cumsum()[:-1]
        part = np.bincount(at, weights=target[rows], minlength=len(cuts[s]) + 1).cumsum()[:-1]
        ok = (size >= 8) & (n - size >= 8)
        if ok.any():
            gain = np.where(ok, part**2 / np.maximum(size, 1) + (total - part) ** 2 / np.maximum(n - size, 1) - total**2 / n, 0)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], (s, cuts[s][i]))
    if best[1] is None:
        return
    s, cut = best[1]
    low = x[rows, s] <= cut
    _grow(x, cuts, target, rows[low], stats, depth - 1, (*rule, (int(s), True, float(cut))), out)
    _grow(x, cuts, target, rows[~low], stats, depth - 1, (*rule, (int(s), False, float(cut))), out)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for s, at_most, cut in rule:
        out &= (x[:, s] <= cut) == at_most
    return out


def extract_rules(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, seed: int = 7) -> list[Rule]:
    """Distinct paths of ``trees`` boosted trees."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, s], np.linspace(0.01, 0.99, 64))) for s in range(x.shape[1])]
    f = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        rows = rng.choice(len(y), min(len(y), max(200, len(y) // 4)), replace=False)
        stats = rng.choice(x.shape[1], max(2, x.shape[1] // 3), replace=False)
        nodes: list = []
        _grow(x, cuts, y - 1 / (1 + np.exp(-f)), rows, stats, depth, (), nodes)
        for rule, _, mean in nodes:
            rules[rule] = None
            if len(rule) == depth:
                f += 0.5 * mean * 4 * holds(rule, x)
    return list(rules)


def fit_lasso(z: np.ndarray, y: np.ndarray, penalty: float = 0.002, steps: int = 300) -> tuple[float, np.ndarray]:
    """(intercept, weights) of L1-penalised logistic regression on 0/1 columns; equal rows are fitted as one."""
    n = len(y)
    _, first, group, size = np.unique(np.packbits(z, axis=1), axis=0, return_index=True, return_inverse=True, return_counts=True)
    ones = np.bincount(group.ravel(), weights=y, minlength=len(size))
    a = np.hstack([z[first].astype(np.float64), np.ones((len(first), 1))])
    size = size.astype(np.float64)
    v = np.ones(a.shape[1])
    for _ in range(30):  # largest curvature, by power iteration
        v = a.T @ (size * (a @ v))
        v /= np.linalg.norm(v)
    rate = 4 * n / max(np.linalg.norm(a.T @ (size * (a @ v))), 1e-9)
    w = u = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(steps):
        grad = a.T @ (size / (1 + np.exp(-(a @ u))) - ones) / n
        new = u - rate * grad
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        u = new + (before - 1) / t * (new - w)
        w = new
    return float(w[-1]), w[:-1]


def fit(x: np.ndarray, y: np.ndarray, **how) -> tuple[float, list[tuple[Rule, float]]]:
    """(intercept, [(rule, weight)]) with zero weights left out."""
    if len(y) == 0 or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 1)
        return float(np.log(max(p, 1e-17) / max(1 - p, 1e-17))), []
    rules = extract_rules(x, y)
    z = np.stack([holds(r, x) for r in rules], 1)
    intercept, w = fit_lasso(z, y, **how)
    return intercept, [(r, float(c)) for r, c in zip(rules, w, strict=True) if abs(c) > 1e-6]


def compiled(model: tuple[float, list[tuple[Rule, float]]], value=lambda i: F.col(STATS[i])) -> F.Column:
    """The score as a column expression; ``value(i)`` is the column of statistic ``i``."""
    intercept, rules = model
    terms = [F.lit(intercept)]
    for rule, weight in rules:
        cond = F.lit(True)
        for s, at_most, cut in rule:
            cond = cond & (value(s) <= cut if at_most else value(s) > cut)
        terms.append(F.when(cond, F.lit(weight)).otherwise(F.lit(0.0)))
    while len(terms) > 1:  # a sum as deep as its terms are many is more than the code generator's stack holds
        terms = [a + b for a, b in zip(terms[::2], terms[1::2], strict=False)] + terms[len(terms) & ~1 :]
    (total,) = terms
    return 1 / (1 + F.exp(-total))


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000):
    """The model from ``labels`` (``doc_id, quality``) and the statistics of their documents."""
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    n = marked.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    sample = saved(marked.where(draw < min(1.0, max_rows / max(n, 1))), "quality-sample")
    ids = F.broadcast(sample.select(F.col("doc_id").alias("_id")))  # max_rows in expectation
    stats = text_statistics(docs.join(ids, F.col("doc_id").cast("long") == F.col("_id"), "left_semi"))
    each = stats.groupBy("doc_id").agg(F.min(F.struct(*STATS)).alias("s"))  # an id's rows teach as one
    rows = each.join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "s.*").collect()
    rows.sort()
    x = np.array([r[2:] for r in rows], float).reshape(len(rows), len(STATS))
    return fit(x, np.array([r[1] for r in rows], float))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_rows: int = 20_000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    model = learn(docs, labels, max_rows)
    scored = text_statistics(docs).select("doc_id", held_out().alias("held_out"), compiled(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_rows: int = 20_000) -> DataFrame:
    """The rows of ``docs`` predicted good, by the same statistics and expression as ``score_quality``; no shuffle."""
    model = learn(docs, labels, max_rows)
    workers_find_package(docs.sparkSession)
    measured = docs.withColumn("_stats", F.udf(statistics, "array<double>", useArrow=True)(F.coalesce("text", F.lit(""))))
    return measured.where(compiled(model, lambda i: F.col("_stats")[i]) >= threshold).drop("_stats")


def op7_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
