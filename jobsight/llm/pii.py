"""Personal data: fixed patterns, then information-theoretic sanitisation of the terms around them.

1. Pattern spans. Four kinds (``KINDS``), each leftmost and non-overlapping.
   The matched value (addresses lower-cased, numbers as bare digits) is the
   protected entity ``e``.
2. Corpus co-occurrence. The context of a match is the ``window`` terms on
   either side of it, within the document. Over all documents (rows equal in id and text are one): ``n(e)`` and
   ``n(t)`` count the documents that hold an entity or a term, ``n(t, e)``
   those where ``t`` stands in a context of ``e``.
3. Disclosure. ``PMI(t; e) = log(n(t,e) N / (n(t) n(e)))`` measures how much
   information ``t`` gives about ``e``; divided by the entity's own
   information ``-log(n(e) / N)`` it is 1 where ``t`` occurs only with ``e``
   (``t`` identifies ``e``) and at most 0 for independent terms. Support weighs
   the estimate: the share ``n(t,e) / n(t)`` in it is shrunk by
   ``(c + 1) / (c + 2)``, Laplace's estimate of a share seen ``c`` times in
   ``c``, where ``c`` counts the different contexts: copies of one passage are
   one context, so a copied document adds no support. A term whose shrunk value
   is at or above ``threshold`` discloses ``e``. No pair is left out: with 0.9,
   one context is enough where fewer than one document in 57 holds the entity,
   three where fewer than one in 10 does.
4. Every occurrence of a disclosing term in a context of its entity becomes a
   span of kind ``term``; pattern spans always stay. ``sanitise`` writes the
   kind in brackets in place of each span.

A null or empty text has no spans. Null ids and repeated rows are kept, each
row once; rows of one id with different texts are told apart by a hash of the
text. An empty table gives an empty result. Extra columns are ignored by
``find_personal_data`` and passed through by ``sanitise``.

Terms are runs of letters or digits, lower-cased, of at least ``min_term``
UTF-8 bytes: 1 in the query and the pipeline, so that no name or number is too
short; callers who pass nothing get ``MIN_TERM``. What is shuffled: one row per
task and term (counts), one row per context term. Nothing is collected; one row
(the number of documents) is broadcast.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.llm.common import mapped, read, saved, texts, workers_find_package

KINDS = ("email", "ip", "card", "phone")
#: Fewest bytes of a term for callers who do not say; the query and the pipeline say 1.
MIN_TERM = 4
#: Distinct terms a task counts before it passes them on.
FLUSH_TERMS = 200_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only begin where a run of digits does, and takes whole runs; said so, long runs cost linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TERM = re.compile(r"[^\W_]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the address pattern, found from each ``@`` outwards so that long runs cost linear time."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        if at >= end:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            m = _DOMAIN.match(text, at + 1) if start < at else None
            if m:
                end = m.end()
                out.append((start, end))
            else:
                end = max(end, at + 1)  # no later match can begin before this character
        at = text.find("@", at + 1)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, entity) by kind as in ``KINDS``, then start; code points, end exclusive."""
    out = []
    if "@" in text:
        out += [("email", s, e, text[s:e].lower()) for s, e in emails(text)]
    if not _DIGIT.search(text):
        return out
    if "." in text:
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                out.append(("ip", m.start(), m.end(), ".".join(parts)))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end(), digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if 9 <= len(digits) <= 15:
                out.append(("phone", m.start(), m.end(), digits))
    return out


def _contexts(text: str, spans: list, window: int, min_term: int):
    """(entity, context digest, [(term, start, end)]) for each base span; terms inside a base span are left out."""
    terms = [(m.start(), m.end()) for m in _TERM.finditer(text)]
    starts = [s for s, _ in terms]
    taken = sorted((s, e) for _, s, e, _ in spans)
    taken_starts = [s for s, _ in taken]
    reach = list(accumulate((e for _, e in taken), max))  # furthest end of the spans up to each

    def covered(s: int, e: int) -> bool:
        i = bisect_left(taken_starts, e)
        return i > 0 and reach[i - 1] > s

    for kind, s, e, entity in spans:
        i, j = bisect_left(starts, s), bisect_left(starts, e)
        near = []
        for a, b in terms[max(0, i - window) : i] + terms[j : j + window]:
            t = text[a:b].lower()
            if len(t.encode()) >= min_term and not covered(a, b):
                near.append((t, a, b))
        yield f"{kind}:{entity}", hashlib.md5("\0".join(t for t, _, _ in near).encode()).digest()[:8], near


def _scan(batches, window: int, min_term: int):
    for b in batches:
        ids, keys, txt = b.column("doc_id").to_pylist(), b.column("text_key").to_pylist(), b.column("text").to_pylist()
        out = {k: [] for k in ("doc_id", "text_key", *(f"n_{k}" for k in KINDS), "base", "context")}
        for d, key, text in zip(ids, keys, txt, strict=True):
            spans = base_spans(text)
            n = Counter(k for k, *_ in spans)
            out["doc_id"].append(d)
            out["text_key"].append(key)
            for k in KINDS:
                out[f"n_{k}"].append(n[k])
            out["base"].append(",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans))
            out["context"].append(
                [
                    {"entity": e, "seen": seen, "near": [{"term": t, "start": s, "end": f} for t, s, f in near]}
                    for e, seen, near in (_contexts(text, spans, window, min_term) if spans else ())
                ]
            )
        yield out


def _count_terms(batches, min_term: int):
    """(term, copies, rows with it that stand so often) as far as this task has seen; sums over tasks are exact."""
    seen: defaultdict[int, Counter] = defaultdict(Counter)
    size = 0

    def rows():
        for copies, terms in seen.items():
            yield {"term": list(terms), "copies": [copies] * len(terms), "n": list(terms.values())}
        seen.clear()

    for b in batches:
        for text, copies in zip(b.column("text").to_pylist(), b.column("copies").to_pylist(), strict=True):
            size -= len(seen[copies])
            seen[copies].update({low for t in set(_TERM.findall(text)) if len((low := t.lower()).encode()) >= min_term})
            size += len(seen[copies])
            if size >= FLUSH_TERMS:
                yield from rows()
                size = 0
    yield from rows()


def find_personal_data(
    docs: DataFrame, window: int = 8, threshold: float = 0.9, min_term: int = MIN_TERM
) -> DataFrame:
    """One row per document: counts by kind, ``base`` spans and ``added`` (array of start, end), as in the module text."""
    own = texts(docs).withColumn("text_key", F.xxhash64("text"))
    found = saved(
        mapped(
            own, lambda it: _scan(it, window, min_term),
            "doc_id long, text_key long, " + "".join(f"n_{k} long, " for k in KINDS) + "base string, "
            "context array<struct<entity:string,seen:binary,near:array<struct<term:string,start:long,end:long>>>>",
        ),
        "pii-found",
    )
    ctx = found.where(F.size("context") > 0).select("doc_id", "text_key", F.inline("context"))
    near = ctx.select("doc_id", "text_key", "entity", "seen", F.inline("near"))
    pairs = (
        near.groupBy("entity", "term", "seen").agg(F.count_distinct("doc_id", "text_key").alias("docs"))
        .groupBy("entity", "term").agg(F.count("*").alias("contexts"), F.sum("docs").alias("n_te"))
    )
    n_e = ctx.groupBy("entity").agg(F.count_distinct("doc_id", "text_key").alias("n_e"))
    # A row that stands m times counts once: each of its copies gives a term one m-th.
    repeated = saved(
        found.groupBy("doc_id", "text_key").agg(F.count("*").alias("copies")).where("copies > 1")
        .select(F.col("doc_id").alias("r_doc"), F.col("text_key").alias("r_key"), "copies"), "pii-repeated",
    )
    again = F.col("doc_id").eqNullSafe(F.col("r_doc")) & (F.col("text_key") == F.col("r_key"))
    weighed = own.join(repeated, again, "left").select("text", F.coalesce("copies", F.lit(1)).alias("copies"))
    n_t = (
        mapped(weighed, lambda it: _count_terms(it, min_term), "term string, copies long, n long")
        .groupBy("term", "copies").agg(F.expr("sum(n) div copies").alias("n"))
        .groupBy("term").agg(F.sum("n").alias("n_t"))
    )
    surplus = repeated.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus"))
    total = found.agg(F.count("*").alias("n_rows")).crossJoin(surplus).select((F.col("n_rows") - F.col("surplus")).alias("n_docs"))  # one row
    support = (F.col("contexts") + 1) / (F.col("contexts") + 2)
    pmi = F.log(support * F.least(F.col("n_te"), F.col("n_t")) * F.col("n_docs") / (F.col("n_t") * F.col("n_e")))
    disclosing = (
        pairs.join(n_t, "term").join(n_e, "entity").crossJoin(F.broadcast(total))  # one row
        .where((F.col("n_e") < F.col("n_docs")) & (pmi >= threshold * F.log(F.col("n_docs") / F.col("n_e"))))
        .select("entity", "term")
    )
    added = (
        near.join(disclosing, ["entity", "term"]).select("doc_id", "text_key", "start", "end").distinct()
        .groupBy(F.col("doc_id").alias("in_doc"), F.col("text_key").alias("in_key"))
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("added"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("in_doc")) & (F.col("text_key") == F.col("in_key"))
    return found.drop("context").join(added, same, "left").drop("in_doc", "in_key")


def _replace(text, base, added):
    if base is None:  # no spans
        return text
    spans = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in base.split(",") if x)]
    spans += [(a["start"], a["end"], "term") for a in added or ()]
    out, at = [], 0
    for s, e, k in sorted(spans, key=lambda x: (x[0], -x[1])):
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], f"[{k.upper()}]"]
        at = e  # overlapping spans of two kinds are one gap
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets and ``n_chars`` set to the new length."""
    found = find_personal_data(docs, **how).select("doc_id", "text_key", "base", "added").where(
        (F.col("base") != "") | F.col("added").isNotNull()
    ).dropDuplicates(["doc_id", "text_key"]).select(
        F.col("doc_id").alias("_pii_doc"), F.col("text_key").alias("_pii_key"), F.col("base").alias("_pii_base"),
        F.col("added").alias("_pii_added"),
    )
    same = docs["doc_id"].cast("long").eqNullSafe(found["_pii_doc"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == found["_pii_key"]
    )
    workers_find_package(docs.sparkSession)
    fix = F.udf(_replace, "string", useArrow=True)
    joined = docs.join(found.hint("merge"), same, "left")  # moves texts: the same plan at every size
    clean = fix(docs["text"], F.col("_pii_base"), F.col("_pii_added"))
    cols = [clean.alias("text") if c == "text" else docs[c] for c in docs.columns]
    out = joined.select(*cols)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def op9_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(read(spark, sf_dir, "documents"), min_term=1)
    more = F.array_join(
        F.transform("added", lambda a: F.concat_ws(":", F.lit("term"), a["start"].cast("string"), a["end"].cast("string"))), ","
    )
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), more)
    return found.select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.col("base"), 256).alias("base_sha256"), spans.alias("spans")
    )
