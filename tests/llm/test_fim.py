import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from jobsight.llm.fim import Units, WaveletMatrix, fill_in_middle, op11_wavelet_fim, restore
from tests.conftest import SF_SMALL
from tests.llm.helpers import EDGE, by_id, documents

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by listing the units."""
    text = text or ""
    units = UNIT.findall(text)
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    lo, hi = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    a, b, c = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return len(units), "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def test_query_equals_listing_the_units(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op11_wavelet_fim(spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        n, form, p, m, out = brute(r["doc_id"], docs[r["doc_id"]])
        want = (n, form, p, m, sha(out), sha(docs[r["doc_id"]] or ""))
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output_sha256"], r["restored_sha256"]) == want
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def _rows(spark, docs):
    out = fill_in_middle(documents(spark, docs))
    return by_id(out.withColumn("restored", restore(F.col("output"), F.col("form"))))


def test_edge_rows(spark):
    more = [(20, "a <P> b"), (21, "<S>"), (22, "<M"), (23, "x<" * 50), (24, "<P<S<M>" * 9), (25, "\x00\r\n\x00a"), (26, "éé" * 9 + "z"), (27, "\U0001f600" * 300)]
    got = _rows(spark, EDGE + more)
    assert len(got) == len(EDGE) + len(more)
    want = sorted((brute(i, t) + (t or "",) for i, t in EDGE + more), key=repr)
    assert sorted((tuple(r)[1:] for r in got), key=repr) == want


def test_long_texts_and_random_ones(spark):
    r = random.Random(5)
    docs = [(i, "".join(r.choice("ab <>PSM1é漢\U0001f600\n") for _ in range(r.randrange(200)))) for i in range(400)]
    docs += [(900, "x" * 3_000_000), (901, " " * 3_000_000), (902, "é9 zz\n" * 700_000)]
    for row, (i, t) in zip(_rows(spark, docs), docs, strict=True):
        assert tuple(row) == (i, *brute(i, t), t)


def test_empty_table(spark):
    assert _rows(spark, []) == []


def test_wavelet_ranks_and_cuts():
    r = np.random.default_rng(3)
    for size in (0, 1, 63, 64, 65, 1000):
        s = r.integers(0, 4, size).astype(np.uint8)
        at = np.arange(size + 1)
        w = WaveletMatrix(s)
        for symbol in range(4):
            assert w.rank(symbol, at).tolist() == [int((s[:i] == symbol).sum()) for i in at]
    texts = ["ab c", "", "é", "zz", "zz", "1é漢b"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0, *(len(t.encode()) for t in texts)])
    units = Units(data, off)
    assert units.counts().tolist() == [len(UNIT.findall(t)) for t in texts]
    for k in range(5):
        cut = units.cut(np.minimum(k, units.counts()))
        for t, c, start in zip(texts, cut, off, strict=False):
            assert t.encode()[: c - start].decode() == "".join(UNIT.findall(t)[:k])
