import hashlib
import random

import numpy as np

from jobsight.llm.suffixes import CONTEXT, SPAN, BlindTrie, op3_deep_shallow, remove_repeats, repeated_spans, sort_deep_shallow
from tests.conftest import SF_SMALL
from tests.llm.helpers import EDGE, documents, prose


def brute(docs):
    first = {}
    for d, t in docs:
        raw = (t or "").encode()
        for i in range(len(raw) - SPAN + 1) if d is not None else ():
            w = raw[i : i + SPAN]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, t in docs:
        raw = (t or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - SPAN + 1) if d is not None else ():
            if first[raw[i : i + SPAN]] < d:
                gone[i : i + SPAN] = [True] * SPAN
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert got(op3_deep_shallow(spark, SF_SMALL)) == brute(docs)


def test_shared_passages_and_periods_equal_brute_force(spark):
    r = random.Random(6)
    parts = [prose(i, 14) for i in range(6)] + ["Der " * 40, "ab" * 60, "é" * 70, "x" * 50, "y" * 49]
    docs = []
    for i in range(120):
        some = [r.choice(parts)[r.randint(0, 3) : r.choice([None, -1, -9])] if r.random() < 0.7 else prose(1000 + i, r.randint(1, 12)) for _ in range(r.randint(1, 5))]
        docs.append((r.choice([i, i, i, 500 - i]), "\n".join(some)))
    assert got(repeated_spans(documents(spark, docs))) == brute(docs)


def test_edge_rows(spark):
    rows = [*EDGE, (30, "z" * 49), (31, "z" * 49), (32, "w" * 50), (33, "w" * 50), (34, None)]
    assert got(repeated_spans(documents(spark, rows))) == brute(rows)
    out = remove_repeats(documents(spark, rows))
    assert out.columns == documents(spark, []).columns and out.count() == len(rows)
    assert {r["text"] for r in out.collect() if r["doc_id"] == 33} == {""}
    assert repeated_spans(documents(spark, [])).count() == 0


def test_blind_trie_orders_and_groups():
    r = random.Random(1)
    values = [r.getrandbits(40) >> r.randrange(30) for _ in range(300)]
    trie = BlindTrie(40)
    for k, v in enumerate(values):
        trie.insert(v, k)
    leaves = list(trie.leaves())
    assert [v for v, _ in leaves] == sorted(set(values))
    assert all(values[k] == v for v, members in leaves for k in members) and sum(len(m) for _, m in leaves) == 300


def test_sort_finds_the_classes_of_equal_suffixes():
    rng = np.random.default_rng(3)
    spans = rng.integers(97, 99, (40, CONTEXT), dtype=np.uint8)
    spans[:, 5:70] = spans[rng.integers(0, 6, 40)][:, 5:70]
    i, t = (x.ravel() for x in np.mgrid[0:40, 0:20])
    want = {}
    for k in range(len(i)):
        want.setdefault(spans[i[k], t[k] : t[k] + SPAN].tobytes(), set()).add(k)
    classes = [set(c) for c in sort_deep_shallow(spans, i, t)]
    assert sorted(map(sorted, classes)) == sorted(sorted(c) for c in want.values() if len(c) > 1)
