import random

import numpy as np

from jobsight.llm.graph import components
from jobsight.llm.minhash import BINS, Shingles, _draws, bands_for, keep_one, near_duplicates, op1_minhash, signature
from tests.conftest import SF_SMALL
from tests.llm.helpers import EDGE, documents, prose


def shingles(t, k=5):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(docs, percent):
    sets = {d: shingles(t) for d, t in docs}
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d)) for d in ids}


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = op1_minhash(spark, SF_SMALL).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(docs, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_a_family_of_near_copies_equals_brute_force(spark):
    """Copies at every distance around the threshold, some linked only with each other: buckets with many components."""
    r, docs = random.Random(4), []
    base = prose(5, 160).split()
    for i in range(260):
        w = list(base)
        for k in r.sample(range(len(w)), r.randint(0, 9)):
            w[k] = f"new{i}x{k}" if r.random() < 0.5 else "common"
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, prose(i, 40)) for i in range(50)]
    for percent in (85, 80):
        got = near_duplicates(documents(spark, docs), percent).collect()
        want = brute(docs, percent)
        assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got} == want
        assert 60 < len({c for _, c in want.values()}) < 300


def test_signatures_agree_as_often_as_sets():
    s, draws = Shingles(), _draws()
    words = prose(9, 400).split()
    a, b = s.of(" ".join(words)), s.of(" ".join(words[:-40] + prose(10, 40).split()))
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signature(a, draws) == signature(b, draws)).mean() - j) < 0.12
    few = signature(s.of("one two three four five six seven eight"), draws)  # four shingles fill all bins
    assert len(few) == BINS and len(set(few.tolist())) == 4


def test_bands_reach_their_recall():
    for percent in (80, 85, 90):
        bands, rows = bands_for(percent)
        assert (1 - (percent / 100) ** rows) ** bands < 1e-4 and bands * rows <= BINS


def test_edge_rows(spark):
    rows = [*EDGE, (20, "A b\tc"), (21, "a B c"), (22, "a b c d")]
    docs = documents(spark, rows)
    got = near_duplicates(docs, 85).collect()
    assert len(got) == len(rows)
    one = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert [one[d]["n_shingles"] for d in (1, 2, 3, 4, 10)] == [0, 0, 0, 1, 0]
    assert one[21]["component_id"] == 20 and one[8]["component_id"] == 7 and one[22]["kept"] and one[2]["kept"]
    kept = keep_one(docs, 85)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 2  # 8 and 21 go; both rows of id 5 stay
    assert near_duplicates(documents(spark, [])).count() == 0


def test_components_equal_union_find(spark):
    r = random.Random(8)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, 5000 + i) for i in range(60)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    up = {}
    for a, b in links:
        if a != b:
            x, y = [up.setdefault(v, v) for v in (a, b)]
            for v in list(up):
                if up[v] == max(x, y):
                    up[v] = min(x, y)
    assert got == up
