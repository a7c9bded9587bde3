import random

from jobsight.llm.decontaminate import drop_leaks, find_leaks, myers, normal, op8_edit_matching, pieces_of
from tests.conftest import SF_SMALL
from tests.llm.helpers import EDGE, documents, prose


def distance(p, t):
    """Smallest edit distance between p and a part of t, by the full table."""
    prev = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        cur = [i]
        for j, d in enumerate(t, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != d)))
        prev = cur
    return min(prev)


def test_myers_equals_the_table():
    r = random.Random(5)
    for _ in range(200):
        p = "".join(r.choice("ab c") for _ in range(r.randint(1, 40)))
        t = "".join(r.choice("ab c") for _ in range(r.randint(0, 60)))
        assert myers(p, t)[0] == distance(p, t)


def test_pieces_cover_the_item():
    assert "".join(x for _, x in pieces_of("abcdefghij", 3)) == "abcdefghij" and len(pieces_of("abcdefghij", 3)) == 4


def _edit(text, n, seed):
    r, x = random.Random(seed), list(text)
    for _ in range(n):
        k, how = r.randrange(len(x)), r.randrange(3)
        if how == 0:
            x[k] = "z"
        elif how == 1:
            x.insert(k, "q")
        else:
            x.pop(k)
    return "".join(x)


def test_equals_brute_force_with_edits(spark):
    items = [(i, prose(100 + i, 18)) for i in range(4)] + [(9, None), (10, ""), (11, "short one"), (12, prose(100, 18))]
    docs = [(i, prose(i, 30) + "\n" + _edit(items[i % 4][1], i, i).upper() + "! " + prose(i + 50, 30)) for i in range(12)]
    docs += [(20, prose(70, 9) + " Short, ONE " + prose(71, 9)), (21, prose(72, 9) + " ashort one " + prose(73, 9)), (22, "short one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, t in docs:
        for i, x in items:
            n = normal(x or "")
            budget = int(0.05 * len(n))
            if n and (distance(n, normal(t)) <= budget if budget else f" {n} " in f" {normal(t)} "):
                want.add((d, i, distance(n, normal(t))))
    assert {(20, 11, 0), (22, 11, 0)} <= want
    df = documents(spark, docs)
    for block in (2_000_000, 100):  # one block, and a block per item
        got = {(r["doc_id"], r["item_id"], r["distance"]) for r in find_leaks(df, bench, block_chars=block).collect()}
        assert got == want and len(want) > 5
    kept = drop_leaks(df, bench)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {w[0] for w in want} and kept.columns == df.columns


def test_short_items_are_searched(spark):
    items = [(1, "Who wrote Emma?"), (2, "art"), (3, "光合作用是什么"), (4, "which planet is the largest of all"), (5, "x"), (6, "?!"), (7, "5G 手机")]
    docs = [
        (1, "Q: who wrote EMMA? A: Austen"), (2, "a party of artists"), (3, "modern art."), (4, "请问光合作用是什么呢"),
        (5, "tell me which planet is the largast of all, please"), (6, "whowrote emma"), (7, "我的5G手机很好"), (8, "我的5G 手机很好"), (9, "xx 2x"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = find_leaks(documents(spark, docs), bench).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in found} == {(1, 1, 0), (3, 2, 0), (4, 3, 0), (5, 4, 1), (8, 7, 0)}
    text, item = dict(docs), dict(items)
    assert all(normal(text[r["doc_id"]])[r["begin"] : r["end"]] == normal(item[r["item_id"]]) for r in found if not r["budget"])
    assert {r["doc_id"] for r in drop_leaks(documents(spark, docs), bench).collect()} == {2, 6, 7, 9}


def test_edge_rows_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, prose(3, 60)), (2, None)], "item_id long, text string")
    docs = documents(spark, EDGE)
    assert sorted(r["doc_id"] for r in find_leaks(docs, bench).collect()) == [7, 8]
    assert drop_leaks(docs, bench).count() == len(EDGE) - 2
    assert find_leaks(documents(spark, []), bench).count() == 0 and find_leaks(docs, bench.limit(0)).count() == 0


def test_query_finds_every_verbatim_passage(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    want = {(d["doc_id"], i["item_id"]) for d in docs for i in items if normal(i["text"]) in normal(d["text"] or "")}
    got = {(r["doc_id"], r["item_id"]) for r in op8_edit_matching(spark, SF_SMALL).collect() if r["distance"] == 0}
    assert got == want
