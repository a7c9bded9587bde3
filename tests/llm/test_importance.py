import hashlib
import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from jobsight.llm.importance import _key, kth_key, op12_quickselect, resample
from tests.conftest import SF_SMALL
from tests.llm.helpers import EDGE, by_id, documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, runs):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return len(w), [" ".join(w[i : i + k]) for k in range(1, runs + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, percent=10, min_words=20, runs=1, buckets=10_000, seed=2024):
    """(doc_id, n_features, weight, score) of every row, and those drawn in order, from plain sorting."""
    def count(texts):
        c = Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, runs)[1])
        return c, sum(c.values())

    (s, big_s), (t, big_t) = count(x for _, x in docs), count(target)
    gain = [math.floor(1000 * math.log(((t[b] + 1.0) * (big_s + buckets)) / ((s[b] + 1.0) * (big_t + buckets)))) for b in range(buckets)]
    rows, able = [], []
    for i, x in docs:
        n_words, f = features(x, runs)
        weight = sum(gain[zlib.crc32(y.encode()) % buckets] for y in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
        if n_words >= min_words:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    return rows, able[: percent * len(able) // 100]


def check(got, want, drawn):
    assert sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score")) for r in got), key=repr) == sorted(want, key=repr)
    top = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in top] == list(range(1, len(drawn) + 1))
    assert [tuple(r[c] for c in ("doc_id", "n_features", "weight", "score")) for r in top] == drawn


def target(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def test_query_equals_plain_sorting(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    bench = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = op12_quickselect(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    check(got, *brute(docs, bench))


def test_longer_runs_and_other_parameters(spark):
    docs = [(i, prose(i, 5 + i % 40) + " É漢x9 ") for i in range(120)]
    got = resample(documents(spark, docs), target(spark, ["kan lort lort", None]), percent=33, min_words=7, runs=3, buckets=97, seed=1).collect()
    check(got, *brute(docs, ["kan lort lort", None], 33, 7, 3, 97, 1))


def test_edge_rows_and_no_target(spark):
    for texts in (["A b c"], []):
        got = by_id(resample(documents(spark, EDGE), target(spark, texts), percent=60))
        check(got, *brute(EDGE, texts, 60))
    assert resample(documents(spark, []), target(spark, ["x"])).collect() == []


def test_one_row_in_a_third_of_the_table(spark):
    docs = [(i, prose(i, 30)) for i in range(200)] + [(7, prose(99, 30))] * 100
    rows, drawn = brute(docs, ["x"], 50)
    got = resample(documents(spark, docs), target(spark, ["x"]), percent=50).collect()
    check(got, rows, drawn)  # the drawn repeats are as many as sorting takes


def test_kth_key_is_exact_for_every_k(spark):
    r = random.Random(1)
    rows = [(r.randrange(5), r.choice([None, 1, 2, 3]), r.randrange(3), i) for i in range(60)]
    df = spark.createDataFrame(rows, "score long, doc_id long, n_features long, row long").select(_key().alias("key")).checkpoint()
    want = sorted((-s, int(d is None), d or 0, n, i) for s, d, n, i in rows)
    for k in (1, 2, 30, 59, 60):
        assert kth_key(df, k) == want[k - 1]
    assert df.agg(F.min("key")).first()[0] == want[0]
