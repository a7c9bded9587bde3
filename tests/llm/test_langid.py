import math
import random
import zlib
from collections import Counter

from jobsight.llm.langid import identify, learn, op5_naive_bayes
from tests.conftest import SF_MID
from tests.llm.helpers import EDGE, documents


def test_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang").collect()}
    got = op5_naive_bayes(spark, SF_MID).collect()
    assert len(got) == len(lang) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 150 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97


def test_edge_rows(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    langs, model = learn(docs, per_lang=50)
    got = identify(documents(spark, EDGE), model, langs).collect()
    assert len(got) == len(EDGE)
    und = sorted(r["doc_id"] or 0 for r in got if r["lang_pred"] == "und")
    assert und == [0, 1, 2, 3, 6, 10] and {r["lang_pred"] for r in got} <= {*langs, "und"}


def test_nothing_to_learn_and_empty_table(spark):
    docs = documents(spark, [(1, "some words"), (2, "ab")], lang=None)
    langs, model = learn(docs)
    assert langs == [] and {r["lang_pred"] for r in identify(docs, model, langs).collect()} == {"und"}
    assert identify(documents(spark, []), *reversed(learn(documents(spark, [])))).count() == 0


def plain_buckets(text):
    """Buckets of all 1- to 3-grams with Python integers."""
    x, out = [ord(c) for c in text.lower()], []
    for i in range(len(x)):
        h = 0
        for k in range(1, 4):
            if i + k > len(x):
                break
            h = (h * 0x9E3779B1 + x[i + k - 1] + k) % 2**32
            out.append((h ^ h >> 15) * 0x85EBCA6B % 2**32 >> 17)
    return out


def test_posteriors_equal_plain_counting(spark):
    r = random.Random(3)
    alphabets = {"xx": "abcde  ", "yy": "cdefgé  ", "zz": "efghij漢 "}
    rows = [(i, "".join(r.choices(alphabets[lang], k=r.randrange(5, 60))), lang) for i in range(90) for lang in [r.choice(list(alphabets))]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learnable = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    counts = {x: Counter(b for t, lang in learnable if lang == x for b in plain_buckets(t)) for x in alphabets}
    prior = Counter(lang for _, lang in learnable)
    got = {row["doc_id"]: row for row in identify(docs, *reversed(learn(docs))).collect()}
    for i, t, _ in rows:
        if not any(map(str.isalpha, t)):
            assert got[i]["lang_pred"] == "und"
            continue
        total = {
            x: math.log(prior[x] / len(learnable)) + sum(math.log((c[b] + 0.5) / (sum(c.values()) + 0.5 * 32768)) for b in plain_buckets(t))
            for x, c in counts.items()
        }
        best = max(sorted(total), key=total.get)
        score = 1 / sum(math.exp(v - total[best]) for v in total.values())
        assert got[i]["lang_pred"] == best and abs(got[i]["score"] - score) < 1e-3
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
