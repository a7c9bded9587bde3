import hashlib
from collections import Counter

import numpy as np

from jobsight.llm.imatch import Fingerprints, edited, fingerprint, fingerprint_edits, lexicon, likeness, op6_imatch, term_hash, terms_of
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.helpers import EDGE, documents


def test_edited_texts_equal_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in op6_imatch(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for i, (d, t) in enumerate(docs):
        new = edited(t, docs[(i + 1) % len(docs)][1])
        assert got[d]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest() and got[d]["n_chars"] == len(t)
        assert got[d]["near_next"] == likeness(got[d]["fingerprint"], got[docs[(i + 1) % len(docs)][0]]["fingerprint"])
        assert got[d]["near_edited"] == likeness(got[d]["fingerprint"], got[d]["edited_fingerprint"])


def test_edits_stay_near_and_others_far(spark):
    rows = [r for r in op6_imatch(spark, SF_MID).collect() if r["n_chars"] > 200]
    assert np.mean([r["near_edited"] for r in rows]) > 0.35 and np.mean([r["near_next"] for r in rows]) < 0.05
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows]) > 0.95


def test_lexicon_is_the_band_over_all_documents(spark):
    rows = [(i, f"all half{i % 2} rare{i}") for i in range(40)]
    docs = documents(spark, rows)
    got = lexicon(docs, min_share=0.3, max_share=0.6)
    assert sorted(got.tolist()) == sorted(term_hash(t) for t in (b"half0", b"half1"))


def test_equal_texts_equal_fingerprints(spark):
    lex = np.sort(np.array([term_hash(t) for t in terms_of("alpha beta gamma delta")], np.int64))
    f = Fingerprints(lex)
    a, b = f.of(terms_of("Alpha, beta! GAMMA")), f.of(terms_of("gamma beta alpha zzz"))
    assert a == b and likeness(a, b) == 1.0 and f.of(set())[0] == "x" and likeness(f.of(set()), a) == 0.0


def test_every_band_term_enters_the_fingerprint():
    words = [b"w%d" % i for i in range(400)]
    f = Fingerprints(np.sort(np.array([term_hash(t) for t in words], np.int64)))
    text, own = set(words[:300]), f.of(set(words[:300]))
    assert f.of(text | {b"outside"}) == own
    for i in range(60):
        for other in (text - {words[i]}, (text - {words[i]}) | {words[300 + i]}, text | {words[300 + i]}):
            assert f.of(other) != own and f.of(other)[:8] != own[:8] and likeness(f.of(other), own) > 0.4


def test_edge_rows(spark):
    docs = documents(spark, EDGE)
    lex = lexicon(docs)
    rows = fingerprint_edits(docs.repartition(5), lex).collect()
    assert len(rows) == len(EDGE)
    plain = {(r["doc_id"], r["fingerprint"]) for r in fingerprint(docs, lex).collect()}
    assert {(r["doc_id"], r["fingerprint"]) for r in rows} == plain
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in (7, 8)}) == 1
    one = fingerprint_edits(documents(spark, [(1, "only one here")]), lex).collect()
    assert len(one) == 1 and one[0]["edited_sha256"] == hashlib.sha256(edited("only one here", "only one here").encode()).hexdigest()
    assert fingerprint_edits(documents(spark, []), lexicon(documents(spark, []))).count() == 0


def plain_fingerprint(text, band):
    """The signatures spelt out with Python integers."""
    def mix(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 % 2**64
        x ^= x >> 27
        x = x * 0x94D049BB133111EB % 2**64
        return x ^ x >> 31

    some = terms_of(text)
    h = sorted(term_hash(t) for t in some if t in band)
    if not h:
        return "x" + hashlib.blake2b(b" ".join(sorted(some)), digest_size=8).hexdigest()

    def digest(own, head=b""):
        return hashlib.blake2b(head + b"".join(x.to_bytes(8, "little", signed=True) for x in own), digest_size=4).hexdigest()

    out = [digest(h)]
    for i in (1, 2, 3):
        seed = mix(i * 0xD1B54A32D192ED03 % 2**64)
        kept = [x for x in h if mix(x % 2**64 ^ seed) < int(2 / 3 * 2**64)]
        out.append(digest(kept or h))
    for i in range(1, 17):
        seed = mix(i * 0x9E3779B97F4A7C15 % 2**64)
        r = {x: mix(x % 2**64 ^ seed) for x in h}
        level = next(j for j in range(63, -1, -1) if min(r.values()) < 2 ** (64 - j))
        own = sorted((x % 2**64 for x in h if r[x] < 2 ** (64 - level)))
        out.append(hashlib.blake2b(bytes([level]) + b"".join(x.to_bytes(8, "little") for x in own), digest_size=4).hexdigest())
    return "".join(out)


def test_fingerprints_equal_plain_ones_over_the_whole_band(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    df = Counter(t for x in docs.values() for t in terms_of(x))
    band = {t for t, n in df.items() if max(2, 0.002 * len(docs)) <= n <= 0.2 * len(docs)}
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert sorted(lexicon(table).tolist()) == sorted(map(term_hash, band))
    for r in op6_imatch(spark, SF_SMALL).collect():
        assert r["fingerprint"] == plain_fingerprint(docs[r["doc_id"]], band)
