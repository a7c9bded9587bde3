import base64
import hashlib
import random

import pytest
import public_tokenizers as files
import tiktoken

from jobsight.llm.bpe import LONG, Bpe, decode, encode, op13_duckdb_bpe
from tests.conftest import SF_SMALL
from tests.llm.helpers import EDGE, documents

PATH = files.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def bpe():
    return Bpe(PATH, files.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(raw):
    return [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]


def test_query_equals_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op13_duckdb_bpe(spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        want = library.encode_ordinary(docs[r["doc_id"]])
        raw = b"".join(i.to_bytes(4, "little") for i in want)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(want), hashlib.sha256(raw).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_edge_rows_and_decoding_alone(spark, library):
    rows = encode(documents(spark, EDGE))
    got = sorted((r["doc_id"] or 0, ids(r["ids"])) for r in rows.collect())
    assert got == sorted((i or 0, library.encode_ordinary(t or "")) for i, t in EDGE)
    back = sorted((r["doc_id"] or 0, r["decoded"].decode()) for r in decode(rows).collect())
    assert back == sorted((i or 0, t or "") for i, t in EDGE)
    assert op13_duckdb_bpe.__name__ and encode(documents(spark, [])).collect() == []


def test_random_words_and_bytes(bpe, library):
    r = random.Random(4)
    texts = ["".join(r.choices("abcdeé漢 \n'st1", k=r.randrange(60))) for _ in range(3000)]
    texts += ["".join(chr(r.choice((r.randrange(32, 127), r.randrange(0xA0, 0x3000), r.randrange(0x1F300, 0x1F700)))) for _ in range(40)) for _ in range(500)]
    assert [ids(x) for x in bpe.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_every_code_point_is_split_alike(bpe, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    lines = ["".join(f"a{c}b 1{c} {c}{c}" for c in points[i : i + 40]) for i in range(0, 0x3100, 40)]
    assert [ids(x) for x in bpe.encode(lines)] == [library.encode_ordinary(t) for t in lines]


def test_long_words_without_a_break(bpe, library):
    r = random.Random(7)
    long = [
        "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=6000)), "ab" * 20_000, "haha" * 9000 + "x", "é" * 9000, "=" * 70_001,
        " " * 300_000 + "x", "\n \n" * 30_000, "x" + " " * 100_000, "".join(r.choices("漢字仮名交文", k=4000)), "A" * LONG, "Zq" * (LONG // 2) + "Z",
    ]
    assert [ids(x) for x in bpe.encode(long)] == [library.encode_ordinary(t) for t in long]
    assert [x.decode() for x in bpe.decode(bpe.encode(long))] == long


def test_an_unbroken_run_the_library_cannot_split(bpe):
    for text in (" " * 1_500_000 + "x", "\n" * 1_500_000 + "x", "x" * 1_500_000):
        (raw,) = bpe.encode([text])
        assert bpe.decode([raw]) == [text.encode()]


def test_cuts_are_never_crossed_by_a_token(bpe):
    r = random.Random(9)
    for _ in range(30):
        word = "".join(r.choices("abcxyzqé", k=200)).encode()
        parts = bpe._cut(word)
        assert b"".join(parts) == word
        at = 0
        for p in parts[:-1]:
            at += len(p)
            assert not any(word[a:b] in bpe.ranks for a in range(max(0, at - 40), at) for b in range(at + 1, min(len(word), at + 40)))


def test_unknown_ids_are_refused(bpe):
    with pytest.raises(ValueError):
        bpe.decode([(60_000).to_bytes(4, "little")])
