import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from jobsight.llm.packing import LENGTH, Ids, best_fit, op10_best_fit, pack_documents
from tests.conftest import SF_SMALL
from tests.llm.helpers import EDGE, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a  b", " x", "x ", "a\n\nb", "a\n b", "a\tb c", "<|endoftext|> x<|endoftext|>", "it's don't 'LL", "\n", "é 漢字 \U0001f600", "a\x1cb", "1" * 3000, " " * 500 + "z", " a b", ""]


def reference(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_the_tokenizers_library(spark):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + ODD
    assert [x.tolist() for x in Ids(PATH).batch(texts)] == reference(texts)


def test_added_tokens_have_their_ids_as_by_the_librarys_default(spark):
    end = "<|endoftext|>"
    texts = [*ODD, f"a {end} b", end, end * 3, f"a  {end}  b\n{end}\n", f"<{end}>", "<|endoftext|", f"it{end}'s", f" x \t{end}\u3000漢"]
    library = Tokenizer.from_file(PATH)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in Ids(PATH, added=True).batch(texts)] == want and want[len(ODD)] == [64, 220, 50256, 275]
    rows = pack_documents(documents(spark, list(enumerate(texts))), PATH, with_ids=True).collect()
    start = {(r["doc_id"], r["start"]): r["ids"] for r in rows}
    got = {d: sum((start[k] for k in sorted(start) if k[0] == d), []) for d in range(len(texts))}
    assert got == {d: [*ids, 0] for d, ids in enumerate(want)}


def test_long_white_space_has_the_librarys_ids():
    mixed = "".join(random.Random(3).choices(" \n\t\u3000", k=1_000_000))
    texts = ["x" + " " * 1_200_000 + "y", "\n" * 2_000_000, "a " + mixed + " b", " " * 5_000_000 + "<|endoftext|>", "x" + "\n" * 99_999 + "y"]
    for added in (True, False):
        library = Tokenizer.from_file(PATH)
        library.encode_special_tokens = not added
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in Ids(PATH, added=added).batch(texts)] == want


def _checked(rows, docs, length):
    ids = {}
    for d, t in docs:
        ids.setdefault(d, reference([t or ""])[0] + [0])
    whole = defaultdict(set)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] <= length and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        whole[r["doc_id"]].add((r["piece"], r["start"], r["length"]))
    for d, x in ids.items():
        at, n = 0, -(-len(x) // length)
        for k, (piece, start, size) in enumerate(sorted(whole[d])):
            assert (piece, start) == (k, at) and (size == length or k == 0)
            at += size
        assert at == len(x) and len(whole[d]) == n
    seq = defaultdict(list)
    for r in rows:
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= length
    return len(seq)


def test_query_round_trip_and_count(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = op10_best_fit(spark, SF_SMALL).collect()
    n = _checked(rows, docs, LENGTH)
    assert n <= 1.02 * -(-sum(r["length"] for r in rows) // LENGTH) + 1


def test_edge_rows(spark):
    rows = pack_documents(documents(spark, EDGE), PATH, 64, with_ids=True).collect()
    assert sum(r["doc_id"] == 5 and r["piece"] == 0 for r in rows) == 2
    assert sum(r["piece"] == 0 for r in rows) == len(EDGE) and all(len(r["ids"]) == r["length"] for r in rows)
    for d in (1, 2, 10):
        assert [(r["length"], r["ids"]) for r in rows if r["doc_id"] == d] == [(1, [0])]
    assert pack_documents(documents(spark, []), PATH).count() == 0


def first_fit_decreasing(sizes, length):
    gaps = []
    for s in sorted(sizes, reverse=True):
        for i, g in enumerate(gaps):
            if g >= s:
                gaps[i] -= s
                break
        else:
            gaps.append(length - s)
    return len(gaps)


def test_best_fit_places_every_piece_once():
    r = random.Random(2)
    for trial in range(60):
        length = r.choice([7, 10, 64, 100])
        sizes = Counter(r.randint(1, length) for _ in range(r.randint(0, 300)))
        runs, made = best_fit(dict(sizes), length)
        use, seen = defaultdict(list), Counter()
        for s, lo, hi, first, offset in runs:
            seen[s] += hi - lo
            for k in range(hi - lo):
                use[first + k].append((offset, s))
        assert seen == sizes and set(use) == set(range(made))
        for parts in use.values():
            at = 0
            for o, s in sorted(parts):
                assert o == at
                at += s
            assert at <= length
        assert made <= 1.1 * first_fit_decreasing(list(sizes.elements()), length) + 1, trial
