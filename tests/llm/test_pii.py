import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from jobsight.llm.pii import base_spans, find_personal_data, luhn, op9_disclosure, sanitise
from tests.conftest import SF_SMALL
from tests.llm.helpers import EDGE, documents, prose

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def literal(text):
    """The four patterns as they are written, failing matches dropped."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_literal_patterns():
    r = random.Random(11)
    for alphabet in ("ab@.-1 ", "0123.", "0123456789 -", "+12 ().-", "a@.b@c d+1%", "4111 -@.a+("):
        for _ in range(400):
            t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))
            assert [x[:3] for x in base_spans(t)] == literal(t), t
    assert [x[0] for x in base_spans("4111 1111 1111 1111")] == ["card"]


def test_long_runs_take_linear_time():
    for t in ("1" * 200_000, "a" * 300_000, "@" * 100_000, "1." * 100_000, "a@" * 100_000, "+1" * 50_000):
        base_spans(t)


def test_query_equals_brute_force(spark):
    got = {r["doc_id"]: r for r in op9_disclosure(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    found = 0
    for d in docs:
        want, r = literal(d["text"] or ""), got[d["doc_id"]]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(w[0] == k for w in want) for k in PATTERNS]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest() and r["spans"].startswith(joined)
        found += len(want)
    assert found > 5


def test_a_term_seen_only_with_an_entity_discloses_it(spark):
    rows = [(i, f"{prose(i, 30)} contact zyxwarden at boss@corp.org about {prose(i + 900, 30)}") for i in range(4)]
    rows += [(10 + i, prose(i + 500, 60) + " contact about") for i in range(30)]
    copies = [(50 + i, f"{prose(77, 20)} qqunique mail one@two.net {prose(78, 20)}") for i in range(6)]  # one context
    got = {r["doc_id"]: r for r in find_personal_data(documents(spark, rows + copies)).collect()}
    for i, t in rows[:4]:
        terms = [t[a["start"] : a["end"]] for a in got[i]["added"]]
        assert "zyxwarden" in terms and "contact" not in terms
    assert all(not got[50 + i]["added"] for i in range(6)) and all(not got[10 + i]["added"] for i in range(30))
    clean = {r["doc_id"]: r["text"] for r in sanitise(documents(spark, rows + copies)).collect()}
    assert "[TERM] at [EMAIL] about" in clean[0] and "boss@" not in clean[0] and clean[10] == rows[4][1]


def test_terms_of_one_or_two_contexts_disclose(spark):
    rest = [(100 + i, prose(i + 2000, 40) + " write to or at") for i in range(100)]
    one = [(1, f"{prose(1, 9)} write to “Li” or order 4711 at li@corp.org {prose(2, 9)}")]
    two = [(2 + i, f"{prose(3 + i, 9)} write to ÉMILE or Bo at +44 20 7946 0018 {prose(6 + i, 9)}") for i in range(2)]
    copies = [(10 + i, f"{prose(9, 20)} qqunique mail one@two.net") for i in range(20)]  # one context, a sixth of all
    docs = documents(spark, one + two + copies + rest)
    got = {r["doc_id"]: r for r in find_personal_data(docs, min_term=1).collect()}
    for i, t in one + two:
        terms = {t[a["start"] : a["end"]] for a in got[i]["added"]}
        assert ({"Li", "order", "4711"} if i == 1 else {"ÉMILE", "Bo"}) <= terms and not terms & {"write", "to", "or", "at"}
    assert not any(got[d]["added"] for d, _ in copies + rest)
    assert "“[TERM]” or [TERM] [TERM] at [EMAIL]" in {r["doc_id"]: r["text"] for r in sanitise(docs, min_term=1).collect()}[1]


def test_the_query_adds_spans_on_a_given_table(spark):
    assert sum("term:" in r["spans"] for r in op9_disclosure(spark, SF_SMALL).collect()) > 0


def test_edge_rows(spark):
    rows = [*EDGE, (11, "mail a@b.co"), (11, "mail a@b.co"), (11, "other"), (None, "x@y.zz")]
    docs = documents(spark, rows)
    assert find_personal_data(docs).count() == len(rows)
    out = sanitise(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    texts = [r["text"] for r in out.collect()]
    assert texts.count("mail [EMAIL]") == 2 and texts.count("[EMAIL]") == 1 and texts.count(None) == 3
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect() if r["text"] is not None)
    assert sanitise(documents(spark, [])).count() == 0


def test_repeated_rows_count_once(spark):
    one = (1, f"{prose(1, 9)} write to zyxwarden or order at li@corp.org {prose(2, 9)}")
    rest = [(100 + i, prose(i + 2000, 40) + " write to or at order") for i in range(100)]
    many = [one, *rest]

    def spans(rows):
        return {r["doc_id"]: [tuple(a) for a in r["added"] or ()] for r in find_personal_data(documents(spark, rows), min_term=1).collect()}

    want = spans(many)
    assert want[1] and not want[100]
    assert spans([*many, one, one, one, one]) == spans(many * 2) == want


def disclosing(rows, window=8, threshold=0.9):
    """(entity, term) pairs by counting in plain dictionaries."""
    n_t, n_e, pairs = Counter(), Counter(), defaultdict(lambda: (set(), set()))
    rows = set(rows)
    for d, text in rows:
        terms = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text)]
        n_t.update({text[a:b].lower() for a, b in terms})
        base = base_spans(text)
        n_e.update({(k, e) for k, _, _, e in base})
        for k, s, e, entity in base:
            left, right = [t for t in terms if t[0] < s][-window:], [t for t in terms if t[0] >= e][:window]
            near = [text[a:b].lower() for a, b in left + right if not any(x < b and y > a for _, x, y, _ in base)]
            for t in near:
                pairs[(k, entity), t][0].add(tuple(near))
                pairs[(k, entity), t][1].add((tuple(near), d, text))
    out = set()
    for ((k, e), t), (contexts, docs) in pairs.items():
        c, n = len(contexts), len(rows)
        n_te = min(len(docs), n_t[t])
        if n_e[k, e] < n and math.log((c + 1) / (c + 2) * n_te * n / (n_t[t] * n_e[k, e])) >= threshold * math.log(n / n_e[k, e]):
            out.add((f"{k}:{e}", t))
    return out


def test_disclosure_equals_plain_counting(spark):
    r = random.Random(8)
    names = ["li", "bo", "émile", "x9", "warden", "yotta"]
    mail = [f"{n}@corp{i}.org" for i, n in enumerate(names)]
    rows = []
    for i in range(160):
        words = prose(i, 25).split()
        for _ in range(r.randrange(3) if i < 40 else 0):
            k = r.randrange(len(names))
            words[r.randrange(25) : 0] = [names[k], mail[k]] if r.random() < 0.8 else [mail[k]]
            words.insert(r.randrange(len(words)), mail[k])
        rows.append((i, " ".join(words)))
    rows += rows[:20]
    got = set()
    texts = dict(rows)
    for row in find_personal_data(documents(spark, rows), min_term=1).collect():
        text = texts[row["doc_id"]]
        got |= {text[a["start"] : a["end"]].lower() for a in row["added"] or ()}
    want = disclosing(rows)
    assert want and got == {t for _, t in want}


def test_a_term_within_many_nested_spans_is_covered(spark):
    digits = ".".join(["1.2.3.4"] * 12)
    text = f"see {digits}@corp.org now"
    (row,) = find_personal_data(documents(spark, [(1, text), *[(2 + i, prose(i, 30)) for i in range(99)]]), min_term=1).where("doc_id = 1").collect()
    (email,) = [s for s in row["base"].split(",") if s.startswith("email")]
    start, end = map(int, email.split(":")[1:])
    assert not any(a["start"] < end and a["end"] > start for a in row["added"] or ())
