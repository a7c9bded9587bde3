import duckdb
import pytest

from jobsight.llm.warc import OP2_SQL, assemble, op2_transactions, read_archives, write_archives
from tests.conftest import SF_SMALL

BIG = "<p>" + "x" * 200
TRICKY = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n" + "é" * 60 + "\r\n\r\n"
PAGES = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, "http://a/3", TRICKY), (4, None, None), (5, "http://a/5", ""),
    (6, "http://a/6\r\nX: 1", "short"), (7, "http://a/7", "short"), (8, "u", TRICKY), (None, "n", BIG), (2, "http://a/2", BIG), (1, "http://a/1", BIG),
]


@pytest.fixture(scope="module")
def captures(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "archive")
    pages = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, digest string, target string")
    write_archives(pages.repartition(3), path)
    return assemble(read_archives(spark, path)).collect()


def test_every_page_is_one_capture_with_request_and_metadata(captures):
    assert len(captures) == len(PAGES)
    assert all(c["request"] and c["metadata"] for c in captures)


def test_payloads_round_trip(captures):
    want = sorted((i or -1, (h or "").encode()) for i, _, h in PAGES)
    got = sorted((c["capture"]["page_id"] or -1, bytes((c["original"] or c["capture"])["body"])) for c in captures)
    assert got == want


def test_equal_payloads_are_revisits_of_the_smallest_page(captures):
    kinds = sorted((c["capture"]["page_id"] or -1, c["capture"]["type"], c["original"] and c["original"]["page_id"]) for c in captures)
    assert kinds == sorted([
        (1, "response", None), (1, "response", None), (2, "revisit", 1), (2, "revisit", 1), (3, "response", None), (4, "response", None),
        (5, "response", None), (6, "response", None), (7, "response", None), (8, "revisit", 3), (-1, "response", None),
    ])


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF_SMALL}/pages.parquet'")
    got = op2_transactions(spark, SF_SMALL)
    want = con.sql(OP2_SQL)
    assert sorted(got.columns) == sorted(want.columns)
    rows = {tuple(r[c] for c in want.columns) for r in got.collect()}
    assert rows == set(want.fetchall()) and got.count() == len(rows)


def test_empty_table(spark, tmp_path):
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "a"))
    assert assemble(read_archives(spark, str(tmp_path / "a"))).count() == 0


def test_the_query_joins_request_metadata_and_original(spark):
    df = op2_transactions(spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 3
    assert {r["n_records"] for r in df.collect()} <= {3, 4}
