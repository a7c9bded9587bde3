"""JSON item normalisation and required keys (FIXTURES §3.2)."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from jobsight.operators.normalise import distinct_records, missing_required, normalise
from jobsight.sources.pages import flatten_pages, parse_pages


def _item(**over):
    base = {
        "id": "7",
        "name": "Junior Data Engineer",
        "published_at": "2023-11-01T10:00:00+0300",
        "archived": False,
        "type": {"id": "open"},
        "employer": {"id": "11", "name": "Acme", "accredited_it_employer": True},
        "experience": {"id": "between1And3", "name": "1-3"},
        "area": {"id": "2", "name": "Moscow"},
        "salary": {"from": 100, "to": 200.5, "currency": "RUR", "gross": True},
    }
    for k, v in over.items():
        if v is ...:
            base.pop(k, None)
        else:
            base[k] = v
    return base


def _items(spark, *items):
    page = json.dumps({"page": 0, "pages": 1, "found": len(items), "items": list(items)}, ensure_ascii=False)
    return flatten_pages(parse_pages(spark.createDataFrame([(page,)], "value string")))


def _one(spark, **over):
    return normalise(_items(spark, _item(**over))).first().asDict()


def test_full_item(spark):
    r = _one(spark)
    assert r["id"] == 7 and r["vacancy_name"] == "Junior Data Engineer"
    assert r["published_at"] == dt.datetime(2023, 11, 1, 10, 0, 0)  # zone suffix dropped
    assert r["is_open"] is True and r["is_archive"] is False
    assert (r["employer_id"], r["employer_name"], r["is_accredited_it_employer"]) == (11, "Acme", True)
    assert (r["area_id"], r["area_name"]) == (2, "Moscow")
    assert (r["salary_from"], r["salary_to"], r["salary_currency"], r["is_gross"]) == (
        Decimal("100.00"),
        Decimal("200.50"),
        "RUR",
        True,
    )


def test_archived_counts_only_the_string_true(spark):
    assert _one(spark, archived=True)["is_archive"] is False
    assert _one(spark, archived="true")["is_archive"] is True


def test_area_is_guarded_by_experience_keys(spark):
    r = _one(spark, experience={}, area={"id": "2"})
    assert r["area_id"] is None and r["area_name"] is None
    r = _one(spark, experience={"id": "noExperience"}, area={"id": "2", "name": "X"})
    assert r["area_id"] == 2 and r["area_name"] is None


def test_salary_null_and_gross_null(spark):
    r = _one(spark, salary=None)
    assert (r["salary_from"], r["salary_to"], r["salary_currency"], r["is_gross"]) == (None, None, None, False)
    r = _one(spark, salary={"from": 1, "to": None, "currency": "USD", "gross": None})
    assert r["is_gross"] is False and r["salary_from"] == Decimal("1.00")


@pytest.mark.parametrize(
    "value,expected",
    [(True, True), (False, False), (None, False), (0, False), (2, True), ("", False), ("no", True), ([], False), ({}, False), ({"a": 1}, True)],
)
def test_bool_fields_follow_python_truthiness(spark, value, expected):
    r = _one(spark, salary={"from": 1, "to": 2, "currency": "RUR", "gross": value},
             employer={"id": "1", "name": "x", "accredited_it_employer": value})
    assert r["is_gross"] is expected and r["is_accredited_it_employer"] is expected


def test_employer_without_id(spark):
    r = _one(spark, employer={"name": "x"})
    assert r["employer_id"] is None and r["employer_name"] == "x" and r["is_accredited_it_employer"] is False


def test_type_other_than_open(spark):
    assert _one(spark, type={"id": "closed"})["is_open"] is False


def test_malformed_id_raises(spark):
    with pytest.raises(Exception):
        normalise(_items(spark, _item(id="abc"))).collect()


def test_required_keys(spark):
    items = _items(
        spark,
        _item(id="1"),
        _item(id="2", salary=...),
        _item(id="3", salary=None),
        _item(id="4", experience={"id": "x"}, area={}),
        _item(id="5", name=..., archived=...),
        _item(id="abc"),
        _item(id="6", salary={"from": 1, "currency": "RUR", "gross": False}),
    )
    got = {r["id"]: r["missing"] for r in missing_required(items).collect()}
    assert got == {
        "2": "salary",
        "4": "area.id",
        "5": "name,archived",
        "abc": "id:malformed",
        "6": "salary.to",
    }


def test_distinct_drops_identical_copies_only(spark):
    a, b = _item(id="1"), _item(id="1", name="Other")
    df = distinct_records(normalise(_items(spark, a, a, b)))
    assert df.count() == 2


def test_read_pages_from_files(spark, scratch):
    import os

    from jobsight.sources.pages import read_pages

    doc = {"page": 0, "pages": 1, "found": 2, "items": [_item(id="1"), _item(id="2", archived="true")]}
    lines = os.path.join(scratch, "lines")
    os.makedirs(lines)
    with open(os.path.join(lines, "p0.json"), "w", encoding="utf-8") as f:
        f.write(json.dumps(doc, ensure_ascii=False) + "\n")
    pretty = os.path.join(scratch, "pretty")
    os.makedirs(pretty)
    with open(os.path.join(pretty, "p0.json"), "w", encoding="utf-8") as f:
        json.dump(doc, f, ensure_ascii=False, indent=2)
    for path, multiline in ((lines, False), (pretty, True)):
        got = normalise(flatten_pages(read_pages(spark, path, multiline))).orderBy("id").collect()
        assert [(r["id"], r["is_archive"]) for r in got] == [(1, False), (2, True)]
