"""Normalise + required-key check against a model of the reference loader.

The model states, per field, what the reference's per-item Python does: which
reads raise (missing key, indexing into null), which values the insert
rejects (a non-integer id, an unparsable time, a non-numeric amount), and
what each field becomes otherwise (string ``"true"`` only for archived,
Python truthiness for the two ``bool()`` fields, the area guarded by the
experience keys). Random items must be reported by ``missing_required``
exactly when the model fails, and otherwise normalise to the model's record.
"""

import datetime as dt
import json
import re
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from jobsight.operators.normalise import missing_required, normalise
from jobsight.sources.pages import flatten_pages, parse_pages

ABSENT = object()


class Fails(Exception):
    pass


def _need(obj, key):
    if obj is None:
        raise Fails(f"{key} of null")
    if key not in obj:
        raise Fails(f"{key} missing")
    return obj[key]


def _as_int(v):
    if v is None:
        return None
    if isinstance(v, int):
        return v
    if isinstance(v, str) and re.fullmatch(r"\s*[+-]?\d+\s*", v):
        return int(v)
    raise Fails(f"bad int {v!r}")


def _truthy(v):
    return bool(v)


def model(item):
    rec = {"id": _as_int(_need(item, "id"))}
    if rec["id"] is None:
        raise Fails("null id")
    rec["vacancy_name"] = _need(item, "name")
    ts = _need(item, "published_at")
    try:
        rec["published_at"] = None if ts is None else dt.datetime.strptime(ts[:19], "%Y-%m-%dT%H:%M:%S")
    except ValueError as e:  # the timestamp column rejects it on insert
        raise Fails("bad time") from e
    rec["is_archive"] = _need(item, "archived") == "true"
    rec["is_open"] = _need(_need(item, "type"), "id") == "open"
    emp = _need(item, "employer")
    if emp is None:
        raise Fails("employer null")
    rec["employer_id"] = _as_int(emp.get("id"))
    rec["employer_name"] = emp.get("name")
    rec["is_accredited_it_employer"] = _truthy(emp.get("accredited_it_employer"))
    exp = _need(item, "experience")
    if exp is None:
        raise Fails("experience null")
    rec["experience_id"] = exp.get("id")
    rec["experience_name"] = exp.get("name")
    rec["area_id"] = _as_int(_need(_need(item, "area"), "id")) if "id" in exp else None
    rec["area_name"] = _need(_need(item, "area"), "name") if "name" in exp else None
    sal = _need(item, "salary")
    if sal is None:
        rec.update(salary_from=None, salary_to=None, salary_currency=None, is_gross=False)
    else:
        for k in ("from", "to"):
            v = _need(sal, k)
            rec[f"salary_{k}"] = None if v is None else Decimal(str(v)).quantize(Decimal("0.01"))
        rec["salary_currency"] = _need(sal, "currency")
        rec["is_gross"] = _truthy(_need(sal, "gross"))
    return rec


def maybe(strategy, absent=True):
    options = [st.none(), strategy] + ([st.just(ABSENT)] if absent else [])
    return st.one_of(*options)


def obj(**fields):
    return st.fixed_dictionaries({k: v for k, v in fields.items()}).map(
        lambda d: {k: v for k, v in d.items() if v is not ABSENT}
    )


truthy_values = st.sampled_from([True, False, 0, 1, "", "yes", [], {}])
int_text = st.one_of(st.integers(1, 10**6).map(str), st.just("x1"), st.integers(1, 10**6))
items = obj(
    id=st.one_of(st.integers(1, 10**6).map(str), st.just("abc"), st.just(ABSENT), st.none()),
    name=maybe(st.sampled_from(["Junior Data Engineer", "Аналитик данных"])),
    published_at=maybe(st.sampled_from(["2023-11-01T10:00:00+0300", "not a time"])),
    archived=maybe(st.sampled_from([True, False, "true", "false"])),
    type=maybe(obj(id=maybe(st.sampled_from(["open", "closed"])))),
    employer=maybe(obj(id=maybe(int_text), name=maybe(st.just("Acme")), accredited_it_employer=maybe(truthy_values))),
    experience=maybe(obj(id=maybe(st.just("between1And3")), name=maybe(st.just("1-3")))),
    area=maybe(obj(id=maybe(int_text), name=maybe(st.just("Moscow")))),
    salary=maybe(
        obj(
            **{
                "from": maybe(st.sampled_from([100, 250.5])),
                "to": maybe(st.sampled_from([200, 99.99])),
                "currency": maybe(st.sampled_from(["RUR", "USD"])),
                "gross": maybe(truthy_values),
            }
        )
    ),
)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(items, min_size=1, max_size=12))
def test_loader_model(spark, batch):
    # posexplode's position matches an item back to the batch.
    page = json.dumps({"page": 0, "items": batch}, ensure_ascii=False)
    flat = flatten_pages(parse_pages(spark.createDataFrame([(page,)], "value string")))
    flagged = {r["pos"] for r in missing_required(flat, keep=["page", "pos"]).collect()}
    expected_ok = {}
    for i, it in enumerate(batch):
        try:
            expected_ok[i] = model(it)
        except Fails:
            pass
    assert flagged == set(range(len(batch))) - set(expected_ok)
    ok_rows = flat.where(~flat["pos"].isin(list(flagged))) if flagged else flat
    records = normalise(ok_rows.select("item")).collect() if expected_ok else []
    by_id = {}
    for r in records:
        by_id.setdefault(r["id"], []).append(r.asDict())
    for i, want in expected_ok.items():
        assert want in by_id[want["id"]], (batch[i], by_id[want["id"]])
