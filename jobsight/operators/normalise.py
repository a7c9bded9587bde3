"""JSON item -> 16-column staging record.

Items are VARIANT, which keeps what the reference's dictionary tests see:

* key presence: ``variant_get(v, path, 'variant')`` is SQL NULL for an absent
  key and a variant null for a key present with JSON null;
* JSON types: ``archived`` counts only as the *string* "true" (the reference
  compares with a string, so a JSON boolean true gives False).

All columns are one projection of built-in expressions; no UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsight.schemas import MONEY, STAGING

_ITEM = "item"


def _get(path: str, type_: str) -> Column:
    """Strict extraction: a value that does not cast raises (like ``int()``)."""
    return F.variant_get(F.col(_ITEM), path, type_)


def _node(path: str) -> Column:
    return F.variant_get(F.col(_ITEM), path, "variant")


def _present(path: str) -> Column:
    return _node(path).isNotNull()


def _absent(path: str) -> Column:
    return _node(path).isNull()


def _absent_or_null(path: str) -> Column:
    return _absent(path) | F.is_variant_null(_node(path))


def _truthy(path: str) -> Column:
    """Python ``bool(value)`` of a JSON value: null / absent, false, 0, "", [] and
    {} are False; everything else is True (the reference wraps two fields in
    ``bool()``)."""
    node = _node(path)
    kind = F.schema_of_variant(node)
    return (
        F.when(node.isNull() | F.is_variant_null(node), F.lit(False))
        .when(kind == "BOOLEAN", F.variant_get(node, "$", "boolean"))
        .when(kind == "STRING", F.length(F.variant_get(node, "$", "string")) > 0)
        .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(node, "$", "array<variant>")) > 0)
        .when(kind.startswith("OBJECT"), F.size(F.try_variant_get(node, "$", "map<string,variant>")) > 0)
        .otherwise(F.try_variant_get(node, "$", "double") != 0)
    )


def _is_object(path: str) -> Column:
    return F.coalesce(F.schema_of_variant(_node(path)).startswith("OBJECT"), F.lit(False))


def normalise(items: DataFrame) -> DataFrame:
    """Project flattened items (column ``item``) onto the staging schema."""
    record = [
        _get("$.id", "bigint").alias("id"),
        _get("$.name", "string").alias("vacancy_name"),
        _get("$.published_at", "string").cast("timestamp_ntz").alias("published_at"),
        F.coalesce(F.to_json(_node("$.archived")) == F.lit('"true"'), F.lit(False)).alias("is_archive"),
        F.coalesce(_get("$.type.id", "string") == F.lit("open"), F.lit(False)).alias("is_open"),
        _get("$.employer.id", "bigint").alias("employer_id"),
        _get("$.employer.name", "string").alias("employer_name"),
        _truthy("$.employer.accredited_it_employer").alias("is_accredited_it_employer"),
        _get("$.experience.id", "string").alias("experience_id"),
        _get("$.experience.name", "string").alias("experience_name"),
        # The area is guarded by keys of *experience*, as in the reference.
        F.when(_present("$.experience.id"), _get("$.area.id", "int")).alias("area_id"),
        F.when(_present("$.experience.name"), _get("$.area.name", "string")).alias("area_name"),
        _get("$.salary.from", "decimal(18,2)").cast(MONEY).alias("salary_from"),
        _get("$.salary.to", "decimal(18,2)").cast(MONEY).alias("salary_to"),
        _get("$.salary.currency", "string").alias("salary_currency"),
        _truthy("$.salary.gross").alias("is_gross"),
    ]
    out = items.select(*record)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in STAGING.fields])


def distinct_records(records: DataFrame) -> DataFrame:
    """Set semantics over all 16 columns (identical re-reads vanish)."""
    return records.distinct()


# Keys the reference reads without a presence test. Each entry is
# (label, offending-condition); a row may fail several.
def _malformed(path: str, type_: str, guard: Column | None = None) -> Column:
    """A present, non-null value that does not convert to ``type_``."""
    node = _node(path)
    bad = node.isNotNull() & ~F.is_variant_null(node) & F.try_variant_get(F.col(_ITEM), path, type_).isNull()
    return bad if guard is None else guard & bad


def _required_rules() -> list[tuple[str, Column]]:
    area_used = _present("$.experience.id") | _present("$.experience.name")
    salary_obj = _is_object("$.salary")
    published = F.try_variant_get(F.col(_ITEM), "$.published_at", "string")
    return [
        ("id", _absent_or_null("$.id")),
        ("id:malformed", _malformed("$.id", "bigint")),
        ("name", _absent("$.name")),
        ("published_at", _absent("$.published_at")),
        ("published_at:malformed", published.isNotNull() & published.try_cast("timestamp_ntz").isNull()),
        ("archived", _absent("$.archived")),
        ("type", _absent_or_null("$.type")),
        ("type.id", _is_object("$.type") & _absent("$.type.id")),
        ("employer", _absent_or_null("$.employer")),
        ("experience", _absent_or_null("$.experience")),
        ("area", area_used & _absent_or_null("$.area")),
        ("area.id", _present("$.experience.id") & _is_object("$.area") & _absent("$.area.id")),
        ("area.name", _present("$.experience.name") & _is_object("$.area") & _absent("$.area.name")),
        ("salary", _absent("$.salary")),
        ("salary.from", salary_obj & _absent("$.salary.from")),
        ("salary.to", salary_obj & _absent("$.salary.to")),
        ("salary.currency", salary_obj & _absent("$.salary.currency")),
        ("salary.gross", salary_obj & _absent("$.salary.gross")),
        # Values the target table's column types reject on insert.
        ("employer.id:malformed", _malformed("$.employer.id", "bigint")),
        ("area.id:malformed", _malformed("$.area.id", "int", _present("$.experience.id"))),
        ("salary.from:malformed", _malformed("$.salary.from", "decimal(18,2)", salary_obj)),
        ("salary.to:malformed", _malformed("$.salary.to", "decimal(18,2)", salary_obj)),
    ]


def missing_required(items: DataFrame, keep: list[str] = ["page"]) -> DataFrame:  # noqa: B006
    """Items that would fail the reference's loader (a key read without a
    presence test) or its insert (a value the column type rejects).

    Returns ``keep`` columns, the raw item ``id`` (text) and ``missing``: the
    failed rules joined by commas, in rule order. Empty means the batch loads.
    """
    rules = _required_rules()
    flags = [F.when(F.coalesce(cond, F.lit(False)), F.lit(label)) for label, cond in rules]
    bad = reduce(lambda a, b: a | b, [F.coalesce(cond, F.lit(False)) for _, cond in rules])
    raw_id = F.try_variant_get(F.col(_ITEM), "$.id", "string")
    return items.where(bad).select(*keep, raw_id.alias("id"), F.concat_ws(",", *flags).alias("missing"))
