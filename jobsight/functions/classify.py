"""Classification rules as column expressions.

Every rule is a first-match CASE with no ELSE: a value no rule matches is NULL.
All of them stay inside whole-stage codegen (no UDF).
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsight.schemas import RATE

# ---------------------------------------------------------------------------
# These must equal the reference's rules for equal results.
# ---------------------------------------------------------------------------

# Role from the title, case-insensitive contains, first match wins.
ROLE_RULES = [
    ("Инженер данных", ["data engineer", "data инженер", "data-инженер", "дата инженер", "инженер данных", "дата-инженер"]),
    ("Аналитик данных", ["аналитик данных", "data analyst", "data аналитик"]),
    ("Data scientist", ["data scientist", "исследователь данных"]),
]

# Grade from the title, case-sensitive contains, first match wins.
GRADE_RULES = [
    ("Intern", ["Стажер"]),
    ("Junior", ["Младший", "Junior"]),
    ("Middle", ["Старший", "Middle"]),
    ("Senior", ["Ведущий", "Senior"]),
    ("Team Lead", ["Руководитель", "Team Lead"]),
]

# Grade from the experience code, exact match.
EXPERIENCE_GRADES = [
    ("noExperience", "Intern"),
    ("between1And3", "Junior"),
    ("between3And6", "Middle"),
    ("moreThan6", "Senior"),
]

# Rate to roubles per currency code; any other code has no rate (NULL).
RUB_RATES = [("RUR", "1"), ("USD", "90"), ("KZT", "0.2"), ("BYR", "28.7")]

# Title phrases the source search asks for (fixed values).
SEARCH_PHRASES = [
    "Data Engineer",
    "Дата Инженер",
    "Инженер данных",
    "Аналитик данных",
    "Data Analyst",
    "Data scientist",
    "Исследователь данных",
]

# Grades in mart column order, with the short suffix the mart columns use.
GRADE_SUFFIXES = [("Intern", "intern"), ("Junior", "jun"), ("Middle", "middle"), ("Senior", "senior"), ("Team Lead", "lead")]

ROLE_DATA_ENGINEER = ROLE_RULES[0][0]
ROLE_DATA_ANALYST = ROLE_RULES[1][0]
ROLE_DATA_SCIENTIST = ROLE_RULES[2][0]


def _first_match(rules: list[tuple[str, Column]]) -> Column:
    expr = None
    for label, cond in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def role(title: Column | str) -> Column:
    """K1: role of a vacancy title (ILIKE '%p%' for each phrase)."""
    lowered = F.lower(_as_col(title))
    return _first_match([(label, _any([lowered.contains(p) for p in pats])) for label, pats in ROLE_RULES])


def grade(title: Column | str) -> Column:
    """K2: grade named in the title (LIKE '%p%', case-sensitive)."""
    t = _as_col(title)
    return _first_match([(label, _any([t.contains(p) for p in pats])) for label, pats in GRADE_RULES])


def grade_from_experience(experience_id: Column | str) -> Column:
    """K3: grade implied by the required-experience code."""
    e = _as_col(experience_id)
    return _first_match([(label, e == code) for code, label in EXPERIENCE_GRADES])


def rate_to_rub(currency: Column | str) -> Column:
    """K4: conversion rate to roubles as DECIMAL(12,6); NULL for unlisted codes."""
    c = _as_col(currency)
    expr = None
    for code, rate in RUB_RATES:
        value = F.lit(Decimal(rate)).cast(RATE)
        expr = F.when(c == code, value) if expr is None else expr.when(c == code, value)
    return expr.cast(RATE)


def effective_grade(grade_col: Column | str, grade_experience_col: Column | str) -> Column:
    """K5: the title grade if any, else the experience grade."""
    return F.coalesce(_as_col(grade_col), _as_col(grade_experience_col))


def title_matches_any(title: Column | str, phrases: list[str] = SEARCH_PHRASES) -> Column:
    """Contains-any over the search phrases; case, hyphens and the width of gaps do not count.

    The title and the phrases are folded alike, so no spelling that the role
    rules know for a searched phrase (``Дата-инженер``) is lost.
    """

    def folded(c: Column) -> Column:
        return F.regexp_replace(F.lower(c), r"[\s-]+", " ")

    text = folded(_as_col(title))
    return _any([text.contains(folded(F.lit(p))) for p in phrases])
