"""Oracle SQL (DuckDB) for every query key with a SQL equivalent.

Written independently of the Spark code: the fixture, the classification and
the marts are spelled out as SQL. Money is exact: salaries times rates
in integer 1e-8 units (HUGEINT), half-up rounding as integer division, DOUBLE
only at the end, so both sides produce the same correctly rounded doubles.
"""

from __future__ import annotations

# --------------------------------------------------------------- fixture view
V = """v AS (
  SELECT
    o.o_orderkey AS id,
    (CASE o.o_orderkey % 7 WHEN 0 THEN 'Стажер ' WHEN 1 THEN 'Junior ' WHEN 2 THEN 'Старший '
       WHEN 3 THEN 'Senior ' WHEN 4 THEN 'Team Lead ' ELSE '' END) ||
    (CASE o.o_orderkey % 8 WHEN 0 THEN 'Data Engineer' WHEN 1 THEN 'Дата-инженер' WHEN 2 THEN 'АНАЛИТИК ДАННЫХ'
       WHEN 3 THEN 'data analyst' WHEN 4 THEN 'Data Scientist' WHEN 5 THEN 'Исследователь данных'
       WHEN 6 THEN 'Data Engineer / Data Analyst' ELSE 'Python developer' END) AS vacancy_name,
    o.o_orderdate AS published_at,
    o.o_orderkey % 13 = 0 AS is_archive,
    o.o_orderstatus <> 'F' AS is_open,
    CASE WHEN o.o_orderkey % 19 <> 0 THEN c.c_custkey END AS employer_id,
    CASE WHEN o.o_orderkey % 19 <> 0 THEN c.c_name END AS employer_name,
    o.o_orderkey % 23 = 0 AS is_accredited_it_employer,
    CASE o.o_orderpriority WHEN '5-LOW' THEN 'noExperience' WHEN '4-NOT SPECIFIED' THEN 'between1And3'
       WHEN '3-MEDIUM' THEN 'between3And6' WHEN '2-HIGH' THEN 'moreThan6' END AS experience_id,
    CASE WHEN o.o_orderpriority <> '1-URGENT' THEN o.o_orderpriority END AS experience_name,
    CASE WHEN o.o_orderkey % 17 <> 0 THEN n.n_nationkey END AS area_id,
    CASE WHEN o.o_orderkey % 17 <> 0 THEN n.n_name END AS area_name,
    CASE WHEN NOT (o.o_orderkey % 9 = 8 OR o.o_orderkey % 11 IN (0, 1))
       THEN CAST(floor(o.o_totalprice / 1000) AS BIGINT) END AS salary_from,
    CASE WHEN NOT (o.o_orderkey % 9 = 8 OR o.o_orderkey % 11 IN (1, 2, 3))
       THEN CAST(floor(o.o_totalprice / 800) AS BIGINT) END AS salary_to,
    CASE o.o_orderkey % 9 WHEN 4 THEN 'USD' WHEN 5 THEN 'KZT' WHEN 6 THEN 'BYR' WHEN 7 THEN 'EUR'
       WHEN 8 THEN NULL ELSE 'RUR' END AS salary_currency,
    o.o_orderkey % 9 <> 8 AND o.o_orderkey % 29 = 0 AS is_gross
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

# ---------------------------------------------------------------------------
# Fixed values (equal to the reference's rules): role phrases (case-insensitive
# contains), grade words (case-sensitive contains), experience grades, and
# rates to roubles in millionths. First match wins; no match gives NULL.
# ---------------------------------------------------------------------------
ROLE_PHRASES = [
    ("Инженер данных", ["data engineer", "data инженер", "data-инженер", "дата инженер", "инженер данных", "дата-инженер"]),
    ("Аналитик данных", ["аналитик данных", "data analyst", "data аналитик"]),
    ("Data scientist", ["data scientist", "исследователь данных"]),
]
GRADE_WORDS = [
    ("Intern", ["Стажер"]),
    ("Junior", ["Младший", "Junior"]),
    ("Middle", ["Старший", "Middle"]),
    ("Senior", ["Ведущий", "Senior"]),
    ("Team Lead", ["Руководитель", "Team Lead"]),
]
EXPERIENCE_GRADE = [("noExperience", "Intern"), ("between1And3", "Junior"), ("between3And6", "Middle"), ("moreThan6", "Senior")]
RATE_MICRO = [("RUR", 1000000), ("USD", 90000000), ("KZT", 200000), ("BYR", 28700000)]


def _first_match(arms: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN {value}" for cond, value in arms) + " END"


def _contains_any(col: str, words: list[str], op: str) -> str:
    return "(" + " OR ".join(f"{col} {op} '%{w}%'" for w in words) + ")"


def role_case(title: str) -> str:
    return _first_match([(_contains_any(title, ws, "ILIKE"), f"'{r}'") for r, ws in ROLE_PHRASES])


def grade_case(title: str) -> str:
    return _first_match([(_contains_any(title, ws, "LIKE"), f"'{g}'") for g, ws in GRADE_WORDS])


def exp_case(experience: str) -> str:
    return _first_match([(f"{experience} = '{code}'", f"'{g}'") for code, g in EXPERIENCE_GRADE])


def rate6_case(currency: str) -> str:
    """Rate in 1e-6 units (exact integers)."""
    return _first_match([(f"{currency} = '{code}'", str(v)) for code, v in RATE_MICRO])

def fact_cte(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT DISTINCT
    id AS vacancy_id,
    {role_case('vacancy_name')} AS vacancy_name,
    {grade_case('vacancy_name')} AS grade,
    {exp_case('experience_id')} AS grade_experience,
    published_at, is_archive, is_open, employer_id, experience_id, area_id,
    salary_from, salary_to, is_gross, salary_currency
  FROM {src}
)"""


FACT = fact_cte("f", "v")


CUR = f"""cur AS (
  SELECT DISTINCT salary_currency AS currency_id, {rate6_case('salary_currency')} AS rate6 FROM v
)"""

DIM_AREA = "dim_area AS (SELECT DISTINCT area_id, area_name AS name FROM v)"
DIM_EMPLOYER = "dim_employer AS (SELECT DISTINCT employer_id, employer_name AS name FROM v)"

# f ⟕ cur with amounts in 1e-8 roubles.
PRICED = """SELECT f.*, COALESCE(f.grade, f.grade_experience) AS eff,
    CAST(f.salary_from AS HUGEINT) * 100 * cur.rate6 AS from8,
    CAST(f.salary_to AS HUGEINT) * 100 * cur.rate6 AS to8
  FROM f LEFT JOIN cur ON f.salary_currency = cur.currency_id"""

GRADES = [("Intern", "intern"), ("Junior", "jun"), ("Middle", "middle"), ("Senior", "senior"), ("Team Lead", "lead")]
COUNTED = [("Intern", "cnt_intern"), ("Junior", "cnt_junior"), ("Middle", "cnt_middle"), ("Senior", "cnt_senior")]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _dbl8(x: str) -> str:
    return f"CAST({x} AS DOUBLE) / CAST(100000000 AS DOUBLE)"


def _dbl2(x: str) -> str:
    return f"CAST({x} AS DOUBLE) / CAST(100 AS DOUBLE)"


def _avg_cents(g: str) -> str:
    pay = f"CASE WHEN eff = '{g}' THEN COALESCE(to8, from8) END"
    return f"(2 * SUM({pay}) + COUNT({pay}) * 1000000) // NULLIF(2 * COUNT({pay}) * 1000000, 0)"


def _stats_select() -> list[str]:
    out = [f"{_avg_cents(g)} AS avgc_{s}" for g, s in GRADES]
    out += [f"MIN(CASE WHEN eff = '{g}' THEN from8 END) AS min8_{s}" for g, s in GRADES]
    out += [f"MAX(CASE WHEN eff = '{g}' THEN to8 END) AS max8_{s}" for g, s in GRADES]
    out += ["MIN(from8) AS min8_all", "MAX(to8) AS max8_all"]
    return out


STAT_RAW = [f"avgc_{s}" for _, s in GRADES] + [f"min8_{s}" for _, s in GRADES] + [f"max8_{s}" for _, s in GRADES]
STAT_RAW += ["min8_all", "max8_all"]


def _stats_out(p: str) -> list[str]:
    out = [f"{_dbl2(p + 'avgc_' + s)} AS avg_sal_{s}" for _, s in GRADES]
    out += [f"{_dbl8(p + 'min8_' + s)} AS min_sal_{s}" for _, s in GRADES]
    out += [f"{_dbl8(p + 'max8_' + s)} AS max_sal_{s}" for _, s in GRADES]
    out += [f"{_dbl8(p + 'min8_all')} AS min_salary", f"{_dbl8(p + 'max8_all')} AS max_salary"]
    return out


def _ratio_out(p: str) -> list[str]:
    return [
        _dbl2(f"(2 * {p}avgc_{s} * 100000000 + {p}max8_all) // (2 * {p}max8_all)") + f" AS ratio_sal_{s}"
        for _, s in GRADES
    ]


def _counts_out(p: str) -> list[str]:
    """Counts of a group; per-grade counts are NULL rather than 0."""
    def count(cond: str) -> str:
        return f"COUNT(*) FILTER (WHERE {cond})"

    out = [
        f"CAST({count(p + 'is_open')} AS BIGINT) AS cnt_vacancy",
        f"CAST({count(f'{p}salary_from IS NOT NULL OR {p}salary_to IS NOT NULL')} AS BIGINT) AS cnt_vac_salary",
    ]
    graded = f"COALESCE({p}grade, {p}grade_experience)"
    out += [f"CAST(NULLIF({count(f"{graded} = '{g}'")}, 0) AS BIGINT) AS {c}" for g, c in COUNTED]
    lead = count(f"{p}grade = 'Team Lead'")
    out.append(f"CAST(NULLIF({lead}, 0) AS BIGINT) AS cnt_lead")
    return out


COUNT_NAMES = ["cnt_vacancy", "cnt_vac_salary", *(c for _, c in COUNTED), "cnt_lead"]


def mart_sql(
    key: str, role: str | None, dim: str | None, name_col: str | None, source: tuple[str, ...] = ()
) -> str:
    """A mart over the records; ``source`` are the CTEs of a view to use in their place.

    One aggregation per key. A NULL key has counts but no statistics; keys the
    dimension lacks fall together under NULL where their statistics agree.
    """
    ctes = [FACT, CUR]
    if dim:
        ctes.append(DIM_AREA if dim == "dim_area" else DIM_EMPLOYER)
    if source:
        ctes = [V, *source, *(c.replace("FROM v", "FROM n") for c in ctes)]
    else:
        ctes.insert(0, V)
    where = f" WHERE vacancy_name = '{role}'" if role else ""
    figures = ",\n    ".join([*_counts_out(""), *_stats_select()])
    ctes.append(f"by_key AS (\n  SELECT {key} AS k,\n    {figures}\n  FROM ({PRICED}) p{where}\n  GROUP BY {key}\n)")
    known = ", ".join(f"CASE WHEN k IS NOT NULL THEN {c} END AS {c}" for c in STAT_RAW)
    ctes.append(f"keyed AS (SELECT k, {', '.join(COUNT_NAMES)}, {known} FROM by_key)")
    if dim:
        out_key, names, join = f"d.{key}", [f"d.name AS {name_col}"], f" LEFT JOIN {dim} d ON d.{key} = keyed.k"
    else:
        out_key, names, join = "keyed.k", [], ""
    columns = [
        f"CAST(ROW_NUMBER() OVER (ORDER BY {out_key} ASC NULLS LAST) AS BIGINT) AS id", f"{out_key} AS {key}", *names,
        *(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in COUNT_NAMES), *_stats_out(""), *_ratio_out(""),
    ]
    group = [out_key, *(["d.name"] if dim else []), *STAT_RAW]
    return _with(*ctes) + "SELECT\n  " + ",\n  ".join(columns) + f"\nFROM keyed{join}\nGROUP BY " + ", ".join(group)


MART_ARGS = {
    "mart_de_region": ("area_id", "Инженер данных", "dim_area", "area_name"),
    "mart_da_region": ("area_id", "Аналитик данных", "dim_area", "area_name"),
    "mart_ds_region": ("area_id", "Data scientist", "dim_area", "area_name"),
    "mart_de_employer": ("employer_id", "Инженер данных", "dim_employer", "employer_name"),
    "mart_da_employer": ("employer_id", "Аналитик данных", "dim_employer", "employer_name"),
    "mart_ds_employer": ("employer_id", "Data scientist", "dim_employer", "employer_name"),
    "mart_vacancies": ("vacancy_name", None, None, None),
}


def _grain_stats(cols: list[str]) -> str:
    """The stats CTE by employer over the whole fact, selecting ``cols``."""
    return (
        _with(V, FACT, CUR)
        + "SELECT employer_id, "
        + ", ".join(cols)
        + " FROM (SELECT employer_id, "
        + ", ".join(_stats_select())
        + f" FROM ({PRICED}) vac GROUP BY employer_id) s"
    )


def _grain_counts(cols: list[str]) -> str:
    outs = {c.split(" AS ")[-1]: c for c in _counts_out("")}
    return (
        _with(V, FACT)
        + "SELECT employer_id, "
        + ", ".join(outs[c] for c in cols)
        + " FROM f GROUP BY employer_id"
    )


STATS_OUT = {c.split(" AS ")[-1]: c for c in _stats_out("")}


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


# --------------------------------------------------------------- day batches
D1 = "d1 AS (SELECT * FROM v WHERE published_at < TIMESTAMP '1999-01-01')"
D2 = """d2 AS (
  SELECT * REPLACE (
    salary_from + 1 AS salary_from,
    NOT is_open AS is_open,
    CASE WHEN area_id % 2 = 0 THEN area_name || ' (new)' ELSE area_name END AS area_name,
    CASE WHEN employer_id % 2 = 0 THEN employer_name || ' (new)' ELSE employer_name END AS employer_name,
    CASE WHEN length(experience_name) % 2 = 0 THEN experience_name || ' (new)' ELSE experience_name END
      AS experience_name)
  FROM v WHERE published_at >= TIMESTAMP '1998-07-01'
)"""


def _dim_merge(key: str, name: str, extra: str = "") -> str:
    return (
        _with(V, D1, D2)
        + f"SELECT COALESCE(t.{key}, s.{key}) AS {key},\n"
        f"  CASE WHEN s.p IS NOT NULL AND (t.p IS NULL OR COALESCE(t.name, '') <> COALESCE(s.name, ''))"
        f" THEN s.name ELSE t.name END AS name{extra}\n"
        f"FROM (SELECT DISTINCT {key}, {name} AS name, 1 AS p FROM d1) t\n"
        f"FULL OUTER JOIN (SELECT DISTINCT {key}, {name} AS name, 1 AS p FROM d2) s ON t.{key} = s.{key}"
    )


FACT_COLS = [
    "vacancy_id", "vacancy_name", "grade", "grade_experience", "published_at", "is_archive", "is_open",
    "employer_id", "experience_id", "area_id", "salary_from", "salary_to", "is_gross", "salary_currency",
]


def _fact_merge() -> str:
    def pick(c):
        e = f"CASE WHEN s.p IS NOT NULL THEN s.{c} ELSE t.{c} END"
        return f"CAST({e} AS DOUBLE) AS {c}" if c.startswith("salary_") and c != "salary_currency" else f"{e} AS {c}"

    return (
        _with(V, D1, D2, fact_cte("f1", "d1"), fact_cte("f2", "d2"))
        + "SELECT "
        + ", ".join(pick(c) for c in FACT_COLS)
        + "\nFROM (SELECT *, 1 AS p FROM f1) t FULL OUTER JOIN (SELECT *, 1 AS p FROM f2) s"
        " ON t.vacancy_id = s.vacancy_id"
    )


CUR_MERGE = (
    _with(V, D1, D2)
    + f"""SELECT COALESCE(t.currency_id, s.currency_id) AS currency_id,
  CAST(CASE WHEN s.p IS NOT NULL AND (t.p IS NULL OR t.rate6 <> s.rate6) THEN s.rate6 ELSE t.rate6 END AS DOUBLE)
    / 1000000 AS to_rub
FROM (SELECT DISTINCT salary_currency AS currency_id,
        CASE WHEN salary_currency = 'USD' THEN 80000000 WHEN salary_currency = 'EUR' THEN 100000000
             ELSE {rate6_case('salary_currency')} END AS rate6, 1 AS p FROM d1) t
FULL OUTER JOIN (SELECT DISTINCT salary_currency AS currency_id, {rate6_case('salary_currency')} AS rate6,
        1 AS p FROM d2) s
  ON t.currency_id = s.currency_id"""
)

DUP = """dup AS (
  SELECT * FROM v UNION ALL SELECT * REPLACE (salary_to + 1 AS salary_to) FROM v
)"""

EMP1 = "emp1 AS (SELECT DISTINCT employer_id FROM d1 WHERE employer_id IS NOT NULL)"

LIMITS = [
    ("vacancy_name", 255), ("employer_name", 255), ("experience_id", 255),
    ("experience_name", 255), ("area_name", 255), ("salary_currency", 10),
]
LONG = """ln AS (
  SELECT * REPLACE (
    CASE WHEN employer_name IS NOT NULL
      THEN repeat(employer_name || ' ', CAST(id % 20 AS INTEGER)) || employer_name END AS employer_name)
  FROM v
)"""

# --------------------------------------------------------------- ingest
# Items as the loader sees them: archived only as the JSON string "true"
# (even keys among the archived), area guarded by the experience keys.
NORM = """n AS (
  SELECT id, vacancy_name, published_at, is_archive AND id % 2 = 0 AS is_archive, is_open,
    employer_id, employer_name, is_accredited_it_employer, experience_id, experience_name,
    CASE WHEN experience_id IS NOT NULL THEN area_id END AS area_id,
    CASE WHEN experience_name IS NOT NULL THEN area_name END AS area_name,
    CAST(salary_from AS DOUBLE) AS salary_from, CAST(salary_to AS DOUBLE) AS salary_to,
    salary_currency, is_gross
  FROM v
)"""
NORM_EXACT = NORM.replace(
    "CAST(salary_from AS DOUBLE) AS salary_from, CAST(salary_to AS DOUBLE) AS salary_to", "salary_from, salary_to"
)
# Each item on page floor(id/100); positions >= 95 again on the next page.
PAGED = """pg AS (
  SELECT CAST(floor(id / 100) AS INTEGER) AS page, * FROM v
  UNION ALL
  SELECT CAST(floor(id / 100) AS INTEGER) + 1 AS page, * FROM v WHERE id % 100 >= 95
)"""
# The searched phrases.
PHRASES = ["Data Engineer", "Дата Инженер", "Инженер данных", "Аналитик данных", "Data Analyst", "Data scientist",
           "Исследователь данных"]
RUNS = "runs AS (SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS date_start FROM orders)"

SQL: dict[str, str] = {
    "ingest_flatten_pages": _with(V, PAGED)
    + "SELECT page, CAST(id AS VARCHAR) AS id, vacancy_name AS name,"
    " strftime(published_at, '%Y-%m-%dT%H:%M:%S') || '+0300' AS published_at FROM pg",
    "ingest_normalise": _with(V, NORM) + "SELECT * FROM n UNION ALL SELECT * FROM n WHERE id % 100 >= 95",
    "ingest_distinct": _with(V, NORM) + "SELECT DISTINCT * FROM n",
    "stage_refresh": _with(V, NORM) + "SELECT DISTINCT * FROM n",
    # NULL inner keys are omitted from the items, so an area without id/name
    # is "{}" while experience has its keys; every fifth salary-less item
    # lacks the salary key.
    "chk_required": _with(V, PAGED)
    + "SELECT page, CAST(id AS VARCHAR) AS id, concat_ws(',',"
    " CASE WHEN experience_id IS NOT NULL AND area_id IS NULL THEN 'area.id' END,"
    " CASE WHEN experience_name IS NOT NULL AND area_name IS NULL THEN 'area.name' END,"
    " CASE WHEN salary_currency IS NULL AND id % 5 = 0 THEN 'salary' END) AS missing FROM pg"
    " WHERE (experience_id IS NOT NULL AND area_id IS NULL) OR (experience_name IS NOT NULL AND area_name IS NULL)"
    " OR (salary_currency IS NULL AND id % 5 = 0)",
    "ingest_title_search": _with(V)
    + "SELECT id, vacancy_name FROM v WHERE "
    + " OR ".join(
        f"contains(regexp_replace(lower(vacancy_name), '[ -]+', ' ', 'g'), lower('{p}'))" for p in PHRASES
    ),
    "ingest_lookback": _with(V)
    + "SELECT id, published_at FROM v WHERE published_at >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY",
    "ingest_lookback_daily": _with(V)
    + "SELECT id, published_at FROM v WHERE published_at >= TIMESTAMP '2001-08-01' - INTERVAL 1 DAY",
    "bookmark_probe": _with(RUNS)
    + "SELECT COUNT(*) > 0 AS has_bookmark, CASE WHEN COUNT(*) > 0 THEN 1 ELSE 30 END AS lookback_days"
    " FROM (SELECT 1 FROM runs LIMIT 1) r",
    "bookmark_append": _with(RUNS) + "SELECT date_start FROM runs UNION ALL SELECT TIMESTAMP '2001-08-01'",
    "class_title": _with(V) + f"SELECT id, {role_case('vacancy_name')} AS role FROM v",
    "class_grade": _with(V) + f"SELECT id, {grade_case('vacancy_name')} AS grade FROM v",
    "class_grade_experience": _with(V)
    + f"SELECT id, {exp_case('experience_id')} AS grade_experience FROM v",
    "class_currency_rate": _with(V)
    + f"SELECT id, salary_currency, CAST({rate6_case('salary_currency')} AS DOUBLE) / 1000000 AS to_rub"
    " FROM v",
    "effective_grade": _with(V, FACT)
    + "SELECT vacancy_id, COALESCE(grade, grade_experience) AS effective_grade FROM f",
    "salary_rub": _with(V, FACT, CUR)
    + f"SELECT vacancy_id, {_dbl8('from8')} AS salary_from_rub, {_dbl8('to8')} AS salary_to_rub FROM ({PRICED}) p",
    "dim_area_candidates": _with(V) + "SELECT DISTINCT area_id, area_name FROM v",
    "dim_employer_candidates": _with(V) + "SELECT DISTINCT employer_id, employer_name FROM v",
    "dim_experience_candidates": _with(V) + "SELECT DISTINCT experience_id, experience_name FROM v",
    "dim_currency_candidates": _with(V, CUR)
    + "SELECT currency_id AS salary_currency, CAST(rate6 AS DOUBLE) / 1000000 AS to_rub FROM cur",
    "fact_candidates": _with(V, FACT)
    + "SELECT vacancy_id, vacancy_name, grade, grade_experience, published_at, is_archive, is_open, employer_id,"
    " experience_id, area_id, CAST(salary_from AS DOUBLE) AS salary_from, CAST(salary_to AS DOUBLE) AS salary_to,"
    " is_gross, salary_currency FROM f",
    "agg_salary_avg": _grain_stats([STATS_OUT[f"avg_sal_{s}"] for _, s in GRADES]),
    "agg_salary_min": _grain_stats([STATS_OUT[f"min_sal_{s}"] for _, s in GRADES]),
    "agg_salary_max": _grain_stats([STATS_OUT[f"max_sal_{s}"] for _, s in GRADES]),
    "agg_salary_overall": _grain_stats([STATS_OUT["min_salary"], STATS_OUT["max_salary"]]),
    "agg_salary_by_key": _grain_stats(list(STATS_OUT.values())),
    "salary_ratio": _grain_stats(_ratio_out("")),
    "agg_open_count": _grain_counts(["cnt_vacancy"]),
    "agg_salary_count": _grain_counts(["cnt_vac_salary"]),
    "agg_grade_counts": _grain_counts([c for _, c in COUNTED]),
    "agg_lead_count": _grain_counts(["cnt_lead"]),
    "mart_row_number": _with(V, FACT)
    + "SELECT CAST(ROW_NUMBER() OVER (ORDER BY employer_id ASC NULLS LAST) AS BIGINT) AS id, employer_id,"
    " CAST(SUM(CASE WHEN is_open = TRUE THEN 1 ELSE 0 END) AS BIGINT) AS cnt_vacancy FROM f GROUP BY employer_id",
    **{k: mart_sql(*a) for k, a in MART_ARGS.items()},
    "upsert_dim_area": _dim_merge("area_id", "area_name"),
    "upsert_dim_employer": _dim_merge(
        "employer_id", "employer_name", ",\n  CAST(NULL AS BOOLEAN) AS is_accredited_it_employer"
    ),
    "upsert_dim_employer_exact": _dim_merge(
        "employer_id", "employer_name", ",\n  CAST(NULL AS BOOLEAN) AS is_accredited_it_employer"
    ),
    "upsert_dim_experience": _dim_merge("experience_id", "experience_name"),
    "upsert_dim_currency": CUR_MERGE,
    "upsert_fact_vacancy": _fact_merge(),
    "chk_unique": _with(V, DUP, fact_cte("fd", "dup"))
    + "SELECT vacancy_id, CAST(COUNT(*) AS BIGINT) AS n FROM fd WHERE vacancy_id IS NOT NULL"
    " GROUP BY vacancy_id HAVING COUNT(*) > 1",
    "chk_fk": _with(V, D1, FACT, EMP1)
    + "SELECT vacancy_id, employer_id FROM f WHERE employer_id IS NOT NULL"
    " AND NOT EXISTS (SELECT 1 FROM emp1 WHERE emp1.employer_id = f.employer_id)",
    "fk_set_null": _with(V, D1, FACT, EMP1)
    + "SELECT vacancy_id, CASE WHEN EXISTS (SELECT 1 FROM emp1 WHERE emp1.employer_id = f.employer_id)"
    " THEN employer_id END AS employer_id FROM f",
    "chk_length": _with(V, LONG)
    + "SELECT id, concat_ws(',', "
    + ", ".join(f"CASE WHEN length({c}) > {n} THEN '{c}' END" for c, n in LIMITS)
    + ") AS violations FROM ln WHERE "
    + " OR ".join(f"length({c}) > {n}" for c, n in LIMITS),
    # Dimensions with the first and the day-2 names, keys held twice.
    **{
        f"chk_unique_{name}": _with(V, D2)
        + f"SELECT {key}, CAST(COUNT(*) AS BIGINT) AS n FROM (SELECT DISTINCT {key}, {name}_name FROM v"
        f" UNION ALL SELECT DISTINCT {key}, {name}_name FROM d2) b WHERE {key} IS NOT NULL"
        f" GROUP BY {key} HAVING COUNT(*) > 1"
        for name, key in (("area", "area_id"), ("employer", "employer_id"), ("experience", "experience_id"))
    },
    "chk_unique_currency": _with(V)
    + "SELECT currency_id, CAST(2 AS BIGINT) AS n FROM (SELECT DISTINCT salary_currency AS currency_id FROM v) c"
    " WHERE currency_id IN ('USD', 'EUR')",
    **{
        f"chk_fk_{key}": _with(V, FACT)
        + f"SELECT vacancy_id, {key} FROM f WHERE ascii(CAST({key} AS VARCHAR)) % 2 = 1"
        for key in ("experience_id", "area_id", "salary_currency")
    },
    **{
        f"fk_set_null_{key}": _with(V, FACT)
        + f"SELECT vacancy_id, CASE WHEN ascii(CAST({key} AS VARCHAR)) % 2 = 0 THEN {key} END AS {key} FROM f"
        for key in ("experience_id", "area_id", "salary_currency")
    },
    **{
        f"chk_length_dim_{name}": _with(V)
        + f"SELECT DISTINCT {key}, 'name' AS violations FROM v WHERE {key} IS NOT NULL"
        f" AND length({name}_name) * (ascii(CAST({key} AS VARCHAR)) - 20) > 255"
        for name, key in (("area", "area_id"), ("employer", "employer_id"), ("experience", "experience_id"))
    },
    "chk_length_dim_currency": _with(V)
    + "SELECT DISTINCT repeat(salary_currency, 4) AS currency_id, 'currency_id' AS violations FROM v"
    " WHERE length(salary_currency) * 4 > 10",
    "chk_length_fact": _with(V, FACT)
    + "SELECT vacancy_id, 'salary_currency' AS violations FROM f WHERE length(salary_currency) * (vacancy_id % 5) > 10",
    # The stored star holds what the pages carry: NORM applies, day 1 and 2 as above.
    **{f"stored_{k}": mart_sql(*a, source=(NORM_EXACT,)) for k, a in MART_ARGS.items()},
    "stored_fact_upsert": _fact_merge(),
    # Two loads end in the star of all records; names and functions show that.
    **{f"named_{k}": mart_sql(*MART_ARGS[k], source=(NORM_EXACT,)) for k in ("mart_de_region", "mart_da_employer", "mart_vacancies")},
    "function_mart_region": mart_sql(*MART_ARGS["mart_ds_region"], source=(NORM_EXACT,)),
    "stored_set_null_area": _with(V, NORM_EXACT, fact_cte("f", "n"))
    + "SELECT * REPLACE (CASE WHEN area_id % 5 <> 0 THEN area_id END AS area_id, CAST(salary_from AS DOUBLE) AS salary_from,"
    " CAST(salary_to AS DOUBLE) AS salary_to) FROM f",
}
