"""Declared schemas of every dataset (see FIXTURES.md §1).

Money is DECIMAL(18,2), rates DECIMAL(12,6): a bare DECIMAL in Spark is
(10,0) and would round salaries to whole units. Ids are BIGINT so a
growing id space cannot overflow; ``area_id`` stays INT (a small code list).
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(12, 6)

# A landed API page. Items stay VARIANT so that key presence (absent vs JSON
# null) and JSON types (boolean true vs string "true") remain visible.
PAGE = T.StructType(
    [
        T.StructField("page", T.IntegerType()),
        T.StructField("pages", T.IntegerType()),
        T.StructField("found", T.LongType()),
        T.StructField("items", T.ArrayType(T.VariantType())),
    ]
)

STAGING = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("vacancy_name", T.StringType()),
        T.StructField("published_at", T.TimestampNTZType()),
        T.StructField("is_archive", T.BooleanType(), False),
        T.StructField("is_open", T.BooleanType(), False),
        T.StructField("employer_id", T.LongType()),
        T.StructField("employer_name", T.StringType()),
        T.StructField("is_accredited_it_employer", T.BooleanType(), False),
        T.StructField("experience_id", T.StringType()),
        T.StructField("experience_name", T.StringType()),
        T.StructField("area_id", T.IntegerType()),
        T.StructField("area_name", T.StringType()),
        T.StructField("salary_from", MONEY),
        T.StructField("salary_to", MONEY),
        T.StructField("salary_currency", T.StringType()),
        T.StructField("is_gross", T.BooleanType(), False),
    ]
)

DIM_AREA = T.StructType([T.StructField("area_id", T.IntegerType()), T.StructField("name", T.StringType())])

DIM_EMPLOYER = T.StructType(
    [
        T.StructField("employer_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("is_accredited_it_employer", T.BooleanType()),
    ]
)

DIM_EXPERIENCE = T.StructType(
    [T.StructField("experience_id", T.StringType()), T.StructField("name", T.StringType())]
)

DIM_CURRENCY = T.StructType([T.StructField("currency_id", T.StringType()), T.StructField("to_rub", RATE)])

FACT_VACANCY = T.StructType(
    [
        T.StructField("vacancy_id", T.LongType()),
        T.StructField("vacancy_name", T.StringType()),
        T.StructField("grade", T.StringType()),
        T.StructField("grade_experience", T.StringType()),
        T.StructField("published_at", T.TimestampNTZType()),
        T.StructField("is_archive", T.BooleanType()),
        T.StructField("is_open", T.BooleanType()),
        T.StructField("employer_id", T.LongType()),
        T.StructField("experience_id", T.StringType()),
        T.StructField("area_id", T.IntegerType()),
        T.StructField("salary_from", MONEY),
        T.StructField("salary_to", MONEY),
        T.StructField("is_gross", T.BooleanType()),
        T.StructField("salary_currency", T.StringType()),
    ]
)

# Run log: one row per completed staging load.
SETUP = T.StructType([T.StructField("date_start", T.TimestampNTZType())])

# Declared VARCHAR bounds of the reference tables, checked as data (Q4).
VARCHAR_LIMITS = {
    "staging": {
        "vacancy_name": 255,
        "employer_name": 255,
        "experience_id": 255,
        "experience_name": 255,
        "area_name": 255,
        "salary_currency": 10,
    },
    "dim_area": {"name": 255},
    "dim_employer": {"name": 255},
    "dim_experience": {"experience_id": 255, "name": 255},
    "dim_currency": {"currency_id": 10},
    "fact_vacancy": {
        "vacancy_name": 255,
        "grade": 20,
        "grade_experience": 20,
        "experience_id": 255,
        "salary_currency": 10,
    },
}
