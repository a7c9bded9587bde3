"""Classification rules (FIXTURES §3.3) and the rouble rates."""

from decimal import Decimal

from pyspark.sql import functions as F

from jobsight.functions.classify import effective_grade, grade, grade_from_experience, rate_to_rub, role

GOLDEN = [
    # title, experience_id, role, grade, grade_experience, effective
    ("Junior Data Engineer", "moreThan6", "Инженер данных", "Junior", "Senior", "Junior"),
    ("СТАРШИЙ ДАТА ИНЖЕНЕР", "noExperience", "Инженер данных", None, "Intern", "Intern"),
    ("Старший аналитик данных", None, "Аналитик данных", "Middle", None, "Middle"),
    ("Стажёр data scientist", None, "Data scientist", None, None, None),
    ("Data Engineer / Data Analyst", "between3And6", "Инженер данных", None, "Middle", "Middle"),
    ("Junior/Senior Data Analyst", None, "Аналитик данных", "Junior", None, "Junior"),
    ("Team Lead Data Scientist", "between1And3", "Data scientist", "Team Lead", "Junior", "Team Lead"),
    ("Python developer", "between1And3", None, None, "Junior", "Junior"),
]


def test_golden_classification(spark):
    df = spark.createDataFrame([(t, e) for t, e, *_ in GOLDEN], "title string, exp string")
    out = df.select(
        "title",
        role("title").alias("role"),
        grade("title").alias("grade"),
        grade_from_experience("exp").alias("ge"),
    ).withColumn("eff", effective_grade("grade", "ge"))
    got = {r["title"]: (r["role"], r["grade"], r["ge"], r["eff"]) for r in out.collect()}
    for title, _, r, g, ge, eff in GOLDEN:
        assert got[title] == (r, g, ge, eff), title


def test_rates(spark):
    df = spark.createDataFrame([("RUR",), ("USD",), ("KZT",), ("BYR",), ("EUR",), (None,)], "c string")
    out = dict(df.select("c", rate_to_rub("c").alias("r")).collect())
    assert out == {
        "RUR": Decimal("1.000000"),
        "USD": Decimal("90.000000"),
        "KZT": Decimal("0.200000"),
        "BYR": Decimal("28.700000"),
        "EUR": None,
        None: None,
    }
    assert df.select(rate_to_rub("c")).schema[0].dataType.simpleString() == "decimal(12,6)"


def test_grade_is_case_sensitive_and_ordered(spark):
    df = spark.createDataFrame([("junior data engineer",), ("Старший Senior",), ("Стажёр",)], "t string")
    got = [r[0] for r in df.select(grade("t")).collect()]
    assert got == [None, "Middle", None]


def test_role_first_match_wins(spark):
    df = spark.createDataFrame([("Data Analyst / Data Engineer",)], "t string")
    assert df.select(role(F.col("t"))).first()[0] == "Инженер данных"
