"""Exact half-away-from-zero rounding of quotients and averages."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobsight.functions.money import avg_from_units, ratio, round_quotient, to_units


def _half_away(n: int, d: int, digits: int = 2) -> Decimal:
    return (Decimal(n) / Decimal(d)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)


def test_ties_round_away_from_zero(spark):
    cases = [(2675, 1000), (-2675, 1000), (2674, 1000), (1, 3), (-1, 3), (5, 1000), (-5, 1000), (0, 7)]
    df = spark.createDataFrame(cases, "n long, d long")
    got = [r[0] for r in df.select(round_quotient(F.col("n"), F.col("d"))).collect()]
    assert got == [_half_away(n, d) for n, d in cases]
    assert got[0] == Decimal("2.68") and got[1] == Decimal("-2.68")


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(1, 10**9)), min_size=1, max_size=20))
def test_round_quotient_matches_python_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(round_quotient(F.col("n"), F.col("d"))).collect()]
    assert got == [_half_away(n, d) for n, d in pairs]


def test_avg_near_half_cent_is_not_double_rounded(spark):
    # mean = 0.004999975: AVG over DECIMAL(18,2) rounds it to scale 6 (0.005000) first and
    # then to 0.01; the exact rule gives 0.00.
    n = 400_000
    values = [Decimal("0.01")] * (n // 2 - 1) + [Decimal("0.00")] * (n // 2 + 1)
    total = sum(values)
    df = spark.createDataFrame([(total, n)], "s decimal(38,2), n long")
    got = df.select(avg_from_units(to_units(F.col("s")), F.col("n"))).first()[0]
    assert got == _half_away(int(total * 100), n * 100)
    assert got == Decimal("0.00")


def test_ratio_and_zero_divisor(spark):
    df = spark.createDataFrame([(Decimal("150.00"), Decimal("200"))], "a decimal(38,2), m decimal(31,8)")
    assert df.select(ratio(F.col("a"), F.col("m"))).first()[0] == Decimal("0.75")
    zero = spark.createDataFrame([(Decimal("1.00"), Decimal("0"))], "a decimal(38,2), m decimal(31,8)")
    try:
        zero.select(ratio(F.col("a"), F.col("m"))).collect()
    except Exception as e:  # noqa: BLE001
        assert "DIVIDE_BY_ZERO" in str(e) or "zero" in str(e).lower()
    else:
        raise AssertionError("a zero maximum must raise")
