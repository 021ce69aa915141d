from datetime import datetime
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bazaarframe.functions.exact import divide_half_up, duration_days, duration_micros, exact_avg, exact_pct, mean_score
from bazaarframe.functions.predicates import in_period, in_state
from bazaarframe.functions.text import brl_text, comma_text, fixed_text, int_text


def half_up(value: Fraction) -> int:
    sign = -1 if value < 0 else 1
    return sign * ((2 * abs(value.numerator) + value.denominator) // (2 * value.denominator))


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "values, mean",
    [
        (["10.00", "10.01"], "10.01"),
        (["-10.00", "-10.01"], "-10.01"),
        (["0.01", "0.00", "0.00"], "0.00"),
        (["9999999999.99", "9999999999.98"], "9999999999.99"),
        (["1.00", None], "1.00"),
        ([None], None),
    ],
)
def test_exact_avg_rounds_half_away_from_zero(spark, values, mean):
    df = spark.createDataFrame([(Decimal(v) if v else None,) for v in values], "v decimal(12,2)")
    got = df.agg(exact_avg(F.sum("v"), F.count("v")).alias("m")).first()["m"]
    assert got == (Decimal(mean) if mean else None)


def test_exact_pct(spark):
    assert one(spark, exact_pct(F.lit(1), F.lit(3))) == Decimal("33.33")
    assert one(spark, exact_pct(F.lit(2), F.lit(3))) == Decimal("66.67")
    assert one(spark, exact_pct(F.lit(1), F.lit(0))) is None
    assert one(spark, exact_pct(F.lit(-1), F.lit(8))) == Decimal("-12.50")
    money = [F.lit(v).cast("decimal(22,2)") for v in ("0.01", "8.00")]
    assert one(spark, exact_pct(*money, part_scale=2)) == Decimal("0.13")


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-(10**24), 10**24), st.integers(1, 10**12)), min_size=1, max_size=20))
def test_divide_half_up_equals_fractions(spark, pairs):
    pairs = [(n, d) for n, d in pairs if abs(n // d) < 10**15] or [(1, 3)]
    df = spark.createDataFrame([(Decimal(n), Decimal(d)) for n, d in pairs], "n decimal(38,0), d decimal(38,0)")
    got = [tuple(r) for r in df.select("n", "d", divide_half_up(F.col("n"), F.col("d"), 2)).collect()]
    assert [r[2] for r in got] == [half_up(Fraction(int(r[0]) * 100, int(r[1]))) for r in got]


def test_mean_score_keeps_sixteen_digits(spark):
    df = spark.createDataFrame([(1, 3), (1, 4), (1, 4), (2, None), (3, 5)], "k int, s int")
    got = {r["k"]: r["m"] for r in df.groupBy("k").agg(mean_score(F.col("s")).alias("m")).collect()}
    assert got == {1: Decimal("3.6666666666666667"), 2: None, 3: Decimal(5)}


def test_durations_ignore_the_session_zone(spark):
    # This night lost an hour in the zone below.
    df = spark.createDataFrame(
        [(datetime(2018, 11, 3, 12), datetime(2018, 11, 4, 12, 0, 0, 1)), (datetime(2020, 1, 2), datetime(2020, 1, 1)), (None, datetime(2020, 1, 1))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = [tuple(r) for r in df.select(duration_micros(F.col("a"), F.col("b")), duration_days(F.col("a"), F.col("b"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [(86_400_000_001, 86_400_000_001 / 86_400_000_000), (-86_400_000_000, -1.0), (None, None)]


@pytest.mark.parametrize(
    "value, text",
    [
        (999.5, "R$ 999,50"),
        (1000, "R$ 1,0 mil"),
        (1e6, "R$ 1,00 mi"),
        (-2500, "R$ -2,5 mil"),
        (0.125, "R$ 0,12"),
        (1.5e9, "R$ 1500,00 mi"),
        (999999, "R$ 1000,0 mil"),
        (-0.5, "R$ -0,50"),
        (0, "R$ 0,00"),
    ],
)
def test_brl_text(spark, value, text):
    assert one(spark, brl_text(F.lit(float(value)))) == text


def test_number_texts(spark):
    assert one(spark, int_text(F.lit(1234567.9))) == "1.234.567"
    assert one(spark, int_text(F.lit(-1234.9))) == "-1.234"
    assert one(spark, fixed_text(F.lit(1234.125))) == "1234.12"
    assert one(spark, comma_text(F.lit(1234567))) == "1,234,567"
    assert one(spark, comma_text(F.lit(Decimal("1234567.891")), 2)) == "1,234,567.89"


def test_period_includes_the_whole_last_day(spark):
    moments = ["2020-01-01 00:00:00", "2020-01-31 23:59:59.999999", "2020-02-01 00:00:00", "2019-12-31 23:59:59.999999"]
    df = spark.createDataFrame([(datetime.fromisoformat(m),) for m in moments] + [(None,)], "order_purchase_timestamp timestamp_ntz")
    kept = df.where(in_period("2020-01-01", "2020-01-31")).collect()
    assert [r[0].isoformat(" ") for r in kept] == moments[:2]


def test_state_filter(spark):
    df = spark.createDataFrame([("SP",), (None,), ("RJ",)], "customer_state string")
    assert df.where(in_state(None)).count() == 3
    assert df.where(in_state("All states")).count() == 3
    assert [r[0] for r in df.where(in_state("SP")).collect()] == ["SP"]
