from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyroom.functions import (
    blank_to_null,
    canonical_email,
    clean_label,
    mean_to_cents,
    month_number,
    parse_instant,
    percent,
    whole_seconds,
)


@pytest.mark.parametrize(
    "email, expected",
    [
        ("a.b.c@gmail.com", "abc@gmail.com"),
        ("a.b@gmial.com", "ab@gmail.com"),
        ("a.b@googlemail.com", "ab@gmail.com"),
        ("ab@gamil.com", "ab@gmail.com"),
        ("ab@gmai.com", "ab@gmail.com"),
        ("a.b@yaho.com", "a.b@yahoo.com"),
        ("a.b@yahooo.com", "a.b@yahoo.com"),
        ("a@yaho.co", "a@yahoo.com"),
        ("a@hotmial.com", "a@hotmail.com"),
        ("a@hotmal.com", "a@hotmail.com"),
        ("a@outlok.com", "a@outlook.com"),
        ("a@outlookk.com", "a@outlook.com"),
        ("a.b@yahoo.com", "a.b@yahoo.com"),
        ("a.b@corp.example", "a.b@corp.example"),
        ("no-at-sign", "no-at-sign"),
        ("a.b@gmail.com@x", "ab@gmail.com"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_email(spark, email, expected):
    df = spark.createDataFrame([(email,)], "e string")
    assert df.select(canonical_email(F.col("e"))).first()[0] == expected


def test_canonical_email_takes_other_aliases(spark):
    df = spark.createDataFrame([("a.b@exmaple.org",)], "e string")
    column = canonical_email(F.col("e"), {"example.org": ("exmaple.org",)}, dot_blind=("example.org",))
    assert df.select(column).first()[0] == "ab@example.org"


def test_labels_and_blanks(spark):
    df = spark.createDataFrame([("  Ab\t ",), ("   ",), (None,)], "t string")
    assert [r[0] for r in df.select(clean_label(F.col("t"))).collect()] == ["ab\t", "", None]
    assert [r[0] for r in df.select(blank_to_null(F.col("t"))).collect()] == ["Ab\t", None, None]


@pytest.mark.parametrize(
    "part, whole, expected",
    [(1512, 4672, "32.36"), (581, 1512, "38.43"), (581, 4672, "12.44"), (57, 116, "49.14"), (65, 116, "56.03"),
     (2, 116, "1.72"), (0, 5, "0.00"), (3, 0, "0.00"), (5, 5, "100.00"), (1, 800, "0.13"), (10**14, 10**14, "100.00")],
)
def test_percent(spark, part, whole, expected):
    df = spark.createDataFrame([(part, whole)], "a bigint, b bigint")
    assert df.select(percent(F.col("a"), F.col("b"))).first()[0] == Decimal(expected)


def test_mean_rounds_once(spark):
    # 10,000 x 1.01 and 10,001 x 1.00: the mean is 1.00499975, which Spark's own avg rounds up twice.
    df = spark.range(20_001).select(F.when(F.col("id") < 10_000, "1.01").otherwise("1.00").cast("decimal(12,2)").alias("v"))
    assert df.agg(mean_to_cents(F.sum("v"), F.count("v"))).first()[0] == Decimal("1.00")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-(10**12), 10**12), st.integers(0, 10**6)), min_size=1, max_size=200))
def test_mean_matches_exact_decimal(spark, pairs):
    data = [(Decimal(cents).scaleb(-2), n) for cents, n in pairs]
    df = spark.createDataFrame(data, "total decimal(24,2), n bigint")
    got = [r[0] for r in df.select(mean_to_cents(F.col("total"), F.col("n"))).collect()]
    want = [Decimal("0.00") if n == 0 else (total / n).quantize(Decimal("0.01"), ROUND_HALF_UP) for total, n in data]
    assert got == want


@pytest.mark.parametrize(
    "end, seconds",
    [("2024-01-01 00:00:10.6", 11), ("2024-01-01 00:00:10.4", 10), ("2024-01-01 00:00:10.5", 11),
     ("2024-01-03 01:02:03", 176523), ("2023-12-31 23:59:58.5", -2), ("2024-01-01 00:00:00", 0)],
)
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_whole_seconds(spark, end, seconds, kind):
    df = spark.sql(f"select cast('2024-01-01 00:00:00' as {kind}) a, cast('{end}' as {kind}) b")
    assert df.select(whole_seconds(F.col("a"), F.col("b"))).first()[0] == seconds


def test_wall_clock_seconds_ignore_the_session_zone(spark):
    # 2024-03-10 02:00-03:00 does not exist in New York; wall-clock time is unaffected.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp_ntz'2024-03-10 01:30:00' a, timestamp_ntz'2024-03-10 03:30:00' b")
        assert df.select(whole_seconds(F.col("a"), F.col("b"))).first()[0] == 7200
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_month_number_ignores_days(spark):
    df = spark.sql("select date'2022-11-30' a, date'2024-02-01' b")
    assert df.select(month_number(F.col("a"), F.col("b"))).first()[0] == 15


def test_exact_format_rejects_other_text(spark):
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    df = spark.createDataFrame([("2023-01-05T10:00:00Z", "2023-01-05 10:00:00")], "good string, bad string")
    text = df.schema["good"].dataType
    assert df.select(F.unix_seconds(parse_instant(F.col("good"), text, exact_format=iso))).first()[0] == 1672912800
    with pytest.raises(PySparkException):
        df.select(parse_instant(F.col("bad"), text, exact_format=iso)).collect()
