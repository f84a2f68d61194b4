from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyroom.operators.staging import (
    best_attempts_since,
    parse_orders,
    stage_events,
    stage_orders,
    stage_orders_since,
    stage_users,
    valid_attempts,
)

from .builders import raw_events, raw_orders, raw_users


def test_users_keep_the_earliest_account_and_its_own_spelling(spark, rows):
    raw = raw_users(
        spark,
        (1, "Jo.Doe@Gmail.com ", "2023-03-01 10:00:00"),
        (2, "jodoe@gmial.com", "2023-02-01 10:00:00"),
        (3, "j.odoe@googlemail.com", "2023-02-01 10:00:00"),
        (4, "ann.b@yaho.com", "2023-01-05 00:00:00"),
        (5, "annb@yahoo.com", "2023-01-06 00:00:00"),
    )
    assert rows(stage_users(raw), "user_id", "email") == [
        (2, "jodoe@gmial.com"),
        (4, "ann.b@yaho.com"),
        (5, "annb@yahoo.com"),
    ]


def test_users_without_signup_are_dropped_before_ranking(spark, rows):
    raw = raw_users(
        spark, (1, "a@x.com", ""), (2, "a@x.com", "2023-01-01 00:00:00"), (3, "b@x.com", None), (4, "c@x.com", "  ")
    )
    assert rows(stage_users(raw), "user_id") == [(2,)]


def test_users_blank_country_and_utc_signup(spark):
    row = stage_users(raw_users(spark, (1, "a@x.com", " 2023-06-30 23:30:00 ", "  "))).first()
    assert row.country is None
    assert row.signup_date == date(2023, 6, 30)
    assert row.asDict().keys() == {"user_id", "first_name", "last_name", "email", "country", "signup_at", "signup_date"}
    stamp = stage_users(raw_users(spark, (1, "a@x.com", "2023-06-30 23:30:00"))).select(F.unix_seconds("signup_at")).first()[0]
    assert stamp == 1688167800


def test_users_with_null_email_are_one_group(spark, rows):
    raw = raw_users(spark, (1, None, "2023-02-01 00:00:00"), (2, None, "2023-01-01 00:00:00"))
    assert rows(stage_users(raw), "user_id") == [(2,)]


def test_orders_prefer_completed_then_latest_then_highest(spark, rows):
    raw = raw_orders(
        spark,
        (1, 7, "2023-01-01T10:00:00Z", "10.00", "Completed "),
        (1, 7, "2023-01-01T11:00:00Z", "99.00", "pending"),
        (2, 7, "2023-01-01T10:00:00Z", "10.00", "pending"),
        (2, 7, "2023-01-01T10:01:00Z", "5.00", "cancelled"),
        (3, 7, "2023-01-01T10:00:00Z", "10.00", "pending"),
        (3, 7, "2023-01-01T10:00:00Z", "11.50", "pending"),
    )
    assert rows(stage_orders(raw), "order_id", "order_value", "order_status") == [
        (1, Decimal("10.00"), "completed"),
        (2, Decimal("5.00"), "cancelled"),
        (3, Decimal("11.50"), "pending"),
    ]


def test_orders_filter_amounts_before_ranking(spark, rows):
    raw = raw_orders(
        spark,
        (1, 7, "2023-01-01T10:00:00Z", "0.00", "completed"),
        (1, 7, "2023-01-01T09:00:00Z", "4.00", "pending"),
        (2, 7, "2023-01-01T10:00:00Z", "-3.00", "completed"),
        (3, 7, "2023-01-01T10:00:00Z", None, "completed"),
    )
    assert rows(stage_orders(raw), "order_id", "order_value") == [(1, Decimal("4.00"))]


def test_orders_undated_attempt_counts_as_latest(spark, rows):
    raw = raw_orders(
        spark, (1, 7, "2023-01-01T10:00:00Z", "9.00", "pending"), (1, 7, None, "4.00", "pending")
    )
    assert rows(stage_orders(raw), "order_value") == [(Decimal("4.00"),)]


def test_orders_accept_either_amount_name(spark, rows):
    raw = raw_orders(spark, (1, 7, "2023-01-01T10:00:00Z", "9.00", "pending"))
    assert rows(stage_orders(raw)) == rows(stage_orders(raw.withColumnRenamed("order_amount", "order_value")))


def test_order_date_is_the_date_as_written(spark):
    row = stage_orders(raw_orders(spark, (1, 7, "2023-01-01T23:30:00-05:00", "9.00", "pending"))).first()
    assert row.order_date == date(2023, 1, 1)


def test_orders_result_does_not_depend_on_input_order(spark, rows):
    data = [(i % 5, i, f"2023-01-0{i % 3 + 1}T00:00:00Z", "5.00", ["pending", "returned"][i % 2]) for i in range(40)]
    assert rows(stage_orders(raw_orders(spark, *data))) == rows(stage_orders(raw_orders(spark, *reversed(data)).repartition(7)))


@pytest.mark.parametrize("text", ["yesterday", "", "2023-02-30T00:00:00Z"])
def test_bad_date_fails_the_job(spark, text):
    with pytest.raises(PySparkException):
        stage_orders(raw_orders(spark, (1, 7, text, "9.00", "pending"))).collect()
    with pytest.raises(PySparkException):
        stage_events(raw_events(spark, (1, 5, "s", "purchase", text))).collect()


def test_spaces_around_times_are_harmless(spark):
    assert stage_orders(raw_orders(spark, (1, 7, " 2023-01-01T10:00:00Z ", "9.00", "pending"))).first().order_date == date(2023, 1, 1)
    assert stage_events(raw_events(spark, (1, 5, "s", "purchase", " 2023-01-01 10:00:00 "))).first().event_at == datetime(2023, 1, 1, 10)


def test_orders_since_equals_full_staging(spark, rows):
    """Attempts straddle the cut in both directions."""
    raw = raw_orders(
        spark,
        (1, 7, "2023-01-09T23:59:00Z", "9.00", "completed"),  # old attempt wins
        (1, 7, "2023-01-10T00:01:00Z", "9.00", "pending"),
        (2, 7, "2023-01-09T23:59:00Z", "9.00", "pending"),  # new attempt wins
        (2, 7, "2023-01-10T00:01:00Z", "9.00", "pending"),
        (3, 7, "2023-01-11T00:00:00Z", "9.00", "completed"),
        (4, 7, "2023-01-01T00:00:00Z", "9.00", "completed"),
        (None, 7, "2023-01-12T00:00:00Z", "9.00", "pending"),
        (None, 7, "2023-01-01T00:00:00Z", "9.00", "completed"),
    )
    since = date(2023, 1, 10)
    expected = rows(stage_orders(raw).filter(F.col("order_date") >= F.lit(since)))
    assert rows(stage_orders_since(raw, since)) == expected
    assert [r[0] for r in expected] == [2, 3]


def test_orders_since_reads_and_shuffles_only_what_it_touches(spark, tmp_path):
    log = str(tmp_path / "log")
    raw = raw_orders(
        spark, (10, 7, "2023-01-09T00:00:00Z", "9.00", "completed"), (20, 7, "2023-01-10T00:00:00Z", "9.00", "completed")
    )
    valid_attempts(parse_orders(raw)).write.parquet(log)
    staged = best_attempts_since(spark.read.parquet(log), date(2023, 1, 10))
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "In(order_id, [20])" in plan or "EqualTo(order_id,20)" in plan
    assert [r.order_id for r in staged.collect()] == [20]


def test_many_recent_orders_are_joined_within_their_range(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr("tallyroom.operators.staging.NAMED_IDS", 1)
    log = str(tmp_path / "log")
    days = [(n, 7, f"2023-01-{9 + n // 10:02d}T00:00:00Z", "9.00", "completed") for n in (5, 12, 15, 18)]
    valid_attempts(parse_orders(raw_orders(spark, *days))).write.parquet(log)
    staged = best_attempts_since(spark.read.parquet(log), date(2023, 1, 10))
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "GreaterThanOrEqual(order_id,12)" in plan and "LessThanOrEqual(order_id,18)" in plan
    assert [r[0] for r in rows(staged, "order_id")] == [12, 15, 18]


def test_orders_since_with_nothing_recent(spark):
    raw = raw_orders(spark, (10, 7, "2023-01-09T00:00:00Z", "9.00", "completed"), (None, 7, "2023-01-08T00:00:00Z", "9.00", "completed"))
    assert stage_orders_since(raw, date(2023, 1, 10)).isEmpty()


def test_events_need_user_and_session_and_keep_repeats(spark, rows):
    raw = raw_events(
        spark,
        (1, 5, "s", " Page_View", "2023-01-01 23:59:59.25", " Mobile "),
        (1, 5, "s", " Page_View", "2023-01-01 23:59:59.25", " Mobile "),
        (2, None, "s", "purchase", "2023-01-01 10:00:00"),
        (3, 5, None, "purchase", "2023-01-01 10:00:00"),
    )
    staged = stage_events(raw)
    assert staged.schema["event_at"].dataType.typeName() == "timestamp_ntz"
    expected = (1, "page_view", datetime(2023, 1, 1, 23, 59, 59, 250000), date(2023, 1, 1), "mobile")
    assert rows(staged, "event_id", "event_name", "event_at", "event_date", "device_type") == [expected, expected]


def test_event_time_ignores_an_offset(spark):
    row = stage_events(raw_events(spark, (1, 5, "s", "purchase", "2023-01-01T10:00:00+05:00"))).first()
    assert row.event_at == datetime(2023, 1, 1, 10)


def test_first_attempt_is_pruned_before_the_shuffle(spark):
    raw = raw_orders(spark, (1, 7, "2023-01-01T10:00:00Z", "9.00", "pending"))
    plan = stage_orders(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_typed_feeds_need_no_text(spark, rows):
    text = raw_orders(spark, (1, 7, "2023-01-01T10:00:00Z", "9.00", "pending"))
    typed = text.withColumn("order_date", F.col("order_date").cast("timestamp"))
    assert rows(stage_orders(typed)) == rows(stage_orders(text))
