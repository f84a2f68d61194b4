from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyroom.operators import quality as q
from tallyroom.operators.purchases import user_first_purchase
from tallyroom.operators.revenue import daily_revenue
from tallyroom.plans.checks import NOT_NULL_COLUMNS, UNIQUE_COLUMN, accepted_checks, not_null_checks

from .builders import revenue_mart, staged_orders, staged_users


def test_unique_ignores_null(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(q.unique(df, "k")) == [(1, 2)]


def test_not_null_and_accepted_values(spark, rows):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None), (3, "z")], "k int, v string")
    assert q.not_null(df, ["k", "v"]).count() == 2
    assert rows(q.accepted_values(df, "v", ["a", "b"])) == [(3, "z")]


def test_session_duration_rule(spark):
    df = spark.createDataFrame([(0,), (86400,), (86401,), (-1,), (None,)], "session_duration_seconds int")
    assert sorted(r[0] for r in q.violations(df, q.session_duration_rule()).collect()) == [-1, 86401]


def test_purchase_at_the_signup_instant_is_a_violation(spark, rows):
    users = staged_users(spark, (1, "2023-01-05"), (2, "2023-01-05"), (3, "2023-01-05"))
    noon = [(1, "2023-01-06"), (2, "2023-01-05"), (3, "2023-01-04")]
    orders = staged_orders(spark, *[(u, u, d, "1.00", "completed") for u, d in noon])
    first = user_first_purchase(users, orders)
    assert rows(q.purchase_before_signup(first, users), "user_id") == [(3,)]
    same = first.withColumn("first_purchase_at", F.when(F.col("user_id") == 2, F.col("signup_at")).otherwise(F.col("first_purchase_at")))
    assert rows(q.purchase_before_signup(same, users), "user_id") == [(2,), (3,)]


def test_a_repeated_user_id_does_not_multiply_violations(spark):
    users = staged_users(spark, (1, "2023-01-05"), (1, "2023-01-09"), (1, "2023-02-01"))
    orders = staged_orders(spark, (1, 1, "2023-01-06", "1.00", "completed"))
    first = user_first_purchase(users, orders)
    assert first.count() == 3
    assert q.purchase_before_signup(first, users).count() == 3


def test_first_purchase_must_be_completed(spark, rows):
    users = staged_users(spark, (1, "2023-01-01"), (2, "2023-01-01"))
    orders = staged_orders(spark, (1, 1, "2023-01-06", "1.00", "completed"), (2, 2, "2023-01-06", "1.00", "completed"))
    first = user_first_purchase(users, orders)
    assert q.first_purchase_not_completed(first, orders).isEmpty()
    later = orders.withColumn("order_status", F.when(F.col("order_id") == 2, "returned").otherwise(F.col("order_status")))
    assert rows(q.first_purchase_not_completed(first, later), "user_id", "order_status") == [(2, "returned")]


def test_revenue_and_retention_ranges(spark):
    mart = revenue_mart(spark, ("2023-01-01", "-1.00", 1, 1, "1.00"), ("2023-01-02", "1.00", 1, 1, "-0.01"), ("2023-01-03", "0.00", 0, 0, "0.00"))
    assert q.violations(mart, q.revenue_negative_rule()).count() == 2
    pct = spark.createDataFrame([(Decimal("0.00"),), (Decimal("100.00"),), (Decimal("100.01"),), (Decimal("-0.01"),)], "retention_pct decimal(9,2)")
    assert q.violations(pct, q.retention_range_rule()).count() == 2


@pytest.mark.parametrize("column, value", [("total_revenue", "9.99"), ("order_count", "7"), ("distinct_user_count", "7"), ("average_order_value", "9.99")])
def test_reconciliation_sees_each_measure(spark, rows, column, value):
    orders = staged_orders(spark, (1, 1, "2023-01-01", "1.00", "completed"), (2, 2, "2023-01-02", "1.00", "pending"))
    mart = daily_revenue(orders)
    assert q.revenue_mismatches(mart, orders).isEmpty()
    kind = dict(mart.dtypes)[column]
    wrong = mart.withColumn(column, F.when(F.col("order_date") == F.lit(date(2023, 1, 1)), F.lit(value).cast(kind)).otherwise(F.col(column)))
    assert rows(q.revenue_mismatches(wrong, orders), "order_date") == [(date(2023, 1, 1),)]


def test_reconciliation_sees_missing_and_surplus_days(spark, rows):
    orders = staged_orders(spark, (1, 1, "2023-01-01", "1.00", "completed"), (2, 1, None, "5.00", "completed"))
    surplus = daily_revenue(orders).unionByName(revenue_mart(spark, ("2023-02-01", "3.00", 1, 1, "3.00"), ("2023-02-02", "0.00", 0, 0, "0.00")))
    assert rows(q.revenue_mismatches(surplus, orders), "order_date") == [(date(2023, 2, 1),)]
    assert rows(q.revenue_mismatches(surplus.limit(0), orders), "order_date") == [(date(2023, 1, 1),)]


def test_funnel_monotonic(spark, rows):
    def funnel(*counts):
        return spark.createDataFrame(list(zip(["page_view", "add_to_cart", "purchase"], counts)), "funnel_step string, session_count bigint")

    assert q.funnel_increases(funnel(3, 3, 1)).isEmpty()
    assert rows(q.funnel_increases(funnel(3, 4, 1))) == [(3, 4, 1)]
    assert rows(q.funnel_increases(funnel(3, 1, 2))) == [(3, 1, 2)]


def test_run_checks_reports_every_check(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    checks = [q.unique_check("t", df, "k"), *q.not_null_rules("t", ["k", "v"]), q.accepted_values_rule("t", "v", ["b"])]
    assert rows(q.run_checks({"t": df}, checks)) == [
        ("accepted_values", "t", "v", 1, False),
        ("not_null", "t", "k", 0, True),
        ("not_null", "t", "v", 1, False),
        ("unique", "t", "k", 1, False),
    ]
    with pytest.raises(ValueError):
        q.run_checks({}, q.not_null_rules("missing", ["k"]))


def test_row_rules_share_one_scan(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    plan = q.run_checks({"t": df}, q.not_null_rules("t", ["k", "v"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_suite_size():
    assert len(UNIQUE_COLUMN) == 6
    assert sum(len(c) for c in NOT_NULL_COLUMNS.values()) == len(not_null_checks()) == 53
    assert len(accepted_checks()) == 1


def test_compare_frames(spark, rows):
    left = spark.createDataFrame([(1, 2, 3), (2, None, 3), (3, 1, 1), (None, 1, 1), (5, 1, 1)], "k int, a int, b int")
    right = spark.createDataFrame([(1, 2, 4), (2, None, 3), (4, 1, 1), (None, 1, 1), (5, None, 2)], "k int, a int, b int")
    assert rows(q.compare_frames(left, right, ["k"])) == [
        (1, ["b"]), (3, ["missing right"]), (4, ["missing left"]), (5, ["a", "b"]),
    ]
    assert q.compare_frames(left, left, ["k"]).isEmpty()
    with pytest.raises(ValueError):
        q.compare_frames(left, right.drop("b"), ["k"])


def test_null_first_purchase_time_is_not_blindly_passed(spark):
    first = spark.createDataFrame([(1, date(2023, 1, 1), None)], "user_id bigint, first_purchase_date date, first_purchase_at timestamp")
    users = staged_users(spark, (1, "2023-01-05"))
    assert q.purchase_before_signup(first, users).isEmpty()
    assert q.not_null(first, ["first_purchase_at"]).count() == 1
    assert isinstance(first.first().first_purchase_date, date) and not isinstance(first.first().first_purchase_date, datetime)
