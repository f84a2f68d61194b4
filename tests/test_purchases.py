from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tallyroom.operators.purchases import user_first_purchase
from tallyroom.operators.staging import stage_orders

from .builders import raw_orders, staged_orders, staged_users


def test_first_purchase_and_lifetime_value(spark, rows):
    users = staged_users(spark, (1, "2023-01-01"), (2, "2023-01-01"), (3, "2023-01-01"))
    orders = staged_orders(
        spark,
        (11, 1, "2023-02-02", "5.00", "completed"),
        (10, 1, "2023-02-02", "7.00", "completed"),
        (9, 1, "2023-02-01", "100.00", "pending"),
        (12, 1, "2023-03-01", "1.50", "completed"),
        (13, 2, "2023-01-05", "2.00", "returned"),
        (14, 99, "2023-01-05", "2.00", "completed"),
    )
    got = rows(
        user_first_purchase(users, orders),
        "user_id", "first_purchase_date", "first_purchase_order_id", "first_purchase_value",
        "total_orders_count", "total_lifetime_value", "has_purchased",
    )
    assert got == [
        (1, date(2023, 2, 2), 10, Decimal("7.00"), 3, Decimal("13.50"), True),
        (2, None, None, None, 0, Decimal("0.00"), False),
        (3, None, None, None, 0, Decimal("0.00"), False),
    ]


def test_undated_order_ranks_last(spark):
    users = staged_users(spark, (1, "2023-01-01"))
    orders = staged_orders(spark, (5, 1, None, "9.00", "completed"), (6, 1, "2023-05-01", "3.00", "completed"))
    row = user_first_purchase(users, orders).first()
    assert (row.first_purchase_order_id, row.first_purchase_value) == (6, Decimal("3.00"))


def test_only_undated_orders(spark):
    users = staged_users(spark, (1, "2023-01-01"))
    row = user_first_purchase(users, staged_orders(spark, (5, 1, None, "9.00", "completed"))).first()
    assert (row.first_purchase_order_id, row.first_purchase_at, row.has_purchased, row.total_orders_count) == (5, None, False, 1)


def test_orders_are_shuffled_once_by_user_and_without_python(spark):
    raw = raw_orders(spark, (1, 7, "2023-01-01T10:00:00Z", "9.00", "completed"))
    plan = user_first_purchase(staged_users(spark, (7, "2023-01-01")), stage_orders(raw))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate [user_id") == 1 and text.count("Join") == 1
    assert "Python" not in text


def test_matches_two_pass_definition(spark, rows):
    """One aggregation against the literal definition: rank the orders, aggregate them, join both."""
    users = staged_users(spark, *[(u, "2023-01-01") for u in range(20)])
    data = [(i, i * 7 % 23, f"2023-0{i % 6 + 1}-1{i % 4}", f"{i % 9 + 1}.25", ["completed", "pending"][i % 3 == 0]) for i in range(300)]
    orders = staged_orders(spark, *data)
    orders.createOrReplaceTempView("o")
    users.createOrReplaceTempView("u")
    expected = spark.sql(
        """
        with c as (select * from o where order_status = 'completed'),
        r as (select *, row_number() over (partition by user_id order by ordered_at asc nulls last, order_id asc nulls last) n from c),
        a as (select user_id, count(order_id) k, sum(order_value) v, min(ordered_at) t, min(order_date) d from c group by user_id)
        select u.user_id, a.t, a.d, r.order_id, r.order_value, coalesce(k, 0), cast(coalesce(v, 0) as decimal(24,2))
        from u left join a on a.user_id = u.user_id left join r on r.user_id = u.user_id and r.n = 1
        """
    )
    got = user_first_purchase(users, orders).select(
        "user_id", "first_purchase_at", "first_purchase_date", "first_purchase_order_id", "first_purchase_value",
        "total_orders_count", F.col("total_lifetime_value"),
    )
    assert rows(got) == rows(expected)


def test_users_without_an_id_stay_out_of_the_join(spark, tiny_skew_limits, final_plan):
    """A third of the users have no id; none of them matches an order, so they are not shuffled for it."""
    users = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("user_id"),
        F.col("id").cast("timestamp").alias("signup_at"),
        F.lit("2023-01-01").cast("date").alias("signup_date"),
    )
    orders = spark.range(0, 3_000, 1, 4).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("user_id"),
        F.col("id").cast("timestamp").alias("ordered_at"),
        F.lit("2023-02-01").cast("date").alias("order_date"),
        F.lit("1.00").cast("decimal(12,2)").alias("order_value"),
        F.lit("completed").alias("order_status"),
    )
    result = user_first_purchase(users, orders)
    collected = result.collect()
    assert len(collected) == 60_000
    assert sum(r.has_purchased for r in collected) == 1_000
    assert not any(r.has_purchased for r in collected if r.user_id is None)
    plan = final_plan(result)
    assert "Union" in plan and plan.count("Exchange hashpartitioning(user_id") == 2
