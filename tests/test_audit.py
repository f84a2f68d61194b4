from decimal import Decimal

from pyspark.sql import functions as F

from tallyroom.operators import audit
from tallyroom.operators.staging import parse_orders, parse_users, stage_orders

from .builders import raw_events, raw_orders, raw_users


def users(spark):
    return raw_users(
        spark,
        (1, "a.b@gmail.com", "2023-01-05 00:00:00"),
        (2, "ab@gmial.com", "2023-01-09 00:00:00"),
        (3, "AB@gmail.com", "2023-02-01 00:00:00", ""),
        (4, "c@x.com", ""),
        (5, "d@x.com", "2023-02-01 00:00:00"),
        (6, None, "2023-02-01 00:00:00"),
        (7, None, None),
    )


def orders(spark):
    return raw_orders(
        spark,
        (1, 1, "2023-01-07T10:00:00Z", "5.00", "completed"),  # Saturday
        (1, 1, "2023-01-07T10:00:00Z", "6.00", "pending"),
        (2, 5, "2023-01-08T10:00:00Z", "0.00", "completed"),  # Sunday
        (3, 900, "2023-01-09T10:00:00Z", "5.00", "completed"),
        (3, 900, "2023-01-09T10:00:00Z", "5.00", "completed"),
        (4, None, "2023-01-10T10:00:00Z", "-1.00", "completed"),
        (5, 4, "2023-01-11T10:00:00Z", "2.00", "completed"),
        (5, 4, "2023-01-11T10:00:05Z", None, "completed"),
    )


def events(spark):
    return raw_events(
        spark,
        (1, 1, "s", " Page_View", "2023-01-01 10:00:00"),
        (2, 900, "s", "page_view", "2023-01-01 10:00:00"),
        (3, None, "s", "purchase", "2023-01-01 10:00:00"),
        (4, 4, None, "add_to_cart", "2023-01-01 10:00:00"),
        (5, 4, "t", "error", "2023-01-01 10:00:00"),
    )


def counts(df):
    return {r[0]: (r[1], str(r[2])) for r in df.collect()}


def test_audit_users(spark):
    assert counts(audit.audit_users(users(spark))) == {
        "total_rows": (7, "100.00"),
        "duplicate_accounts": (2, "28.57"),
        "null_signup_date": (2, "28.57"),
        "null_country": (1, "14.29"),
    }


def test_audit_orders(spark):
    assert counts(audit.audit_orders(orders(spark), users(spark))) == {
        "total_rows": (8, "100.00"),
        "orphaned_user": (2, "25.00"),
        "non_positive_value": (2, "25.00"),
        "duplicate_order_ids": (3, "37.50"),
    }


def test_audit_events(spark):
    assert counts(audit.audit_events(events(spark), users(spark))) == {
        "total_rows": (5, "100.00"),
        "orphaned_user": (1, "20.00"),
        "page_view": (2, "40.00"),
        "add_to_cart": (1, "20.00"),
        "purchase": (1, "20.00"),
    }


def test_audits_of_nothing(spark):
    empty = audit.audit_orders(orders(spark).limit(0), users(spark).limit(0))
    assert set(counts(empty).values()) == {(0, "0.00")}


def test_conflict_kinds(spark, rows):
    kinds = audit.duplicate_conflicts(parse_orders(orders(spark)), "order_id", ["order_value", "order_status", "ordered_at"])
    assert [(k, n, str(p)) for k, n, p in rows(kinds)] == [
        ("identical", 1, "33.33"),
        ("order_value + order_status", 1, "33.33"),
        ("order_value + ordered_at", 1, "33.33"),
    ]


def test_conflicts_use_every_row_of_a_key(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (2, None)], "k int, v string")
    assert [r[:2] for r in rows(audit.duplicate_conflicts(df, "k", ["v"]))] == [("identical", 1), ("v", 1)]


def test_duplicates_are_paired_with_their_survivor_only(spark, rows):
    got = audit.duplicate_accounts(users(spark))
    assert rows(got, "account_email", "kept_user_id", "duplicate_user_id") == [("ab@gmail.com", 1, 2), ("ab@gmail.com", 1, 3)]


def test_every_dropped_registration_is_listed(spark, rows):
    """Repeated rows, rows with the kept id and rows without an id are dropped too, and listed."""
    same = (1, "A.b@gmail.com", "2023-01-01 00:00:00")
    raw = raw_users(spark, same, same, (1, "ab@gmail.com", "2023-01-02 00:00:00"), (None, "ab@gmail.com", "2023-01-01 00:00:00"), (2, "x@y.z", None))
    got = audit.duplicate_accounts(raw)
    assert rows(got, "kept_user_id", "kept_email", "duplicate_user_id", "duplicate_email") == [
        (1, "a.b@gmail.com", 1, "a.b@gmail.com"), (1, "a.b@gmail.com", 1, "ab@gmail.com"), (1, "a.b@gmail.com", None, "ab@gmail.com"),
    ]


def test_a_hot_account_is_dealt_to_many_tasks(spark, tiny_skew_limits):
    """A third of the users share one address; no task of the join has more than about a few salts of them."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot@gmail.com")).otherwise(F.concat((F.col("id") % 20_000).cast("string"), F.lit("@x.com")))
    many = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("user_id"), F.lit("F").alias("first_name"), F.lit("L").alias("last_name"), hot.alias("email"),
        F.lit("US").alias("country"), F.lit("2023-01-01 00:00:00").alias("signup_date"),
    )
    pairs = audit.duplicate_accounts(many)
    hot_pairs = [r for r in pairs.collect() if r.account_email == "hot@gmail.com"]
    assert len(hot_pairs) == 19_999 and {r.kept_user_id for r in hot_pairs} == {0}
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = pairs.filter("account_email = 'hot@gmail.com'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(dealt) == 16 and max(r["count"] for r in dealt) < 19_999 / 6


def test_signups_per_month(spark, rows):
    assert rows(audit.count_by_month(parse_users(users(spark)), "signup_date")) == [
        ("2023-01", 2), ("2023-02", 3), ("NULL (Missing)", 2),
    ]


def test_weekdays_are_all_listed(spark):
    got = [tuple(r) for r in audit.count_by_weekday(parse_orders(orders(spark)), "order_date").orderBy("weekday_number").collect()]
    assert got == [
        (0, "Monday", 2), (1, "Tuesday", 1), (2, "Wednesday", 2), (3, "Thursday", 0), (4, "Friday", 0), (5, "Saturday", 2), (6, "Sunday", 1),
    ]


def test_weekend_share(spark):
    r = audit.weekend_share(stage_orders(orders(spark))).first()
    assert (r.completed_orders, r.weekend_orders, r.weekend_pct) == (3, 1, Decimal("33.33"))


def test_sample_is_ordered(spark):
    got = audit.sample_rows(parse_orders(orders(spark)), F.col("order_value") > 0, ["order_value", "order_id"], 2)
    assert [r.order_id for r in got.collect()] == [5, 1]


def test_attrition_adds_up(spark):
    more_users = users(spark).unionByName(raw_users(spark, (8, None, "2023-03-01 00:00:00"), (9, None, "2023-04-01 00:00:00")))
    more_orders = orders(spark).unionByName(
        raw_orders(spark, (None, 1, "2023-01-07T10:00:00Z", "5.00", "completed"), (None, 1, "2023-01-08T10:00:00Z", "5.00", "completed"))
    )
    got = {}
    for r in audit.attrition(more_users, more_orders, events(spark)).collect():
        got.setdefault(r.table, {})[r.outcome] = r.row_count
    assert got == {
        "users": {"raw": 9, "dropped_no_signup_date": 2, "dropped_duplicate_account": 2, "dropped_null_email": 2, "kept": 3},
        "orders": {
            "raw": 10, "dropped_non_positive_value": 3, "dropped_retry": 2, "dropped_null_order_id": 1, "kept": 4, "kept_orphaned_user": 2,
        },
        "events": {"raw": 5, "dropped_no_user_or_session": 2, "kept": 3, "kept_orphaned_user": 2},
    }
    for table in got.values():
        assert table["raw"] == table["kept"] + sum(n for outcome, n in table.items() if outcome.startswith("dropped"))


def test_orphan_probe_joins_totals_not_rows(spark):
    plan = audit.audit_events(events(spark), users(spark))._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join LeftOuter") :].splitlines()
    assert "Aggregate [user_id" in joined[1]
    # One pass over the events, one over the users.
    assert plan.count("LogicalRDD") == 2
