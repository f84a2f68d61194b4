"""Small hand-written inputs."""

from datetime import date, datetime
from decimal import Decimal

from tallyroom.sources.raw import RAW_EVENTS_SCHEMA, RAW_ORDERS_SCHEMA, RAW_USERS_SCHEMA

STG_ORDERS = (
    "order_id bigint, user_id bigint, ordered_at timestamp, order_date date, order_value decimal(12,2), order_status string"
)
STG_USERS = (
    "user_id bigint, first_name string, last_name string, email string, country string, signup_at timestamp, signup_date date"
)
REVENUE = (
    "order_date date, total_revenue decimal(24,2), order_count bigint, distinct_user_count bigint, "
    "average_order_value decimal(18,2)"
)


def raw_users(spark, *rows):
    """(user_id, email, signup_date[, country])"""
    full = [(r[0], "F", "L", r[1], r[3] if len(r) > 3 else "US", r[2]) for r in rows]
    return spark.createDataFrame(full, RAW_USERS_SCHEMA)


def raw_orders(spark, *rows):
    """(order_id, user_id, iso text, amount text, status)"""
    full = [(r[0], r[1], r[2], None if r[3] is None else Decimal(r[3]), r[4]) for r in rows]
    return spark.createDataFrame(full, RAW_ORDERS_SCHEMA)


def raw_events(spark, *rows):
    """(event_id, user_id, session_id, name, local text[, device])"""
    full = [(r[0], r[1], r[2], r[3], r[4], r[5] if len(r) > 5 else "mobile", "/p") for r in rows]
    return spark.createDataFrame(full, RAW_EVENTS_SCHEMA)


def staged_orders(spark, *rows):
    """(order_id, user_id, date text or None, value text, status)"""
    full = []
    for order_id, user_id, day, value, status in rows:
        at = datetime.fromisoformat(f"{day}T12:00:00+00:00") if day else None
        full.append((order_id, user_id, at, date.fromisoformat(day) if day else None, Decimal(value), status))
    return spark.createDataFrame(full, STG_ORDERS)


def staged_users(spark, *rows):
    """(user_id, signup date text)"""
    full = [
        (user_id, "F", "L", f"u{user_id}@x.com", "US", datetime.fromisoformat(f"{day}T00:00:00+00:00"), date.fromisoformat(day))
        for user_id, day in rows
    ]
    return spark.createDataFrame(full, STG_USERS)


def revenue_mart(spark, *rows):
    """(date text, revenue, orders, users, aov)"""
    full = [(date.fromisoformat(d) if d else None, Decimal(v), n, u, Decimal(a)) for d, v, n, u, a in rows]
    return spark.createDataFrame(full, REVENUE)
