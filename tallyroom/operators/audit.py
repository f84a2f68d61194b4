"""Audits of raw-data defects and of what cleaning removes.

Joins here run on per-key totals, never on raw rows, so one user or order id
that holds a large part of a table is already a single row when it is
shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import percent
from .hot_keys import join_per_key
from .sessions import DEFAULT_STEPS, FunnelStep
from .staging import (
    COMPLETED,
    best_attempts,
    parse_events,
    parse_orders,
    parse_users,
    stage_users,
    valid_attempts,
)

# Fixed value: the name of the bucket.
MISSING_MONTH = "NULL (Missing)"
# Fixed values, Monday first, as weekday() numbers them.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _metric_rows(totals: DataFrame, total: str, metrics: Sequence[str]) -> DataFrame:
    """One-row totals to (metric, row_count, pct) rows."""
    rows = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.col(metric).cast("bigint").alias("row_count"),
            percent(F.col(metric), F.col(total)).alias("pct"),
        )
        for metric in (total, *metrics)
    ]
    return totals.select(F.inline(F.array(*rows)))


def _rows_per_key(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows_of_key"))


def _row_total() -> Column:
    return F.coalesce(F.sum("rows_of_key"), F.lit(0)).cast("bigint")


def _per_user(df: DataFrame, users: DataFrame, *measures: Column) -> DataFrame:
    """Totals per user of ``df``, with ``orphaned`` set for users not in ``users``; a NULL user is no orphan."""
    totals = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("rows_of_key"), *measures)
    known = users.select("user_id").distinct().withColumn("known", F.lit(True))
    orphaned = F.col("known").isNull() & F.col("user_id").isNotNull()
    return totals.join(known, "user_id", "left").withColumn("orphaned", orphaned)


def _orphan_total() -> Column:
    return F.coalesce(F.sum(F.when(F.col("orphaned"), F.col("rows_of_key"))), F.lit(0)).cast("bigint")


def _total(measure: str) -> Column:
    return F.coalesce(F.sum(measure), F.lit(0)).cast("bigint").alias(measure)


def audit_users(raw_users: DataFrame) -> DataFrame:
    """Rows, duplicate accounts by canonical email, missing signup, missing country."""
    per_account = (
        parse_users(raw_users)
        .groupBy("account_email")
        .agg(
            F.count(F.lit(1)).alias("rows_of_key"),
            F.count_if(F.col("signup_date").isNull()).alias("undated"),
            F.count_if(F.col("country").isNull()).alias("stateless"),
        )
    )
    repeats = F.when(F.col("account_email").isNotNull(), F.col("rows_of_key") - 1)
    totals = per_account.agg(
        _row_total().alias("total_rows"),
        F.coalesce(F.sum(repeats), F.lit(0)).alias("duplicate_accounts"),
        F.coalesce(F.sum("undated"), F.lit(0)).alias("null_signup_date"),
        F.coalesce(F.sum("stateless"), F.lit(0)).alias("null_country"),
    )
    return _metric_rows(totals, "total_rows", ["duplicate_accounts", "null_signup_date", "null_country"])


def audit_orders(raw_orders: DataFrame, raw_users: DataFrame) -> DataFrame:
    """Rows, orders of unknown users, non-positive amounts, order ids that repeat."""
    parsed = parse_orders(raw_orders)
    repeated_ids = (
        _rows_per_key(parsed.filter(F.col("order_id").isNotNull()), "order_id")
        .agg(F.count_if(F.col("rows_of_key") > 1))
        .scalar()
    )
    non_positive = F.count_if(F.col("order_value") <= 0).alias("non_positive_value")
    totals = (
        _per_user(parsed, raw_users, non_positive)
        .agg(_row_total().alias("total_rows"), _orphan_total().alias("orphaned_user"), _total("non_positive_value"))
        .withColumn("duplicate_order_ids", repeated_ids)
    )
    return _metric_rows(totals, "total_rows", ["orphaned_user", "non_positive_value", "duplicate_order_ids"])


def audit_events(raw_events: DataFrame, raw_users: DataFrame, steps: Sequence[FunnelStep] = DEFAULT_STEPS) -> DataFrame:
    """Rows, events of unknown users, and the share of each funnel event."""
    names = [step.event for step in steps]
    counts = [F.count_if(F.col("event_name") == name).alias(name) for name in names]
    totals = _per_user(parse_events(raw_events), raw_users, *counts).agg(
        _row_total().alias("total_rows"), _orphan_total().alias("orphaned_user"), *[_total(name) for name in names]
    )
    return _metric_rows(totals, "total_rows", ["orphaned_user", *names])


def duplicate_conflicts(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """How the rows of each repeated key differ: one row per combination of differing fields.

    A field differs when the key's rows hold two values, or a value and a NULL.
    Minimum, maximum and counts decide this map-side, without collecting rows.
    """

    def differs(field: str) -> Column:
        some_null = (F.count(field) > 0) & (F.count(field) < F.count(F.lit(1)))
        return F.coalesce(F.min(field) != F.max(field), F.lit(False)) | some_null

    repeated = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows_of_key"), *[differs(f).alias(f"differs_{f}") for f in fields])
        .filter(F.col("rows_of_key") > 1)
    )
    named = F.concat_ws(" + ", *[F.when(F.col(f"differs_{f}"), F.lit(f)) for f in fields])
    kinds = (
        repeated.select(F.coalesce(F.nullif(named, F.lit("")), F.lit("identical")).alias("conflict_type"))
        .groupBy("conflict_type")
        .agg(F.count(F.lit(1)).alias("duplicate_sets"))
    )
    all_sets = kinds.agg(F.sum("duplicate_sets")).scalar()
    return kinds.withColumn("pct", percent(F.col("duplicate_sets"), all_sets))


# An account with more than one in so many registrations is dealt to one task per such part in a join, and its kept row
# repeated as often; there are fewer than that many such accounts.
HOT_SHARE = 1000


def duplicate_accounts(raw_users: DataFrame) -> DataFrame:
    """Each dropped registration beside the one that was kept.

    Pairs run from a duplicate to its survivor only, never between duplicates.
    Equal registrations are counted before the join, so the kept one is told
    apart by its whole row, and a repeated copy of it is listed as dropped.
    Only accounts that repeat enter the join, in which an account with any
    number of registrations is dealt to several tasks.
    """
    place = ["signup_at", F.col("user_id").isNull().alias("unnumbered"), "user_id", "email"]
    ties = [F.struct(F.col(c).isNull().alias("missing"), c).alias(f"{c}_order") for c in ("first_name", "last_name", "country", "signup_date")]
    dated = parse_users(raw_users).filter(F.col("signup_date").isNotNull() & F.col("account_email").isNotNull())
    ranked = dated.select("account_email", "user_id", "email", "signup_at", F.struct(F.col("signup_at").isNull().alias("undated"), *place, *ties).alias("place"))
    copies = ranked.groupBy(*ranked.columns).agg(F.count(F.lit(1)).alias("copies"))
    everyone = ranked.agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    repeated = (
        ranked.groupBy("account_email")
        .agg(F.count(F.lit(1)).alias("rows_of_key"), F.min("place").alias("kept"))
        .filter(F.col("rows_of_key") > 1)
        .withColumn("salts", F.ceil(F.col("rows_of_key") * HOT_SHARE / everyone).cast("int"))
    )
    kept = repeated.select("account_email", "kept", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    hot = F.broadcast(repeated.filter(F.col("salts") > 1).select("account_email", "salts"))
    dealt = F.pmod(F.xxhash64("place"), F.coalesce("salts", F.lit(1))).cast("int")
    salted = copies.join(hot, "account_email", "left").withColumn("salt", dealt).drop("salts")
    dropped = F.col("copies") - F.when(F.col("place") == F.col("kept"), 1).otherwise(0)
    return (
        salted.join(kept, ["account_email", "salt"])
        .withColumn("dropped", dropped)
        .filter(F.col("dropped") > 0)
        .select(
            "account_email",
            F.col("kept.user_id").alias("kept_user_id"),
            F.col("kept.email").alias("kept_email"),
            F.col("kept.signup_at").alias("kept_signup_at"),
            F.col("user_id").alias("duplicate_user_id"),
            F.col("email").alias("duplicate_email"),
            F.col("signup_at").alias("duplicate_signup_at"),
            F.explode(F.sequence(F.lit(1).cast("bigint"), "dropped")).alias("copy"),
        )
        .drop("copy")
    )


def count_by_month(df: DataFrame, day: str) -> DataFrame:
    """Rows per calendar month, with a bucket for missing dates."""
    month = F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(MISSING_MONTH))
    return df.groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("row_count"))


def count_by_weekday(df: DataFrame, day: str) -> DataFrame:
    """Rows per weekday; always seven rows, Monday first."""
    totals = df.agg(*[F.count_if(F.weekday(day) == i).alias(name) for i, name in enumerate(WEEKDAYS)])
    rows = [
        F.struct(F.lit(i).alias("weekday_number"), F.lit(name).alias("weekday"), F.col(name).alias("row_count"))
        for i, name in enumerate(WEEKDAYS)
    ]
    return totals.select(F.inline(F.array(*rows)))


def weekend_share(orders: DataFrame, day: str = "order_date") -> DataFrame:
    """One row: completed orders, those on a weekend, and their percentage."""
    totals = orders.filter(F.col("order_status") == COMPLETED).agg(
        F.count(F.lit(1)).alias("completed_orders"),
        F.count_if(F.weekday(day) >= 5).alias("weekend_orders"),
    )
    return totals.withColumn("weekend_pct", percent(F.col("weekend_orders"), F.col("completed_orders")))


def sample_rows(df: DataFrame, predicate: Column, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` matching rows, for a look by eye."""
    return df.filter(predicate).orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n)


def _stage_rows(totals: DataFrame, table: str, outcomes: Sequence[str]) -> DataFrame:
    rows = [
        F.struct(F.lit(table).alias("table"), F.lit(o).alias("outcome"), F.col(o).cast("bigint").alias("row_count"))
        for o in outcomes
    ]
    return totals.select(F.inline(F.array(*rows)))


USER_OUTCOMES = ("raw", "dropped_no_signup_date", "dropped_duplicate_account", "dropped_null_email", "kept")
ORDER_OUTCOMES = (
    "raw",
    "dropped_non_positive_value",
    "dropped_retry",
    "dropped_null_order_id",
    "kept",
    "kept_orphaned_user",
)
EVENT_OUTCOMES = ("raw", "dropped_no_user_or_session", "kept", "kept_orphaned_user")


def _surplus(rows_of_group: str, of_groups: Column) -> Column:
    """Rows beyond the one kept, summed over the groups for which ``of_groups`` holds."""
    surplus = F.greatest(F.col(rows_of_group) - 1, F.lit(0))
    return F.coalesce(F.sum(F.when(of_groups, surplus)), F.lit(0))


def attrition(raw_users: DataFrame, raw_orders: DataFrame, raw_events: DataFrame) -> DataFrame:
    """Rows in, rows out and the reason for each loss, per raw table.

    Rows without an email or order id compete as one group, so all but one of
    them are lost; they are reported apart from real duplicates.
    ``kept_orphaned_user`` rows stay in staging and daily revenue but have no
    staged user, so they take no part in cohorts or lifetime value.
    """
    staged_users = stage_users(raw_users)

    per_account = (
        parse_users(raw_users)
        .groupBy("account_email")
        .agg(F.count(F.lit(1)).alias("rows_of_key"), F.count("signup_date").alias("dated"))
        .agg(
            _row_total().alias("raw"),
            F.coalesce(F.sum(F.col("rows_of_key") - F.col("dated")), F.lit(0)).alias("dropped_no_signup_date"),
            _surplus("dated", F.col("account_email").isNotNull()).alias("dropped_duplicate_account"),
            _surplus("dated", F.col("account_email").isNull()).alias("dropped_null_email"),
            F.count_if(F.col("dated") > 0).alias("kept"),
        )
    )
    users = _stage_rows(per_account, "users", USER_OUTCOMES)

    parsed_orders = parse_orders(raw_orders)
    valid = valid_attempts(parsed_orders)
    per_order = (
        parsed_orders.groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("rows_of_key"), F.count_if(F.col("order_value") > 0).alias("valid"))
        .agg(
            _row_total().alias("raw"),
            F.coalesce(F.sum(F.col("rows_of_key") - F.col("valid")), F.lit(0)).alias("dropped_non_positive_value"),
            _surplus("valid", F.col("order_id").isNotNull()).alias("dropped_retry"),
            _surplus("valid", F.col("order_id").isNull()).alias("dropped_null_order_id"),
            F.count_if(F.col("valid") > 0).alias("kept"),
        )
    )
    order_orphans = _per_user(best_attempts(valid), staged_users).agg(_orphan_total()).scalar()
    orders = _stage_rows(per_order.withColumn("kept_orphaned_user", order_orphans), "orders", ORDER_OUTCOMES)

    identified = F.col("user_id").isNotNull() & F.col("session_id").isNotNull()
    per_user = _per_user(parse_events(raw_events), staged_users, F.count_if(identified).alias("kept"))
    kept_orphans = F.coalesce(F.sum(F.when(F.col("orphaned"), F.col("kept"))), F.lit(0))
    event_totals = per_user.agg(
        _row_total().alias("raw"), _total("kept"), kept_orphans.alias("kept_orphaned_user")
    ).withColumn("dropped_no_user_or_session", F.col("raw") - F.col("kept"))
    events = _stage_rows(event_totals, "events", EVENT_OUTCOMES)
    return users.unionAll(orders).unionAll(events)
