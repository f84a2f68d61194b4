"""Raw tables to typed, cleaned tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    DOMAIN_ALIASES,
    DOT_BLIND_DOMAINS,
    blank_to_null,
    canonical_email,
    clean_label,
    parse_civil_date,
    parse_instant,
    parse_local,
)
from .dedupe import keep_first
from .hot_keys import join_per_key

COMPLETED = "completed"
#: Up to so many order ids are named in a filter; the session lets Parquet see lists of this length.
NAMED_IDS = 500
MONEY = "decimal(12,2)"

# Upstream has shipped the order total under both names.
ORDER_COLUMN_MAP: Mapping[str, str] = {"order_amount": "order_value"}

USER_COLUMNS = ("user_id", "first_name", "last_name", "email", "country", "signup_at", "signup_date")
ORDER_COLUMNS = ("order_id", "user_id", "ordered_at", "order_date", "order_value", "order_status")


def rename_columns(raw: DataFrame, column_map: Mapping[str, str]) -> DataFrame:
    """Absorb an upstream rename; names that are absent are skipped."""
    return raw.withColumnsRenamed(dict(column_map))


def parse_users(
    raw_users: DataFrame,
    aliases: Mapping[str, Sequence[str]] = DOMAIN_ALIASES,
    dot_blind: Sequence[str] = DOT_BLIND_DOMAINS,
) -> DataFrame:
    """Typed users plus ``account_email``, before any row is dropped."""
    signup_type = raw_users.schema["signup_date"].dataType
    email = clean_label(F.col("email"))
    return raw_users.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        "first_name",
        "last_name",
        email.alias("email"),
        blank_to_null(F.col("country")).alias("country"),
        parse_instant(F.col("signup_date"), signup_type, assume_utc=True, blank_is_null=True).alias("signup_at"),
        parse_civil_date(F.col("signup_date"), signup_type, blank_is_null=True).alias("signup_date"),
        canonical_email(email, aliases, dot_blind).alias("account_email"),
    )


def earliest_accounts(parsed_users: DataFrame) -> DataFrame:
    """One dated registration per canonical email, the earliest; keeps ``account_email``."""
    return keep_first(
        parsed_users.filter(F.col("signup_date").isNotNull()),
        ["account_email"],
        [F.asc_nulls_last("signup_at"), F.asc_nulls_last("user_id")],
        ties=["email", "first_name", "last_name", "country", "signup_date"],
    )


def stage_users(
    raw_users: DataFrame,
    aliases: Mapping[str, Sequence[str]] = DOMAIN_ALIASES,
    dot_blind: Sequence[str] = DOT_BLIND_DOMAINS,
) -> DataFrame:
    """One row per person; undated registrations are dropped, blank countries become NULL."""
    return earliest_accounts(parse_users(raw_users, aliases, dot_blind)).select(*USER_COLUMNS)


def parse_orders(raw_orders: DataFrame, column_map: Mapping[str, str] = ORDER_COLUMN_MAP) -> DataFrame:
    """Typed order attempts, before any row is dropped."""
    renamed = rename_columns(raw_orders, column_map)
    date_type = renamed.schema["order_date"].dataType
    return renamed.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        parse_instant(F.col("order_date"), date_type).alias("ordered_at"),
        parse_civil_date(F.col("order_date"), date_type).alias("order_date"),
        F.col("order_value").cast(MONEY).alias("order_value"),
        clean_label(F.col("order_status")).alias("order_status"),
    )


def valid_attempts(parsed_orders: DataFrame) -> DataFrame:
    """Attempts with a positive amount.

    This runs before ranking, so a valid retry beats a zero-value original.
    """
    return parsed_orders.filter(F.col("order_value") > 0)


def best_attempts(attempts: DataFrame) -> DataFrame:
    """One attempt per order: completed first, then the latest, then the highest."""
    return keep_first(
        attempts,
        ["order_id"],
        [
            F.when(F.col("order_status") == COMPLETED, 1).otherwise(2).asc(),
            F.desc_nulls_first("ordered_at"),
            F.desc_nulls_first("order_value"),
        ],
        ties=["order_status", "user_id", "order_date"],
    )


def stage_orders(raw_orders: DataFrame, column_map: Mapping[str, str] = ORDER_COLUMN_MAP) -> DataFrame:
    """One valid row per order; orders of unknown users are kept."""
    return best_attempts(valid_attempts(parse_orders(raw_orders, column_map)))


def best_attempts_since(
    attempts: DataFrame,
    since: dt.date,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """``best_attempts`` restricted to orders dated ``since`` or later, for incremental runs.

    The date filter cannot simply move below the ranking: an order's winning
    attempt may lie on the other side of ``since``.  So the ids with any
    attempt in range are found first, and history is cut down to the attempts
    of those ids, see ``attempts_of``.

    The ids are needed more than once; ``keep`` may store them in between so
    that the attempts are searched only once.
    """
    in_range, unnumbered = F.col("order_date") >= F.lit(since), F.col("order_id").isNull()
    recent_ids = keep(attempts.filter(in_range & ~unnumbered).select("order_id").distinct())
    return best_attempts(attempts_of(attempts, recent_ids)).filter(in_range)


def attempts_of(attempts: DataFrame, ids: DataFrame) -> DataFrame:
    """The attempts of the orders in ``ids``, and all attempts without an id, which compete as one group.

    Few ids are named in the filter, so that Parquet skips row groups by the
    Bloom filters of ``write_attempts`` as well as by range; more are joined
    within their range.  The rows are the same either way.
    """
    unnumbered = attempts.filter(F.col("order_id").isNull())
    few = [r[0] for r in ids.limit(NAMED_IDS + 1).collect()]
    if len(few) <= NAMED_IDS:
        return attempts.filter(F.col("order_id").isin(*few) if few else F.lit(False)).unionByName(unnumbered)
    lowest, highest = ids.agg(F.min("order_id"), F.max("order_id")).first()
    nearby = attempts.filter(F.col("order_id").between(lowest, highest))
    return join_per_key(nearby, ids, ["order_id"], "left_semi").unionByName(unnumbered)


def stage_orders_since(
    raw_orders: DataFrame,
    since: dt.date,
    column_map: Mapping[str, str] = ORDER_COLUMN_MAP,
) -> DataFrame:
    """``stage_orders`` restricted to orders dated ``since`` or later."""
    return best_attempts_since(valid_attempts(parse_orders(raw_orders, column_map)), since)


def parse_events(raw_events: DataFrame) -> DataFrame:
    """Typed events, before any row is dropped."""
    time_type = raw_events.schema["event_timestamp"].dataType
    return raw_events.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        "session_id",
        clean_label(F.col("event_name")).alias("event_name"),
        # Client wall clock, deliberately not aligned with the UTC orders.
        parse_local(F.col("event_timestamp")).alias("event_at"),
        parse_civil_date(F.col("event_timestamp"), time_type).alias("event_date"),
        clean_label(F.col("device_type")).alias("device_type"),
        "page_url",
    )


def stage_events(raw_events: DataFrame) -> DataFrame:
    """Events that name both a user and a session; repeats are kept."""
    return parse_events(raw_events).filter(F.col("user_id").isNotNull() & F.col("session_id").isNotNull())
