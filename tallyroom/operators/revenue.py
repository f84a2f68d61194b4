"""Daily revenue, and its incremental maintenance with a look-back window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mean_to_cents
from .staging import COMPLETED

REVENUE_MONEY = "decimal(24,2)"
REVENUE_COLUMNS = ("order_date", "total_revenue", "order_count", "distinct_user_count", "average_order_value")
LOOKBACK_DAYS = 7
_NO_TARGET_DAY = dt.date(1970, 1, 1)


def daily_revenue(orders: DataFrame, extra_dates: DataFrame | None = None) -> DataFrame:
    """Revenue of completed orders per order date.

    Dates whose orders are all unfinished get zeros, and so do ``extra_dates``
    without orders.  Orders of unknown users count.  Everything is one
    conditional aggregation over one scan: unfinished orders and extra dates
    enter as empty rows that create the group and add nothing.
    """
    # An undated order belongs to no day; its NULL day is listed with zeros.
    counts = (F.col("order_status") == COMPLETED) & F.col("order_date").isNotNull()
    measured = orders.select(
        "order_date",
        F.when(counts, F.col("order_id")).alias("order_id"),
        F.when(counts, F.col("user_id")).alias("user_id"),
        F.when(counts, F.col("order_value")).alias("order_value"),
    )
    if extra_dates is not None:
        measured = measured.unionByName(extra_dates.select("order_date"), allowMissingColumns=True)
    total = F.sum("order_value")
    return measured.groupBy("order_date").agg(
        F.coalesce(total, F.lit(0)).cast(REVENUE_MONEY).alias("total_revenue"),
        F.count("order_id").alias("order_count"),
        F.count_distinct("user_id").alias("distinct_user_count"),
        mean_to_cents(total, F.count("order_value")).alias("average_order_value"),
    )


def lookback_start(existing: DataFrame, lookback_days: int = LOOKBACK_DAYS) -> dt.date:
    """First day to recompute, counted back from the mart's own last day."""
    last = existing.agg(F.max("order_date")).first()[0] or _NO_TARGET_DAY
    return last - dt.timedelta(days=lookback_days)


def _lookback_start_scalar(existing: DataFrame, lookback_days: int) -> Column:
    last = F.coalesce(F.max("order_date"), F.lit(_NO_TARGET_DAY))
    return existing.agg(F.date_sub(last, lookback_days)).scalar()


def revenue_slice(orders: DataFrame, existing: DataFrame, start: dt.date | Column) -> DataFrame:
    """The recomputed days from ``start`` on.

    Days the mart already has stay in scope, so a day whose orders were all
    deleted comes back as zeros.
    """
    start = start if isinstance(start, Column) else F.lit(start)
    in_scope = F.col("order_date") >= start
    return daily_revenue(orders.filter(in_scope), extra_dates=existing.filter(in_scope))


def replace_slice(existing: DataFrame, recomputed: DataFrame, start: dt.date | Column) -> DataFrame:
    """The mart with every day from ``start`` on replaced.

    Equal to an upsert by order_date, because each existing day from ``start``
    on is part of ``recomputed``.
    """
    start = start if isinstance(start, Column) else F.lit(start)
    # The NULL day matches no upsert key, so it is left as it is.
    kept = existing.filter((F.col("order_date") < start) | F.col("order_date").isNull())
    return kept.select(*REVENUE_COLUMNS).unionByName(recomputed)


def revenue_trends(
    orders: DataFrame,
    existing: DataFrame | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    full_refresh: bool = False,
) -> DataFrame:
    """The complete new daily revenue mart, computed lazily.

    With ``existing``, only days inside the look-back window are recomputed:
    late orders in the window are absorbed, older ones wait for a full refresh.
    """
    if existing is None or full_refresh:
        return daily_revenue(orders)
    start = _lookback_start_scalar(existing, lookback_days)
    return replace_slice(existing, revenue_slice(orders, existing, start), start)


def revenue_kpis(revenue: DataFrame) -> DataFrame:
    """One row of totals over the daily mart."""
    active = F.col("order_count") > 0
    active_days = F.count_if(active)
    active_aov = F.sum(F.when(active, F.col("average_order_value")))
    return revenue.agg(
        F.count(F.lit(1)).alias("tracked_days"),
        active_days.alias("active_days"),
        F.coalesce(F.sum("total_revenue"), F.lit(0)).cast("decimal(30,2)").alias("total_revenue"),
        F.coalesce(F.sum("order_count"), F.lit(0)).cast("bigint").alias("completed_orders"),
        mean_to_cents(F.coalesce(active_aov, F.lit(0)), active_days).alias("mean_active_day_aov"),
    )


def latest_active_day(revenue: DataFrame, within_days: int | None = None) -> DataFrame:
    """The newest day with orders, if asked for only among the mart's last ``within_days`` days (one row at most)."""
    active = revenue.filter(F.col("order_count") > 0)
    if within_days is not None:
        active = active.filter(F.col("order_date") >= revenue.agg(F.date_sub(F.max("order_date"), within_days)).scalar())
    return active.orderBy(F.desc_nulls_first("order_date")).limit(1)
