"""First purchase and lifetime value per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import COMPLETED

LIFETIME_MONEY = "decimal(24,2)"


def purchase_totals(orders: DataFrame) -> DataFrame:
    """Completed-order totals and the first order of each user, in one aggregation.

    ``min`` over a struct finds the first order map-side, so neither a second
    pass nor a per-user sort is needed.  A struct compares NULLs first while
    an undated order must rank last, hence the leading undated flag.
    """
    undated, unnumbered = F.col("ordered_at").isNull().alias("undated"), F.col("order_id").isNull().alias("unnumbered")
    first = F.min(F.struct(undated, "ordered_at", unnumbered, "order_id", "order_value"))
    return (
        orders.filter(F.col("order_status") == COMPLETED)
        .groupBy("user_id")
        .agg(
            F.count("order_id").alias("total_orders_count"),
            F.sum("order_value").cast(LIFETIME_MONEY).alias("total_lifetime_value"),
            F.min("ordered_at").alias("first_purchase_at"),
            F.min("order_date").alias("first_purchase_date"),
            first.alias("first_order"),
        )
        .withColumn("first_purchase_order_id", F.col("first_order.order_id"))
        .withColumn("first_purchase_value", F.col("first_order.order_value"))
        .drop("first_order")
    )


def user_first_purchase(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Every staged user with acquisition and purchase metrics; non-buyers have zeros.

    Staged users have one row per account, so only a missing id can repeat
    massively.  Those rows match nothing and stay out of the join, which can
    then use the shuffle of the totals.
    """
    totals, known = purchase_totals(orders), F.col("user_id").isNotNull()
    joined = users.filter(known).join(totals, "user_id", "left")
    return joined.unionByName(users.filter(~known), allowMissingColumns=True).select(
        "user_id",
        "signup_at",
        "signup_date",
        "first_purchase_at",
        "first_purchase_date",
        "first_purchase_order_id",
        "first_purchase_value",
        F.coalesce("total_orders_count", F.lit(0)).cast("bigint").alias("total_orders_count"),
        F.coalesce("total_lifetime_value", F.lit(0)).cast(LIFETIME_MONEY).alias("total_lifetime_value"),
        F.col("first_purchase_at").isNotNull().alias("has_purchased"),
    )
