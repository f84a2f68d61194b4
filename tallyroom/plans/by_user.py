"""Staged users and orders stored by user, for the models that join them again and again.

Both are written in buckets by user, so first purchases and cohorts read them
without a shuffle of orders.  A user with a large part of all orders would make
one bucket as large; such users, of whom there can't be many, and orders without
a user are kept in tables of their own without buckets, where Spark splits the
rows among tasks and shuffles what they sum to.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cohorts import cohort_activity, cohort_sizes, last_observed_day, retention_from_activity
from ..operators.purchases import user_first_purchase
from ..sources.store import materialise, write_bucketed

#: Users with more than one in so many orders are kept apart; there are fewer of them than that.
HOT_SHARE = 1000


class UserTables:
    """``users`` and ``orders`` in ``buckets`` by user, and the same for hot users apart.

    ``users`` has one row per user.  The bucketed tables belong to the
    session's catalogue under names of their own; their files lie under
    ``root``, on storage that all executors reach.
    """

    def __init__(self, users: DataFrame, orders: DataFrame, root: str, buckets: int, hot_share: int = HOT_SHARE) -> None:
        name, root = uuid.uuid4().hex[:12], root.rstrip("/")
        per_user = orders.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
        per_user = materialise(per_user, f"{root}/orders_per_user")
        total = per_user.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        self.hot_ids = [r["user_id"] for r in per_user.filter(F.col("n") * hot_share > F.lit(total)).select("user_id").collect()]
        apart = F.col("user_id").isNull() | (F.col("user_id").isin(*self.hot_ids) if self.hot_ids else F.lit(False))
        stored = {}
        for table, df in (("users", users), ("orders", orders)):
            stored[table] = write_bucketed(df.filter(~apart), f"tallyroom_{name}_{table}", "user_id", buckets, f"{root}/{table}")
            stored[f"hot_{table}"] = materialise(df.filter(apart), f"{root}/hot_{table}")
        self.users, self.orders = stored["users"], stored["orders"]
        self.hot_users, self.hot_orders = stored["hot_users"], stored["hot_orders"]

    def first_purchase(self) -> DataFrame:
        """``user_first_purchase`` of all users."""
        return user_first_purchase(self.users, self.orders).unionByName(user_first_purchase(self.hot_users, self.hot_orders))

    def retention(self) -> DataFrame:
        """``cohort_retention`` of all users; what is shuffled of the bucketed tables are cohorts and months."""
        activity = cohort_activity(self.users, self.orders).unionByName(cohort_activity(self.hot_users, self.hot_orders))
        activity = activity.groupBy("cohort_month", "activity_month").agg(F.sum("active_users").alias("active_users"))
        sizes = cohort_sizes(self.users).unionByName(cohort_sizes(self.hot_users))
        sizes = sizes.groupBy("cohort_month").agg(F.sum("cohort_size").alias("cohort_size"))
        ordered = self.orders.select("order_date").unionByName(self.hot_orders.select("order_date"))
        signed_up = self.users.select("signup_date").unionByName(self.hot_users.select("signup_date"))
        return retention_from_activity(sizes, activity, last_observed_day(ordered, signed_up))
