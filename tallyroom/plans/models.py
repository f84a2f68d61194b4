"""The dependency graph of the models, as plain function composition."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from ..operators.cohorts import cohort_retention
from ..operators.funnel import funnel_summary
from ..operators.purchases import user_first_purchase
from ..operators.revenue import LOOKBACK_DAYS, revenue_trends
from ..operators.sessions import sessionize
from ..operators.staging import stage_events, stage_orders, stage_users

MODEL_NAMES = (
    "stg_users",
    "stg_orders",
    "stg_events",
    "int_user_first_purchase",
    "int_sessionized_events",
    "fct_revenue_trends",
    "monthly_cohort_retention",
    "funnel_summary",
)


class Models:
    """Every model as a lazy DataFrame, planned when first asked for.

    ``raw`` returns the raw table ``users``, ``orders`` or ``events`` by name.
    Attribute names are the published table names.  ``keep`` is called with
    the name and plan of each model and may return a stored copy for the
    models that follow to read; by default nothing is stored.
    """

    def __init__(
        self,
        raw: Callable[[str], DataFrame],
        existing_revenue: DataFrame | None = None,
        lookback_days: int = LOOKBACK_DAYS,
        full_refresh: bool = False,
        keep: Callable[[str, DataFrame], DataFrame] = lambda _name, df: df,
    ) -> None:
        self._raw = raw
        self._existing_revenue = existing_revenue
        self._lookback_days = lookback_days
        self._full_refresh = full_refresh
        self._keep = keep

    @cached_property
    def stg_users(self) -> DataFrame:
        return self._keep("stg_users", stage_users(self._raw("users")))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return self._keep("stg_orders", stage_orders(self._raw("orders")))

    @cached_property
    def stg_events(self) -> DataFrame:
        return self._keep("stg_events", stage_events(self._raw("events")))

    @cached_property
    def int_user_first_purchase(self) -> DataFrame:
        return self._keep("int_user_first_purchase", user_first_purchase(self.stg_users, self.stg_orders))

    @cached_property
    def int_sessionized_events(self) -> DataFrame:
        return self._keep("int_sessionized_events", sessionize(self.stg_events))

    @cached_property
    def fct_revenue_trends(self) -> DataFrame:
        mart = revenue_trends(self.stg_orders, self._existing_revenue, self._lookback_days, self._full_refresh)
        return self._keep("fct_revenue_trends", mart)

    @cached_property
    def monthly_cohort_retention(self) -> DataFrame:
        # The first-purchase table has the same users as staging, so cohorts need not wait for it.
        return self._keep("monthly_cohort_retention", cohort_retention(self.stg_users, self.stg_orders))

    @cached_property
    def funnel_summary(self) -> DataFrame:
        return self._keep("funnel_summary", funnel_summary(self.int_sessionized_events))

    def table(self, name: str) -> DataFrame:
        if name not in MODEL_NAMES:
            raise KeyError(f"no model named {name!r}; there are {', '.join(MODEL_NAMES)}")
        return getattr(self, name)

    def register_views(self, prefix: str = "") -> None:
        """Make every model queryable by name in SQL; views are evaluated when read."""
        for name in MODEL_NAMES:
            self.table(name).createOrReplaceTempView(f"{prefix}{name}")
