"""The standard data-quality suite over the models."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from ..operators import quality as q
from ..operators.sessions import DEFAULT_STEPS
from .models import Models

# The columns the contract of the models checks.
UNIQUE_COLUMN: Mapping[str, str] = {
    "stg_users": "user_id",
    "stg_orders": "order_id",
    "stg_events": "event_id",
    "int_user_first_purchase": "user_id",
    "int_sessionized_events": "session_id",
    "fct_revenue_trends": "order_date",
}

# Fixed values, as above.  Nullable by design and therefore absent: names, country, device, page and
# the first-purchase columns of users who have not bought.
NOT_NULL_COLUMNS: Mapping[str, Sequence[str]] = {
    "stg_users": ("user_id", "email", "signup_at", "signup_date"),
    "stg_orders": ("order_id", "user_id", "ordered_at", "order_date", "order_value", "order_status"),
    "stg_events": ("event_id", "user_id", "session_id", "event_name", "event_at", "event_date"),
    "int_user_first_purchase": (
        "user_id",
        "signup_at",
        "signup_date",
        "total_orders_count",
        "total_lifetime_value",
        "has_purchased",
    ),
    "int_sessionized_events": (
        "session_id",
        "user_id",
        "session_date",
        "session_start_at",
        "session_end_at",
        "session_duration_seconds",
        "total_events_count",
        "page_view_count",
        "add_to_cart_count",
        "purchase_count",
        "has_page_view",
        "has_cart_add",
        "has_purchase",
        "has_sequential_cart",
        "has_sequential_purchase",
        "furthest_funnel_step",
    ),
    "monthly_cohort_retention": ("cohort_month", "cohort_size", "month_number", "active_users", "retention_pct"),
    "funnel_summary": (
        "funnel_step_order",
        "funnel_step",
        "session_count",
        "step_conversion_pct",
        "overall_conversion_pct",
    ),
    "fct_revenue_trends": (
        "order_date",
        "total_revenue",
        "order_count",
        "distinct_user_count",
        "average_order_value",
    ),
}


def unique_checks(models: Models) -> list[q.Check]:
    return [q.unique_check(table, models.table(table), column) for table, column in UNIQUE_COLUMN.items()]


def not_null_checks() -> list[q.Check]:
    return [rule for table, columns in NOT_NULL_COLUMNS.items() for rule in q.not_null_rules(table, columns)]


def accepted_checks() -> list[q.Check]:
    return [q.accepted_values_rule("funnel_summary", "funnel_step", [step.event for step in DEFAULT_STEPS])]


def business_rules() -> list[q.RowRule]:
    """The business checks that look at one row at a time."""
    return [
        q.RowRule("session_duration", "int_sessionized_events", None, q.session_duration_rule()),
        q.RowRule("revenue_non_negative", "fct_revenue_trends", None, q.revenue_negative_rule()),
        q.RowRule("retention_range", "monthly_cohort_retention", None, q.retention_range_rule()),
    ]


def row_rules() -> list[q.Check]:
    """Every check that can be counted while its table is written."""
    return [*not_null_checks(), *accepted_checks(), *business_rules()]


def _business_rule(name: str) -> q.RowRule:
    return next(rule for rule in business_rules() if rule.check == name)


# Business checks by name; each is planned only when it is asked for.
BUSINESS_CHECKS: Mapping[str, Callable[[Models], q.Check]] = {
    "session_duration": lambda _m: _business_rule("session_duration"),
    "purchase_after_signup": lambda m: q.RowsCheck(
        "purchase_after_signup",
        "int_user_first_purchase",
        None,
        q.purchase_before_signup(m.int_user_first_purchase, m.stg_users),
    ),
    "first_purchase_completed": lambda m: q.RowsCheck(
        "first_purchase_completed",
        "int_user_first_purchase",
        None,
        q.first_purchase_not_completed(m.int_user_first_purchase, m.stg_orders),
    ),
    "revenue_non_negative": lambda _m: _business_rule("revenue_non_negative"),
    "revenue_reconciles": lambda m: q.RowsCheck(
        "revenue_reconciles", "fct_revenue_trends", None, q.revenue_mismatches(m.fct_revenue_trends, m.stg_orders)
    ),
    "retention_range": lambda _m: _business_rule("retention_range"),
    "cohort_spine_complete": lambda m: q.RowsCheck(
        "cohort_spine_complete",
        "monthly_cohort_retention",
        None,
        q.cohort_spine_gaps(m.monthly_cohort_retention, m.stg_users, m.stg_orders),
    ),
    "funnel_monotonic": lambda m: q.RowsCheck(
        "funnel_monotonic", "funnel_summary", None, q.funnel_increases(m.funnel_summary)
    ),
}


def business_checks(models: Models) -> list[q.Check]:
    return [check(models) for check in BUSINESS_CHECKS.values()]


def standard_checks(models: Models) -> list[q.Check]:
    """60 column checks and 8 business checks."""
    return [*unique_checks(models), *not_null_checks(), *accepted_checks(), *business_checks(models)]
