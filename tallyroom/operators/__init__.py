from .audit import (
    attrition,
    audit_events,
    audit_orders,
    audit_users,
    count_by_month,
    count_by_weekday,
    duplicate_accounts,
    duplicate_conflicts,
    sample_rows,
    weekend_share,
)
from .cohorts import cohort_curves, cohort_kpis, cohort_matrix, cohort_retention
from .dedupe import keep_first
from .funnel import funnel_summary, step_conversion
from .hot_keys import join_per_key
from .purchases import user_first_purchase
from .quality import accepted_values, compare_frames, not_null, reconcile, run_checks, unique, violations
from .revenue import daily_revenue, latest_active_day, revenue_kpis, revenue_slice, revenue_trends
from .series import rolling_mean
from .sessions import DEFAULT_STEPS, FunnelStep, assign_sessions, gap_sessions, sessionize
from .staging import stage_events, stage_orders, stage_orders_since, stage_users

__all__ = [
    "DEFAULT_STEPS",
    "FunnelStep",
    "accepted_values",
    "assign_sessions",
    "attrition",
    "audit_events",
    "audit_orders",
    "audit_users",
    "cohort_curves",
    "cohort_kpis",
    "cohort_matrix",
    "cohort_retention",
    "compare_frames",
    "count_by_month",
    "count_by_weekday",
    "daily_revenue",
    "duplicate_accounts",
    "duplicate_conflicts",
    "funnel_summary",
    "gap_sessions",
    "join_per_key",
    "keep_first",
    "latest_active_day",
    "not_null",
    "reconcile",
    "revenue_kpis",
    "revenue_slice",
    "revenue_trends",
    "rolling_mean",
    "run_checks",
    "sample_rows",
    "sessionize",
    "stage_events",
    "stage_orders",
    "stage_orders_since",
    "stage_users",
    "step_conversion",
    "unique",
    "user_first_purchase",
    "violations",
    "weekend_share",
]
