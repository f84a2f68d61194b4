from .order_feed import absorb_orders, attempts_log, best_runs, change_runs, run_order_feed
from .session_feed import absorb_events, all_sessions, logged_events, run_session_log, stream_gap_sessions

__all__ = [
    "absorb_events",
    "absorb_orders",
    "all_sessions",
    "attempts_log",
    "best_runs",
    "change_runs",
    "logged_events",
    "run_order_feed",
    "run_session_log",
    "stream_gap_sessions",
]
