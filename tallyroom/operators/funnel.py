"""Conversion funnel over sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import percent
from .sessions import DEFAULT_STEPS, FunnelStep


def funnel_counts(
    sessions: DataFrame, steps: Sequence[FunnelStep] = DEFAULT_STEPS, distinct_sessions: bool = False
) -> DataFrame:
    """One row per step with the sessions that reached it in order.

    The counts come from a single scan and are unpivoted afterwards.
    ``distinct_sessions`` counts a session id shared by several users once;
    the default counts session rows.
    """
    if distinct_sessions:
        reached = [F.max(step.reached).alias(step.reached) for step in steps]
        sessions = sessions.filter(F.col("session_id").isNotNull()).groupBy("session_id").agg(*reached)
    totals = sessions.agg(*[F.count(F.when(F.col(step.reached), F.col("session_id"))).alias(step.event) for step in steps])
    rows = [
        F.struct(
            F.lit(position).alias("funnel_step_order"),
            F.lit(step.event).alias("funnel_step"),
            F.col(step.event).alias("session_count"),
            F.col(steps[max(position - 2, 0)].event).alias("previous_count"),
            F.col(steps[0].event).alias("top_count"),
        )
        for position, step in enumerate(steps, start=1)
    ]
    return totals.select(F.inline(F.array(*rows)))


def funnel_summary(
    sessions: DataFrame, steps: Sequence[FunnelStep] = DEFAULT_STEPS, distinct_sessions: bool = False
) -> DataFrame:
    """Step counts with conversion from the previous step and from the top."""
    return funnel_counts(sessions, steps, distinct_sessions).select(
        "funnel_step_order",
        "funnel_step",
        "session_count",
        percent(F.col("session_count"), F.col("previous_count")).alias("step_conversion_pct"),
        percent(F.col("session_count"), F.col("top_count")).alias("overall_conversion_pct"),
    )


def step_conversion(steps: DataFrame, order_col: str, count_col: str) -> DataFrame:
    """Adds ``step_conversion_pct`` to an already counted funnel (one row per step).

    The first step converts from itself.
    """
    by_step = Window.orderBy(order_col)
    previous = F.coalesce(F.lag(count_col).over(by_step), F.col(count_col))
    return steps.withColumn("step_conversion_pct", percent(F.col(count_col), previous))
