"""Click events to sessions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import whole_seconds


class FunnelStep(NamedTuple):
    """One funnel step, named by its event.

    ``has`` is the column saying the event occurred at all, ``reached`` the
    column saying it occurred after the steps before it.
    """

    event: str
    has: str
    reached: str


# The default funnel.
DEFAULT_STEPS: Sequence[FunnelStep] = (
    FunnelStep("page_view", "has_page_view", "has_page_view"),
    FunnelStep("add_to_cart", "has_cart_add", "has_sequential_cart"),
    FunnelStep("purchase", "has_purchase", "has_sequential_purchase"),
)
NO_STEP = "none"


def _count_name(step: FunnelStep) -> str:
    return f"{step.event}_count"


def _first_name(step: FunnelStep) -> str:
    return f"first_{step.event}_at"


def _reached(steps: Sequence[FunnelStep]) -> Column:
    """All of ``steps`` occurred, each first time no earlier than the one before."""
    condition = F.col(_count_name(steps[0])) > 0
    for step in steps[1:]:
        condition = condition & (F.col(_count_name(step)) > 0)
    for earlier, later in zip(steps, steps[1:]):
        condition = condition & (F.col(_first_name(earlier)) <= F.col(_first_name(later)))
    return condition


def sessionize(
    events: DataFrame,
    keys: Sequence[str] = ("session_id", "user_id"),
    steps: Sequence[FunnelStep] = DEFAULT_STEPS,
) -> DataFrame:
    """One row per session: span, counts, first time per step, funnel flags.

    All measures are mergeable, so Spark combines map-side and a session with
    very many events is shuffled as one row per task.  The text minimum makes
    that a sort-based aggregation, which sorts fastest on a numeric leading
    key: the keys are grouped in reverse, user before session.
    """
    per_step = []
    for step in steps:
        occurred = F.col("event_name") == step.event
        per_step.append(F.count(F.when(occurred, 1)).alias(_count_name(step)))
        per_step.append(F.min(F.when(occurred, F.col("event_at"))).alias(_first_name(step)))
    rolled = events.groupBy(*reversed(keys)).agg(
        F.min("device_type").alias("device_type"),
        F.min("event_date").alias("session_date"),
        F.min("event_at").alias("session_start_at"),
        F.max("event_at").alias("session_end_at"),
        F.count("event_id").alias("total_events_count"),
        *per_step,
    )

    reached = [_reached(steps[: i + 1]) for i in range(len(steps))]
    flags = {step.has: F.col(_count_name(step)) > 0 for step in steps}
    flags.update({step.reached: condition for step, condition in zip(steps, reached)})
    furthest = F.when(reached[-1], steps[-1].event)
    for step, condition in list(zip(steps, reached))[-2::-1]:
        furthest = furthest.when(condition, step.event)

    return rolled.select(
        *keys,
        "device_type",
        "session_date",
        "session_start_at",
        "session_end_at",
        whole_seconds(F.col("session_start_at"), F.col("session_end_at")).alias("session_duration_seconds"),
        "total_events_count",
        *[_count_name(step) for step in steps],
        *[_first_name(step) for step in steps],
        *[condition.alias(name) for name, condition in flags.items()],
        furthest.otherwise(NO_STEP).alias("furthest_funnel_step"),
    )


_CELL = "__gap_cell"


def _in_gap_cells(events: DataFrame, user: str, ts: str, gap: str) -> DataFrame:
    """Events that can be placed, tagged with their gap-wide time cell."""
    return events.filter(F.col(user).isNotNull() & F.col(ts).isNotNull()).withColumn(_CELL, F.window(ts, gap)["start"])


def _numbered_cells(placed: DataFrame, user: str, ts: str, gap: str) -> DataFrame:
    """One row per user and cell, with the number of the session it belongs to.

    Two events in one cell are less than a gap apart, so no session breaks
    inside a cell and only cells need ordering.  However many events a user
    has, the cells are bounded by elapsed time over gap.
    """
    by_time = Window.partitionBy(user).orderBy(_CELL)
    cells = placed.groupBy(user, _CELL).agg(
        F.min(ts).alias("cell_from"), F.max(ts).alias("cell_to"), F.count(F.lit(1)).alias("cell_events")
    )
    previous = F.lag("cell_to").over(by_time)
    opens = F.when(previous.isNull() | (F.col("cell_from") > previous + F.expr(f"interval {gap}")), 1).otherwise(0)
    running = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.withColumn("opens", opens).withColumn("session_seq", F.sum("opens").over(running))


def gap_sessions(events: DataFrame, user: str, ts: str, gap: str = "30 minutes") -> DataFrame:
    """Sessions of a feed without session ids: a pause longer than ``gap`` ends one.

    Events are reduced to cells before the shuffle and never joined back.
    """
    cells = _numbered_cells(_in_gap_cells(events, user, ts, gap), user, ts, gap)
    return cells.groupBy(user, "session_seq").agg(
        F.min("cell_from").alias("session_start_at"),
        F.max("cell_to").alias("session_end_at"),
        F.sum("cell_events").alias("total_events_count"),
    )


def merge_sessions(parts: DataFrame, user: str, gap: str = "30 minutes") -> DataFrame:
    """The sessions that ``parts`` make together, numbered per user.

    ``parts`` are sessions of any portions of the events, such as batches,
    found with the same ``gap``; those within a gap of each other are one.  A
    portion's sessions per user are bounded by elapsed time over gap.
    """
    by_start = Window.partitionBy(user).orderBy("session_start_at", "session_end_at")
    reached = F.max("session_end_at").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached.isNull() | (F.col("session_start_at") > reached + F.expr(f"interval {gap}")), 1).otherwise(0)
    running = by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = parts.withColumn("opens", opens).withColumn("session_seq", F.sum("opens").over(running))
    return numbered.groupBy(user, "session_seq").agg(
        F.min("session_start_at").alias("session_start_at"),
        F.max("session_end_at").alias("session_end_at"),
        F.sum("total_events_count").alias("total_events_count"),
    )


def assign_sessions(events: DataFrame, user: str, ts: str, gap: str = "30 minutes") -> DataFrame:
    """Every placeable event with ``session_seq`` and a ``session_id`` made of user and number.

    The join key is user and cell, so a heavy user spreads over many keys.
    The cells arrive partitioned by user alone, so both sides are shuffled for
    the join, and Spark can split a heavy cell at run time.
    """
    placed = _in_gap_cells(events, user, ts, gap)
    cells = _numbered_cells(placed, user, ts, gap).select(user, _CELL, "session_seq")
    return (
        placed.join(cells, [user, _CELL])
        .drop(_CELL)
        .withColumn("session_id", F.concat_ws("_", F.col(user).cast("string"), F.col("session_seq").cast("string")))
    )
