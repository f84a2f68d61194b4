from datetime import datetime, timedelta
import random

from pyspark.sql import functions as F

from tallyroom.operators.funnel import funnel_summary, step_conversion
from tallyroom.operators.sessions import FunnelStep, assign_sessions, gap_sessions, sessionize
from tallyroom.operators.staging import stage_events

from .builders import raw_events


def sessions_of(spark, *events):
    """(user, session, name, seconds after 10:00)"""
    start = datetime(2023, 1, 1, 10)
    raw = [(i, u, s, n, str(start + timedelta(seconds=sec))) for i, (u, s, n, sec) in enumerate(events)]
    return sessionize(stage_events(raw_events(spark, *raw)))


FLAGS = ("session_id", "has_page_view", "has_cart_add", "has_purchase", "has_sequential_cart", "has_sequential_purchase", "furthest_funnel_step")


def test_sequence_is_enforced_and_ties_pass(spark, rows):
    got = sessions_of(
        spark,
        (1, "a", "page_view", 0), (1, "a", "add_to_cart", 5), (1, "a", "purchase", 9),
        (1, "b", "add_to_cart", 0), (1, "b", "page_view", 5), (1, "b", "purchase", 9),
        (1, "c", "page_view", 0), (1, "c", "purchase", 1), (1, "c", "add_to_cart", 2),
        (1, "d", "page_view", 3), (1, "d", "add_to_cart", 3), (1, "d", "purchase", 3),
        (1, "e", "purchase", 0),
        (1, "f", "page_view", 0), (1, "f", "add_to_cart", 1), (1, "f", "add_to_cart", 2),
        (1, "g", "page_view", 0), (1, "g", "purchase", 4),
    )
    assert rows(got, *FLAGS) == [
        ("a", True, True, True, True, True, "purchase"),
        ("b", True, True, True, False, False, "page_view"),
        ("c", True, True, True, True, False, "add_to_cart"),
        ("d", True, True, True, True, True, "purchase"),
        ("e", False, False, True, False, False, "none"),
        ("f", True, True, False, True, False, "add_to_cart"),
        ("g", True, False, True, False, False, "page_view"),
    ]


def test_a_session_id_shared_by_users_is_two_sessions(spark, rows):
    got = sessions_of(spark, (1, "a", "page_view", 0), (2, "a", "page_view", 9), (2, "a", "page_view", 12))
    assert rows(got, "session_id", "user_id", "total_events_count", "session_duration_seconds") == [("a", 1, 1, 0), ("a", 2, 2, 3)]
    assert funnel_summary(got).first().session_count == 2
    assert funnel_summary(got, distinct_sessions=True).first().session_count == 1


def test_null_event_time_makes_flags_unknown(spark):
    staged = stage_events(raw_events(spark, (1, 1, "a", "page_view", None), (2, 1, "a", "add_to_cart", "2023-01-01 10:00:00")))
    row = sessionize(staged).first()
    assert row.has_page_view and row.has_cart_add
    assert row.has_sequential_cart is None
    assert row.has_sequential_purchase is False


def test_first_device_alphabetically(spark):
    at = "2023-01-01 10:00:00"
    staged = stage_events(raw_events(spark, (1, 1, "a", "page_view", at, "Tablet"), (2, 1, "a", "page_view", at, " desktop")))
    assert sessionize(staged).first().device_type == "desktop"


def test_funnel_percentages_and_single_scan(spark, rows):
    got = sessions_of(
        spark,
        (1, "a", "page_view", 0), (1, "a", "add_to_cart", 5), (1, "a", "purchase", 9),
        (1, "b", "page_view", 0), (1, "b", "add_to_cart", 5),
        (1, "c", "page_view", 0),
    )
    funnel = funnel_summary(got)
    assert [(r[0], r[1], r[2], str(r[3]), str(r[4])) for r in funnel.orderBy("funnel_step_order").collect()] == [
        (1, "page_view", 3, "100.00", "100.00"),
        (2, "add_to_cart", 2, "66.67", "66.67"),
        (3, "purchase", 1, "50.00", "33.33"),
    ]
    assert funnel._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_empty_funnel_is_three_zero_rows(spark, rows):
    empty = sessions_of(spark, (1, "a", "other", 0)).limit(0)
    assert [(r[2], str(r[3]), str(r[4])) for r in funnel_summary(empty).collect()] == [(0, "0.00", "0.00")] * 3


def test_published_step_counts(spark):
    counts = spark.createDataFrame([(1, 4672), (2, 1512), (3, 581)], "step int, n bigint")
    got = [str(r.step_conversion_pct) for r in step_conversion(counts, "step", "n").orderBy("step").collect()]
    assert got == ["100.00", "32.36", "38.43"]


def test_other_funnel_steps(spark):
    steps = (FunnelStep("visit", "has_visit", "has_visit"), FunnelStep("trial", "has_trial", "reached_trial"))
    staged = stage_events(raw_events(spark, (1, 1, "a", "visit", "2023-01-01 10:00:00"), (2, 1, "a", "trial", "2023-01-01 11:00:00")))
    got = funnel_summary(sessionize(staged, steps=steps), steps).collect()
    assert [(r.funnel_step, r.session_count) for r in got] == [("visit", 1), ("trial", 1)]


def brute_sessions(events, gap):
    """event id -> session number, straight from the definition."""
    numbers, last, current = {}, {}, {}
    for event_id, user, ts in sorted(events, key=lambda e: (e[1], e[2], e[0])):
        if user not in last or ts - last[user] > gap:
            current[user] = current.get(user, 0) + 1
        last[user] = ts
        numbers[event_id] = current[user]
    return numbers


def test_gap_sessions_match_brute_force(spark):
    rng = random.Random(7)
    base = datetime(2024, 1, 1)
    events = [(i, rng.randrange(4), base + timedelta(seconds=rng.randrange(0, 40_000))) for i in range(600)]
    # Pauses of exactly the gap, and one second more.
    events += [(1000, 9, base), (1001, 9, base + timedelta(minutes=30)), (1002, 9, base + timedelta(minutes=60, seconds=1))]
    expected = brute_sessions(events, timedelta(minutes=30))
    df = spark.createDataFrame(events, "event_id bigint, user_id bigint, ts timestamp_ntz")
    got = {r.event_id: r.session_seq for r in assign_sessions(df, "user_id", "ts").collect()}
    assert got == expected
    sizes = {(r.user_id, r.session_seq): r.total_events_count for r in gap_sessions(df, "user_id", "ts").collect()}
    users = {e[0]: e[1] for e in events}
    want = {}
    for event_id, number in expected.items():
        want[users[event_id], number] = want.get((users[event_id], number), 0) + 1
    assert sizes == want


def test_gap_sessions_agree_with_session_window(spark, rows):
    rng = random.Random(3)
    base = datetime(2024, 1, 1)
    events = [(rng.randrange(3), base + timedelta(seconds=rng.randrange(0, 90_000, 30))) for _ in range(400)]
    df = spark.createDataFrame(events, "user_id bigint, ts timestamp_ntz")
    window = df.groupBy("user_id", F.session_window("ts", "10 minutes").alias("w")).agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n"))
    ours = gap_sessions(df, "user_id", "ts", "10 minutes")
    assert rows(ours, "user_id", "session_start_at", "session_end_at", "total_events_count") == rows(window, "user_id", "a", "b", "n")


def test_a_hot_cell_is_split_at_run_time(spark, tiny_skew_limits, final_plan):
    """A third of all events fall on one user within one minute."""
    hot = F.col("id") % 3 == 0
    events = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("event_id"),
        F.when(hot, 0).otherwise(F.col("id") % 997 + 1).alias("user_id"),
        F.timestamp_add(
            "SECOND", F.when(hot, F.col("id") % 60).otherwise(F.col("id") * 37 % 86_400), F.expr("timestamp_ntz'2024-01-01'")
        ).alias("ts"),
    )
    assigned = assign_sessions(events, "user_id", "ts")
    collected = assigned.collect()
    assert len(collected) == 60_000
    assert {r.session_seq for r in collected if r.user_id == 0} == {1}
    assert "skew=true" in final_plan(assigned)


def test_unplaceable_events_are_left_out(spark):
    df = spark.createDataFrame([(1, None, datetime(2024, 1, 1)), (2, 5, None)], "event_id bigint, user_id bigint, ts timestamp_ntz")
    assert assign_sessions(df, "user_id", "ts").count() == 0


def test_assigned_sessions_feed_the_rollup(spark, rows):
    df = spark.createDataFrame(
        [(1, 5, datetime(2024, 1, 1, 10), "page_view"), (2, 5, datetime(2024, 1, 1, 10, 5), "add_to_cart"), (3, 5, datetime(2024, 1, 1, 12), "page_view")],
        "event_id bigint, user_id bigint, event_timestamp timestamp_ntz, event_name string",
    )
    with_sessions = assign_sessions(df, "user_id", "event_timestamp").withColumn("device_type", F.lit("mobile")).withColumn("page_url", F.lit("/"))
    got = sessionize(stage_events(with_sessions))
    assert rows(got, "session_id", "furthest_funnel_step") == [("5_1", "add_to_cart"), ("5_2", "page_view")]
