from datetime import datetime, timedelta

import pytest

from tallyroom.operators.revenue import daily_revenue
from tallyroom.operators.sessions import gap_sessions
from tallyroom.operators.staging import best_attempts
from tallyroom.sources import RAW_ORDERS_SCHEMA, drop_old_versions, publish_version, read_published
from tallyroom.streaming import absorb_orders, all_sessions, attempts_log, logged_events, run_order_feed, run_session_log, stream_gap_sessions

from .builders import raw_orders


def test_order_feed_keeps_revenue_current(spark, rows, tmp_path):
    inbox, root, checkpoint = (str(tmp_path / n) for n in ("inbox", "root", "checkpoint"))

    def deliver(*orders):
        raw_orders(spark, *orders).coalesce(1).write.mode("append").parquet(inbox)
        feed = spark.readStream.schema(RAW_ORDERS_SCHEMA).parquet(inbox)
        run_order_feed(feed, root, checkpoint).awaitTermination(120)
        return read_published(spark, root, "fct_revenue_trends")

    deliver(
        (1, 1, "2023-01-01T10:00:00Z", "5.00", "pending"),
        (2, 1, "2023-01-02T10:00:00Z", "7.00", "completed"),
    )
    # A retry completes order 1, a retry of order 2 loses, a new day arrives.
    mart = deliver(
        (1, 1, "2023-01-01T10:00:30Z", "5.00", "completed"),
        (2, 1, "2023-01-02T10:00:30Z", "70.00", "cancelled"),
        (3, 2, "2023-01-03T10:00:00Z", "1.00", "completed"),
    )
    assert [(str(r[0]), str(r[1])) for r in rows(mart)] == [("2023-01-01", "5.00"), ("2023-01-02", "7.00"), ("2023-01-03", "1.00")]
    assert rows(mart) == rows(daily_revenue(best_attempts(attempts_log(spark, root))))
    # Nothing new: the feed ends without a batch and the mart stays.
    feed = spark.readStream.schema(RAW_ORDERS_SCHEMA).parquet(inbox)
    run_order_feed(feed, root, checkpoint).awaitTermination(120)
    assert rows(read_published(spark, root, "fct_revenue_trends")) == rows(mart)


def test_a_retried_batch_counts_once(spark, rows, tmp_path):
    root = str(tmp_path / "root")
    for _ in range(2):  # as after a crash before the commit
        absorb_orders(raw_orders(spark, (1, 1, "2023-01-01T10:00:00Z", "5.00", "completed")), root, "feed", 0)
    assert attempts_log(spark, root).count() == 1
    assert [str(r[1]) for r in rows(read_published(spark, root, "fct_revenue_trends"))] == ["5.00"]


def test_a_new_checkpoint_overwrites_nothing(spark, rows, tmp_path):
    root = str(tmp_path / "root")
    for n in range(2):
        raw_orders(spark, (n, 1, f"2023-01-0{n + 1}T10:00:00Z", "5.00", "completed")).coalesce(1).write.parquet(str(tmp_path / f"inbox{n}"))
        feed = spark.readStream.schema(RAW_ORDERS_SCHEMA).parquet(str(tmp_path / f"inbox{n}"))
        run_order_feed(feed, root, str(tmp_path / f"checkpoint{n}")).awaitTermination(120)
    assert attempts_log(spark, root).count() == 2
    assert [str(r[1]) for r in rows(read_published(spark, root, "fct_revenue_trends"))] == ["5.00", "5.00"]


def test_batches_out_of_date_order(spark, rows, tmp_path):
    """Older days arriving later are kept; an order that moves leaves its old day; rows without id or date compete."""
    root = str(tmp_path / "root")
    batches = [
        [(1, 1, "2023-03-01T10:00:00Z", "5.00", "completed"), (None, 1, "2023-03-02T10:00:00Z", "1.00", "completed")],
        [(2, 1, "2023-01-01T10:00:00Z", "7.00", "completed"), (3, 1, "2023-01-05T10:00:00Z", "2.00", "completed")],
        [(2, 1, "2023-02-01T10:00:00Z", "6.00", "completed"), (None, 1, "2023-03-05T10:00:00Z", "9.00", "completed"), (4, 2, None, "3.00", "completed")],
        [(5, 1, "not valid", "-1.00", "completed")][:0],
    ]
    for number, batch in enumerate(batches):
        absorb_orders(raw_orders(spark, *batch), root, "feed", number)
        mart = read_published(spark, root, "fct_revenue_trends")
        assert rows(mart) == rows(daily_revenue(best_attempts(attempts_log(spark, root))))
    assert [(str(r[0]), str(r[1])) for r in rows(mart)][:4] == [
        ("2023-01-05", "2.00"), ("2023-02-01", "6.00"), ("2023-03-01", "5.00"), ("2023-03-05", "9.00"),
    ]


def test_old_versions_go_when_told(spark, tmp_path):
    root = str(tmp_path / "root")
    for n in range(3):
        publish_version({"t": spark.range(n + 1)}, root)
    assert len(drop_old_versions(spark, root, keep=2)) == 1 and drop_old_versions(spark, root, keep=2)
    assert read_published(spark, root, "t").count() == 3
    assert len(list((tmp_path / "root" / "t").iterdir())) == 2
    with pytest.raises(ValueError):
        drop_old_versions(spark, root, keep=0)


def test_late_events_are_kept_and_marked(spark, rows, tmp_path):
    inbox, root, checkpoint = (str(tmp_path / n) for n in ("inbox", "root", "checkpoint"))
    base = datetime(2024, 1, 1)
    schema = "user_id bigint, ts timestamp_ntz"
    deliveries = [[(1, base + timedelta(hours=5))], [(2, base), (1, base + timedelta(hours=4, minutes=45))], [(2, base + timedelta(minutes=10)), (None, None)]]
    for batch in deliveries:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(inbox)
        run_session_log(spark.readStream.schema(schema).parquet(inbox), root, checkpoint, "user_id", "ts").awaitTermination(120)
    fields = spark.read.parquet(inbox).schema
    log = logged_events(spark, root, fields)
    assert rows(log.filter("late"), "user_id", "ts") == [(2, base), (2, base + timedelta(minutes=10))]
    assert log.count() == 5
    found = all_sessions(spark, root, fields, "user_id", "ts")
    assert rows(found, "user_id", "total_events_count", "closed") == [(1, 2, False), (2, 2, True)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_streamed_sessions_equal_the_batch(spark, rows, tmp_path, kind):
    inbox, base = str(tmp_path / "events"), datetime(2024, 1, 1)
    events = [(u, base + timedelta(minutes=7 * i + (40 if i % 5 == 0 else 0))) for u in (1, 2) for i in range(30)]
    # One far later event moves the watermark past every session above.
    events.append((9, base + timedelta(days=3)))
    schema = f"user_id bigint, ts {kind}"
    spark.createDataFrame(events, schema).coalesce(1).write.parquet(inbox)
    sessions = stream_gap_sessions(spark.readStream.schema(schema).parquet(inbox), "user_id", "ts")
    query = (
        sessions.writeStream.format("memory")
        .queryName(f"sessions_{kind}")
        .outputMode("append")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    columns = ["user_id", "session_start_at", "session_end_at", "total_events_count"]
    batch = gap_sessions(spark.read.parquet(inbox).filter("user_id <> 9"), "user_id", "ts")
    assert rows(spark.table(f"sessions_{kind}"), *columns) == rows(batch, *columns)
