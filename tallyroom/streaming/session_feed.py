"""Gap sessions over a live event feed.

``stream_gap_sessions`` emits sessions once nothing on time can extend them.
``run_session_log`` keeps every event besides, and marks those that came too
late for the stream, so that nothing is lost unseen.  Each batch also leaves
its own sessions, partitioned by user, and its newest time.  Stretches of events
that lie within a gap of each other are one session whichever batch they came
in, so all sessions, closed and open, are merged from the batches' sessions,
and no event is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..operators.sessions import gap_sessions, merge_sessions
from ..session import apply_required_conf
from ..sources.runs import Runs
from ..sources.store import feed_id, read_if_present

#: Users are dealt to so many partitions.
USER_PARTS = 64
#: The runs of so many batches are merged into one.
MERGE_EVERY = 32


def stream_gap_sessions(events: DataFrame, user: str, ts: str, gap: str = "30 minutes", late_by: str = "1 hour") -> DataFrame:
    """Sessions that can no longer grow, from a streaming frame of events.

    The same rule as ``operators.sessions.gap_sessions``.  State per user is
    the open sessions, not their events; events later than ``late_by`` are
    dropped by the watermark.  A watermark needs an instant, so wall-clock
    times are read as UTC, where no hour repeats or is missing, and returned
    as wall-clock times.
    """
    kind = events.schema[ts].dataType
    apply_required_conf(events.sparkSession)
    timed = events.filter(F.col(user).isNotNull()).withColumn(ts, F.col(ts).cast("timestamp"))
    return (
        timed.withWatermark(ts, late_by)
        .groupBy(user, F.session_window(ts, gap).alias("session"))
        .agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).alias("total_events_count"))
        .select(
            user,
            F.col("start").cast(kind).alias("session_start_at"),
            F.col("end").cast(kind).alias("session_end_at"),
            "total_events_count",
        )
    )


def user_part(user: Column) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(USER_PARTS)).cast("int")


def session_runs(spark: SparkSession, root: str, schema: StructType, user: str, ts: str) -> Runs:
    """The sessions that each batch's own events make, by partition of users."""
    kind = schema[ts].dataType
    fields = [
        StructField(user, schema[user].dataType),
        StructField("session_start_at", kind),
        StructField("session_end_at", kind),
        StructField("total_events_count", LongType()),
        StructField("user_part", IntegerType()),
    ]
    return Runs(spark, f"{root.rstrip('/')}/sessions", StructType(fields), "user_part")


def newest_runs(spark: SparkSession, root: str, schema: StructType, ts: str) -> Runs:
    """One row per batch: its newest time and the gap that sessions were made with."""
    fields = [StructField("newest", schema[ts].dataType), StructField("gap", StringType()), StructField("kind", StringType())]
    return Runs(spark, f"{root.rstrip('/')}/newest", StructType(fields), "kind")


def absorb_events(
    batch: DataFrame, root: str, feed: str, batch_id: int, user: str, ts: str, gap: str = "30 minutes", late_by: str = "1 hour", merge_every: int = MERGE_EVERY
) -> None:
    """Log a batch of events with late ones marked, and add its sessions and its newest time.

    An event is late if it lies before the watermark: the newest time of the
    other batches, of which there is a row each, less ``late_by``.  A retried
    batch replaces what it wrote.
    """
    spark = apply_required_conf(batch.sparkSession)
    this, newest, sessions = (feed, batch_id), newest_runs(spark, root, batch.schema, ts), session_runs(spark, root, batch.schema, user, ts)
    last = newest.read(without=this).agg(F.max("newest")).first()[0]
    behind = F.col(ts) < F.lit(last) - F.expr(f"interval {late_by}") if last else F.lit(False)
    folder = f"{root.rstrip('/')}/events/feed={feed}/batch={batch_id}"
    batch.withColumn("late", F.coalesce(behind, F.lit(False))).write.mode("overwrite").parquet(folder)
    written = spark.read.schema(batch.schema).parquet(folder)
    own = gap_sessions(written.select(user, ts), user, ts, gap)
    sessions.write(own.withColumn("user_part", user_part(F.col(user))), *this)
    newest.write(written.agg(F.max(ts).alias("newest")).withColumns({"gap": F.lit(gap), "kind": F.lit("batch")}), *this)
    if (batch_id + 1) % merge_every == 0:
        sessions.merge(lambda rows: merge_sessions(rows, user, gap).withColumn("user_part", user_part(F.col(user))), *this)
        newest.merge(lambda rows: rows.groupBy("gap", "kind").agg(F.max("newest").alias("newest")), *this)


def run_session_log(
    events: DataFrame,
    root: str,
    checkpoint: str,
    user: str,
    ts: str,
    late_by: str = "1 hour",
    gap: str = "30 minutes",
    merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Absorb what the feed holds now into the log and the sessions under ``root``; one writer per root is assumed."""

    def absorb(batch: DataFrame, batch_id: int) -> None:
        feed = feed_id(batch.sparkSession, checkpoint)
        absorb_events(batch, root, feed, batch_id, user, ts, gap, late_by, merge_every)

    apply_required_conf(events.sparkSession)
    return (
        events.writeStream.foreachBatch(absorb)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def logged_events(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Every event received, with ``late``, ``feed`` and ``batch``; ``schema`` is the feed's."""
    fields = StructType([*schema.fields, *StructType().add("late", "boolean").add("feed", "string").add("batch", "long").fields])
    stored = read_if_present(spark, f"{root.rstrip('/')}/events", schema=fields)
    return spark.createDataFrame([], fields) if stored is None else stored


def all_sessions(
    spark: SparkSession,
    root: str,
    schema: StructType,
    user: str,
    ts: str,
    gap: str = "30 minutes",
    late_by: str = "1 hour",
    users: Sequence | None = None,
) -> DataFrame:
    """All gap sessions of the feed, late events included; ``closed`` if nothing on time can extend one any more.

    With ``users``, those of these users, for which only their partitions are
    read.  ``gap`` has to be the one that the feed was run with.
    """
    runs = session_runs(spark, root, schema, user, ts)
    if users is None:
        parts = runs.read()
    else:
        wanted = spark.createDataFrame([(u,) for u in users], StructType([StructField(user, schema[user].dataType)]))
        numbers = [r[0] for r in wanted.select(user_part(F.col(user))).distinct().collect()]
        parts = runs.read(numbers).join(F.broadcast(wanted.distinct()), user, "left_semi")
    newest = newest_runs(spark, root, schema, ts).read()
    other = newest.filter(F.col("gap") != gap).first()
    if other is not None:
        raise ValueError(f"the feed was run with a gap of {other['gap']}, not {gap}")
    watermark = newest.agg(F.max("newest") - F.expr(f"interval {late_by}")).scalar()
    return merge_sessions(parts, user, gap).withColumn("closed", F.col("session_end_at") + F.expr(f"interval {gap}") <= watermark)
