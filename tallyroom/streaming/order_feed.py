"""Daily revenue kept current from a stream of order attempts.

Three things are kept: a log of all parsed attempts, which no batch reads; each
order's best attempt, partitioned by spans of order ids; and what each user's
orders add to each day, partitioned by month.  A batch reads the best attempts
of the id spans it touches, ranks its own attempts against them, and writes the
new best ones and the change of days: the old best attempt's share less, the
new one's more.  The days that changed are summed from their months' changes
and replaced in the mart.  So after any sequence of batches, in whatever order
their dates come, the mart equals one built from the whole log, at a cost that
follows the batch and not the log.  A feed can add attempts but not delete
them; deletions take a refresh from a snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType

from ..functions import mean_to_cents
from ..operators.revenue import REVENUE_COLUMNS, REVENUE_MONEY
from ..operators.staging import COMPLETED, ORDER_COLUMNS, attempts_of, best_attempts, parse_orders, valid_attempts
from ..session import apply_required_conf
from ..sources.raw import RAW_ORDERS_SCHEMA
from ..sources.runs import Runs
from ..sources.store import feed_id, materialise, publish_version, read_published, scratch_dir

MART = "fct_revenue_trends"

#: Orders whose ids lie in one span of this many are kept together, spans dealt to so many partitions.
SPAN_IDS, SPAN_PARTS = 1_000_000, 256
#: The runs of so many batches are merged into one.
MERGE_EVERY = 32

_CHANGES = StructType(
    [
        StructField("order_date", DateType()),
        StructField("user_id", LongType()),
        *(StructField(n, LongType()) for n in ("orders_held", "completed", "order_count", "valued")),
        StructField("value", DecimalType(24, 2)),
        StructField("month", StringType()),
    ]
)
_UNDATED = "undated"


def _log_folder(root: str) -> str:
    return f"{root.rstrip('/')}/order_attempts"


def _attempt_schema(spark: SparkSession) -> StructType:
    return valid_attempts(parse_orders(spark.createDataFrame([], RAW_ORDERS_SCHEMA))).schema


def attempts_log(spark: SparkSession, root: str) -> DataFrame:
    """Every valid order attempt received so far, parsed; the schema is declared, so no file is opened to infer it."""
    fields = _attempt_schema(spark)
    return spark.read.schema(fields).parquet(f"{_log_folder(root)}/feed=*/batch=*").select(*fields.names)


def best_runs(spark: SparkSession, root: str) -> Runs:
    """The best attempt of every order, by span of ids; a run holds the orders of its batch."""
    return Runs(spark, f"{root.rstrip('/')}/best_attempts", _attempt_schema(spark).add("span", IntegerType()), "span")


def change_runs(spark: SparkSession, root: str) -> Runs:
    """What every batch changed, by day and user, by month."""
    return Runs(spark, f"{root.rstrip('/')}/day_changes", _CHANGES, "month")


def span_of(order_id: str = "order_id", ids: int = SPAN_IDS) -> Column:
    """The partition of an order; attempts without an id have one of their own."""
    return F.coalesce(F.pmod(F.floor(F.col(order_id) / ids), F.lit(SPAN_PARTS)), F.lit(-1)).cast("int")


def _shares(best: DataFrame, sign: int) -> DataFrame:
    """What best attempts add to their days, or take away."""
    counts = (F.col("order_status") == COMPLETED) & F.col("order_date").isNotNull()
    one = lambda condition: F.when(condition, sign).otherwise(0).cast("long")
    return best.select(
        "order_date",
        "user_id",
        F.lit(sign).cast("long").alias("orders_held"),
        one(counts).alias("completed"),
        one(counts & F.col("order_id").isNotNull()).alias("order_count"),
        one(counts & F.col("order_value").isNotNull()).alias("valued"),
        F.when(counts, F.coalesce("order_value", F.lit(0)) * sign).otherwise(0).cast(REVENUE_MONEY).alias("value"),
    )


def _summed(changes: DataFrame) -> DataFrame:
    """One row per day and user; what cancels out is left away."""
    amounts = [f.name for f in _CHANGES.fields if f.name not in ("order_date", "user_id", "month")]
    sums = changes.groupBy("order_date", "user_id").agg(*(F.sum(a).cast(_CHANGES[a].dataType).alias(a) for a in amounts))
    some = sums.filter(" or ".join(f"{a} <> 0" for a in amounts))
    return some.withColumn("month", F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit(_UNDATED)))


def revenue_of_changes(changes: DataFrame) -> DataFrame:
    """The daily mart from changes that are complete for their days.

    A day is listed while any order's best attempt lies on it.
    """
    per_user = _summed(changes)
    total = F.sum("value")
    return (
        per_user.groupBy("order_date")
        .agg(
            F.sum("orders_held").alias("orders_held"),
            total.cast(REVENUE_MONEY).alias("total_revenue"),
            F.sum("order_count").alias("order_count"),
            F.count_if(F.col("user_id").isNotNull() & (F.col("completed") > 0)).alias("distinct_user_count"),
            mean_to_cents(total, F.sum("valued")).alias("average_order_value"),
        )
        .filter("orders_held > 0")
        .select(*REVENUE_COLUMNS)
    )


def _named_day(day: str = "order_date") -> Column:
    return F.coalesce(F.col(day).cast("string"), F.lit(_UNDATED))


def absorb_orders(batch: DataFrame, root: str, feed: str, batch_id: int, span_ids: int = SPAN_IDS, merge_every: int = MERGE_EVERY) -> None:
    """Log a batch of raw orders and bring the mart up to date with it.

    What a batch writes is named by feed and batch and replaced when it is
    retried, and it is worked out from the other batches' runs alone, so a
    failure at any point repeats neither orders nor revenue.
    """
    spark = apply_required_conf(batch.sparkSession)
    folder = f"{_log_folder(root)}/feed={feed}/batch={batch_id}"
    valid_attempts(parse_orders(batch)).write.mode("overwrite").parquet(folder)
    new = spark.read.schema(_attempt_schema(spark)).parquet(folder)
    if new.isEmpty():
        return
    best, changes = best_runs(spark, root), change_runs(spark, root)
    this = (feed, batch_id)
    with scratch_dir(spark, root) as scratch:
        spans = [r["span"] for r in new.select(span_of(ids=span_ids).alias("span")).distinct().collect()]
        ids = materialise(new.filter(F.col("order_id").isNotNull()).select("order_id").distinct(), f"{scratch}/ids")
        known = best.read(spans, without=this).select(*ORDER_COLUMNS)
        before = materialise(best_attempts(attempts_of(known, ids)), f"{scratch}/before")
        after = materialise(best_attempts(before.unionByName(new)), f"{scratch}/after")
        best.write(after.withColumn("span", span_of(ids=span_ids)), *this)
        changed = materialise(_summed(_shares(before, -1).unionByName(_shares(after, 1))), f"{scratch}/changed")
        changes.write(changed, *this)
        months = [r["month"] for r in changed.select("month").distinct().collect()]
        published = read_published(spark, root, MART)
        if published is None:
            publish_version({MART: revenue_of_changes(changes.read())}, root)
        elif months:
            days = changed.select(_named_day().alias("day")).distinct()
            on_days = changes.read(months).withColumn("day", _named_day()).join(days, "day", "left_semi").drop("day")
            others = published.withColumn("day", _named_day()).join(days, "day", "left_anti")
            publish_version({MART: others.select(*REVENUE_COLUMNS).unionByName(revenue_of_changes(on_days))}, root)
    if (batch_id + 1) % merge_every == 0:
        # Changes first: a batch retried in between finds its orders as they were, and its changes merged.
        changes.merge(_summed, *this)
        best.merge(lambda rows: best_attempts(rows.select(*ORDER_COLUMNS)).withColumn("span", span_of(ids=span_ids)), *this)


def run_order_feed(feed: DataFrame, root: str, checkpoint: str, **sizes: int) -> StreamingQuery:
    """Process what the feed holds now (``availableNow``), a streaming frame of raw orders.

    The runs are named by the streaming query's own id, so a new checkpoint
    does not overwrite what an older one received.  One writer per root is
    assumed; ``sizes`` are ``span_ids``, the same in all calls, and ``merge_every``.
    """

    def absorb(batch: DataFrame, batch_id: int) -> None:
        absorb_orders(batch, root, feed_id(batch.sparkSession, checkpoint), batch_id, **sizes)

    return (
        feed.writeStream.foreachBatch(absorb)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
