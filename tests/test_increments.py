"""State kept between loads: feeds by runs, buyers, cohort months, checksums, observed checks, tables by user."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyroom.operators import quality as q
from tallyroom.operators.buyers import buyer_bitmaps, count_buyers, merge_buyers
from tallyroom.operators.cohorts import cohort_activity, cohort_retention, cohort_sizes, merge_masks, month_masks, retention_from_masks
from tallyroom.operators.purchases import user_first_purchase
from tallyroom.operators.revenue import daily_revenue
from tallyroom.operators.sessions import gap_sessions, merge_sessions
from tallyroom.operators.staging import best_attempts, best_attempts_since
from tallyroom.plans.by_user import UserTables
from tallyroom.plans.checks import row_rules
from tallyroom.sources import Runs, read_published, write_attempts
from tallyroom.streaming import absorb_events, absorb_orders, all_sessions, attempts_log, best_runs, change_runs
from tallyroom.streaming.order_feed import span_of
from tallyroom.streaming.session_feed import session_runs

from .builders import raw_orders, staged_orders, staged_users

SPAN = 10


def files_read(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def scanned_rows(df):
    """Rows that the plan's file scans gave out, after ``df`` is collected."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    waiting, total = [plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan], 0
    while waiting:
        node = waiting.pop()
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        if hasattr(node, "plan") and node.nodeName().endswith("QueryStage"):
            waiting.append(node.plan())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return total


def order_batches():
    """Orders 0 to 59 on days of three months, later ones again and moved to other days and months."""
    first = [(i, i % 7, f"2023-0{1 + i % 3}-{1 + i % 20:02d}T10:00:00Z", f"{1 + i}.00", "completed" if i % 4 else "pending") for i in range(60)]
    again = [(i, i % 7, f"2023-0{1 + i % 3}-{1 + i % 20:02d}T11:00:00Z", "9.00", "completed") for i in range(0, 60, 4)]
    moved = [(5, 1, "2023-05-01T10:00:00Z", "2.50", "completed"), (7, 2, "2023-01-02T09:00:00Z", "1.00", "completed"), (None, 3, "2023-02-02T09:00:00Z", "4.00", "completed")]
    return [first[30:], first[:30] + again, moved, [(None, 3, "2023-02-03T09:00:00Z", "4.00", "completed"), (8, None, None, "1.00", "completed")]]


def test_order_feed_by_runs_equals_a_full_build(spark, rows, tmp_path):
    """After every batch, retried or not, before and after merges."""
    root = str(tmp_path / "root")
    for number, batch in enumerate(order_batches()):
        for _ in range(2 if number in (1, 2) else 1):  # one retry after a merge, one without
            absorb_orders(raw_orders(spark, *batch), root, "feed", number, span_ids=SPAN, merge_every=2)
        mart = read_published(spark, root, "fct_revenue_trends")
        assert rows(mart) == rows(daily_revenue(best_attempts(attempts_log(spark, root))))
    assert rows(best_runs(spark, root).read().drop("span")) == rows(best_attempts(attempts_log(spark, root)))
    # Two merges have left the current generation and the one before it.
    assert len(list((tmp_path / "root" / "best_attempts").glob("generation-*"))) == 2


def test_a_batch_reads_its_spans_and_months_only(spark, tmp_path):
    root = str(tmp_path / "root")
    for number, batch in enumerate(order_batches()[:2]):
        absorb_orders(raw_orders(spark, *batch), root, "feed", number, span_ids=SPAN)
    best, changes = best_runs(spark, root), change_runs(spark, root)
    batch = raw_orders(spark, (12, 1, "2023-01-13T12:00:00Z", "1.00", "completed"), (15, 1, "2023-01-16T12:00:00Z", "1.00", "completed"))
    spans = [r[0] for r in batch.select(span_of(ids=SPAN)).distinct().collect()]
    assert spans == [1]
    all_files, some_files = files_read(best.read()), files_read(best.read(spans))
    assert some_files and len(some_files) <= len(all_files) / 4 and all("span=1/" in f for f in some_files)
    some_months = files_read(changes.read(["2023-01"]))
    assert some_months and all("month=2023-01/" in f for f in some_months) and len(some_months) < len(files_read(changes.read()))
    assert not files_read(best.read([77]))


def test_runs_replace_and_merge(spark, rows, tmp_path):
    schema = spark.createDataFrame([], "k int, v int, part int").schema
    runs = Runs(spark, str(tmp_path / "state"), schema, "part")
    assert runs.read().count() == 0
    runs.write(spark.createDataFrame([(1, 1, 0), (2, 1, 1)], schema), "a", 0)
    runs.write(spark.createDataFrame([(1, 5, 0)], schema), "a", 1)
    runs.write(spark.createDataFrame([(1, 7, 0)], schema), "a", 1)
    assert rows(runs.read()) == [(1, 1, 0), (1, 7, 0), (2, 1, 1)]
    assert rows(runs.read(without=("a", 1))) == [(1, 1, 0), (2, 1, 1)]
    for batch in (1, 1, 2):
        runs.merge(lambda df: df.groupBy("k", "part").agg(F.sum("v").cast("int").alias("v")), "a", batch)
        runs.write(spark.createDataFrame([(1, 7, 0)], schema), "a", 1)  # retried after its merge
        assert rows(runs.read()) == [(1, 8, 0), (2, 1, 1)]
    assert rows(runs.read(parts=[1])) == [(2, 1, 1)]


def test_session_runs_equal_sessions_of_all_events(spark, rows, tmp_path):
    root, base = str(tmp_path / "root"), datetime(2024, 1, 1)
    events = [(u, base + timedelta(minutes=(17 * i * (u + 1)) % 2000)) for u in range(12) for i in range(25)] + [(None, base), (3, None)]
    schema = "user_id bigint, ts timestamp_ntz"
    everything = spark.createDataFrame(events, schema)
    for number in range(5):
        batch = spark.createDataFrame(events[number::5], schema)
        for _ in range(2 if number == 3 else 1):
            absorb_events(batch, root, "feed", number, "user_id", "ts", merge_every=2)
    want = gap_sessions(everything, "user_id", "ts")
    found = all_sessions(spark, root, everything.schema, "user_id", "ts")
    assert rows(found.drop("closed")) == rows(want)
    some = all_sessions(spark, root, everything.schema, "user_id", "ts", users=[4, 9, 4])
    assert rows(some.drop("closed")) == rows(want.filter("user_id in (4, 9)"))
    runs = session_runs(spark, root, everything.schema, "user_id", "ts")
    assert len(files_read(runs.read([r[0] for r in runs.read().select("user_part").limit(1).collect()]))) < len(files_read(runs.read()))
    with pytest.raises(ValueError, match="gap of 30 minutes"):
        all_sessions(spark, root, everything.schema, "user_id", "ts", gap="1 hour")


def test_sessions_within_others_merge(spark, rows):
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    parts = [(1, at(0), at(200), 9), (1, at(20), at(30), 2), (1, at(230), at(240), 1), (1, at(271), at(280), 1), (2, at(0), at(0), 1)]
    merged = merge_sessions(spark.createDataFrame(parts, "user_id int, session_start_at timestamp_ntz, session_end_at timestamp_ntz, total_events_count long"), "user_id")
    assert rows(merged) == [(1, 1, at(0), at(240), 12), (1, 2, at(271), at(280), 1), (2, 1, at(0), at(0), 1)]


ORDERS = (
    (1, 1, "2023-01-06", "1.00", "completed"),
    (2, 1, "2023-01-07", "1.00", "completed"),
    (3, 2, "2023-02-01", "1.00", "pending"),
    (4, 40_000, "2023-01-28", "1.00", "completed"),
    (5, -5, "2023-03-01", "1.00", "completed"),
    (6, 1, "2028-03-31", "1.00", "completed"),
    (7, None, "2023-05-02", "1.00", "completed"),
    (8, 0, None, "1.00", "completed"),
    (9, 0, "2023-01-31", "1.00", "completed"),
)
USERS = ((1, "2023-01-05"), (2, "2023-01-31"), (40_000, "2022-12-31"), (0, "2023-01-30"), (9, "2023-04-01"))


def test_buyers_of_months_from_days(spark, rows):
    orders = staged_orders(spark, *ORDERS)
    loads = [buyer_bitmaps(orders.filter(F.pmod("order_id", F.lit(3)) == k)) for k in range(3)]
    days = merge_buyers(loads[0].unionByName(loads[1]).unionByName(loads[2]).unionByName(loads[1]))
    month = F.date_format("order_date", "yyyy-MM")
    done = orders.filter("order_status = 'completed' and order_date is not null")
    assert rows(count_buyers(days, month)) == rows(done.groupBy(month.alias("period")).agg(F.count_distinct("user_id").alias("buyers")).filter("buyers > 0"))
    assert days.groupBy("order_date", "bucket").count().filter("count > 1").count() == 0


def test_cohorts_from_masks_of_loads(spark, rows):
    users, orders = staged_users(spark, *USERS), staged_orders(spark, *ORDERS)
    loads = [month_masks(orders.filter(F.pmod("order_id", F.lit(2)) == k)) for k in range(2)]
    masks = merge_masks(loads[0].unionByName(loads[1]).unionByName(loads[1]))
    assert rows(retention_from_masks(users, masks)) == rows(cohort_retention(users, orders))
    assert rows(retention_from_masks(users, month_masks(orders.limit(0)))) == rows(cohort_retention(users, orders.limit(0)))


def test_checksums_find_what_a_comparison_finds(spark, rows):
    left = spark.range(3000).select((F.col("id") % 1500).alias("k"), F.col("id").alias("v"), F.lit(None).cast("long").alias("w")).filter("v < 1500")
    right = left.withColumns({"v": F.when(F.col("k") == 77, -1).otherwise(F.col("v")), "w": F.when(F.col("k") == 99, F.col("w")).otherwise(F.col("w"))})
    swapped = right.withColumns({"v": F.when(F.col("k") != 5, F.col("v")), "w": F.when(F.col("k") == 5, F.col("v"))}).filter("k <> 1400")
    for other in (right, swapped, left.unionByName(left.limit(1).withColumn("k", F.lit(9999).cast("long")))):
        assert rows(q.compare_by_checksum(left, other, ["k"])) == rows(q.compare_frames(left, other, ["k"]))
    assert rows(q.compare_by_checksum(left, swapped, ["k"]), "k") == [(1400,), (5,), (77,)]


def test_equal_versions_are_not_joined(spark):
    table = spark.range(500).withColumn("v", F.col("id") * 2)
    same = q.compare_by_checksum(table, table.repartition(3), ["id"])
    assert same.count() == 0 and "SortMergeJoin" not in same._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in same._jdf.queryExecution().optimizedPlan().toString()


def test_rules_are_counted_while_writing(spark, rows, tmp_path):
    rules = [q.RowRule("not_null", "t", "k", F.col("k").isNull()), q.RowRule("positive", "t", None, F.col("v") < 0)]
    table = spark.createDataFrame([(1, -1), (None, -2), (None, 3), (4, None)], "k int, v int")
    counted = q.RuleCounts()
    counted.watch("t", table, rules).write.parquet(str(tmp_path / "t"))
    unread = spark.createDataFrame([], table.schema)  # a second scan would find nothing broken
    found = q.run_checks({"t": unread}, rules, counted)
    assert rows(found, "check", "violations", "passed") == [("not_null", 2, False), ("positive", 2, False)]
    assert rows(q.run_checks({"t": table}, rules)) == rows(found)
    assert "other" not in counted and counted.watch("other", table, rules) is table


def test_all_single_row_checks_can_be_counted_while_writing():
    assert len(row_rules()) == 53 + 1 + 3


def test_named_ids_skip_row_groups(spark, rows, tmp_path):
    """Ids that say nothing about time: the history's other row groups are not read."""
    path = str(tmp_path / "attempts")
    mixed = F.pmod(F.col("id") * 2654435761, F.lit(1 << 32))
    day = F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") / 100).cast("int"))
    history = spark.range(40_000).select(
        mixed.alias("order_id"), (F.col("id") % 50).alias("user_id"), day.cast("timestamp").alias("ordered_at"), day.alias("order_date"),
        F.lit(1).cast("decimal(12,2)").alias("order_value"), F.lit("completed").alias("order_status"),
    )
    write_attempts(history.repartitionByRange(40, "order_date"), path)
    stored = spark.read.schema(history.schema).parquet(path)
    ids = [r[0] for r in stored.filter("order_date = date'2023-03-01'").select("order_id").limit(3).collect()]
    assert scanned_rows(stored.filter(F.col("order_id").isin(*ids))) < 40_000 / 4
    since = stored.agg(F.max("order_date")).first()[0]
    found = best_attempts_since(stored, since)
    assert rows(found) == rows(best_attempts(stored).filter(F.col("order_date") == F.lit(since))) and found.count() == 100
    assert rows(best_attempts_since(stored, since - timedelta(days=8))) == rows(stored.filter(F.col("order_date") >= F.lit(since - timedelta(days=8))))


def test_models_by_user_shuffle_no_orders(spark, rows, tmp_path):
    orders = [(i, 1 + i % 40, f"2023-0{1 + i % 6}-0{1 + i % 9}", "1.00", "completed" if i % 3 else "pending") for i in range(400)]
    orders += [(1000 + i, 7, f"2023-03-1{i % 10}", "2.00", "completed") for i in range(600)] + [(5000, None, "2024-01-01", "1.00", "completed")]
    users = staged_users(spark, *((u, f"2023-0{1 + u % 3}-05") for u in range(1, 50)))
    staged = staged_orders(spark, *orders)
    tables = UserTables(users, staged, str(tmp_path / "by_user"), buckets=4, hot_share=3)
    assert tables.hot_ids == [7]
    assert rows(tables.first_purchase()) == rows(user_first_purchase(users, staged))
    assert rows(tables.retention()) == rows(cohort_retention(users, staged))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = user_first_purchase(tables.users, tables.orders)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        for part in (cohort_activity(tables.users, tables.orders), cohort_sizes(tables.users)):
            plan = part._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(user_id" not in plan and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
