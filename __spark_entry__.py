
from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_queries import ORACLE  # noqa: E402
from sample_feeds import DEFECTS, RAW_FEEDS, click_feed, nulled, raw_events, raw_orders, raw_users  # noqa: E402
from tallyroom.functions import parse_instant  # noqa: E402
from tallyroom.operators import audit, quality  # noqa: E402
from tallyroom.operators.buyers import buyer_bitmaps, count_buyers, merge_buyers  # noqa: E402
from tallyroom.operators.cohorts import (  # noqa: E402
    cohort_curves,
    cohort_kpis,
    cohort_matrix,
    merge_masks,
    month_masks,
    retention_from_masks,
)
from tallyroom.operators.funnel import funnel_counts, funnel_summary, step_conversion  # noqa: E402
from tallyroom.operators.revenue import (  # noqa: E402
    daily_revenue,
    latest_active_day,
    revenue_kpis,
    revenue_slice,
    revenue_trends,
)
from tallyroom.operators.series import rolling_mean  # noqa: E402
from tallyroom.operators.sessions import assign_sessions, gap_sessions  # noqa: E402
from tallyroom.operators.staging import (  # noqa: E402
    best_attempts_since,
    parse_orders,
    parse_users,
    stage_orders,
    valid_attempts,
)
from tallyroom.plans.build import build_marts, read_mart, refresh_revenue, refresh_revenue_months  # noqa: E402
from tallyroom.plans.by_user import UserTables  # noqa: E402
from tallyroom.plans.checks import BUSINESS_CHECKS, accepted_checks, not_null_checks, row_rules, unique_checks  # noqa: E402
from tallyroom.plans.models import Models  # noqa: E402
from tallyroom.sources import (  # noqa: E402
    RAW_EVENTS_SCHEMA,
    RAW_ORDERS_SCHEMA,
    RAW_USERS_SCHEMA,
    TargetNotEmptyError,
    delete_folder,
    guarded_write,
    materialise,
    publish_version,
    read_months,
    read_published,
    read_raw_csv,
    read_raw_csv_with_rejects,
    read_raw_parquet,
    read_raw_tables,
    reject_counts,
    side_by_side,
    write_attempts,
    write_csv,
    write_months,
)
from tallyroom.streaming import (  # noqa: E402
    all_sessions,
    logged_events,
    run_order_feed,
    run_session_log,
    stream_gap_sessions,
)

Query = Callable[[SparkSession, str], DataFrame]
Waves = tuple[tuple[str, ...], ...]

# Models that several checked models read, in groups that derive from the ones before them.
STAGED: Waves = (("stg_users", "stg_orders", "stg_events"),)
SESSIONS = ("int_sessionized_events",)

#: Columns of the cohort matrix: eight years of elapsed months.
MATRIX_MONTHS = 96

SMOKE_DIR = "/root/testdata/sf0.001"


def _models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(lambda table: RAW_FEEDS[table](spark, sf_dir))


def _civil(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock timestamps, the form DuckDB returns."""
    instants = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in instants})


def _model(name: str) -> Query:
    return lambda spark, sf_dir: _civil(_models(spark, sf_dir).table(name))


def _revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_revenue(stage_orders(raw_orders(spark, sf_dir)))


def _retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _models(spark, sf_dir).monthly_cohort_retention


def _incremental_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A mart built from an earlier load, and a later snapshot that lost the mart's last day.

    Both derive from the staged orders, which are stored, so that the raw table is parsed and ranked once.
    """
    orders = materialise(stage_orders(raw_orders(spark, sf_dir)), f"{_output_root(spark, 'incremental')}/stg_orders")
    last_day = orders.agg(F.max("order_date")).scalar()
    earlier = orders.filter((F.col("order_date") <= F.date_sub(last_day, 10)) & (F.col("order_id") % 13 != 0))
    target = daily_revenue(earlier)
    deleted = target.agg(F.max("order_date")).scalar()
    return target, orders.filter(F.col("order_date") != deleted)


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, orders = _incremental_inputs(spark, sf_dir)
    return revenue_trends(orders, existing=target)


def _slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, orders = _incremental_inputs(spark, sf_dir)
    start = target.agg(F.date_sub(F.max("order_date"), 7)).scalar()
    return revenue_slice(orders, target, start)


def _rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = {"total_revenue": "revenue_7d_mean", "average_order_value": "aov_7d_mean"}
    daily = _revenue(spark, sf_dir).select("order_date", *means)
    return rolling_mean(daily, "order_date", means, rows=7)


def _curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    point = lambda p: F.concat(p["month_number"].cast("string"), F.lit(":"), p["retention_pct"].cast("string"))
    return cohort_curves(_retention(spark, sf_dir)).withColumn("curve", F.array_join(F.transform("curve", point), ","))


def _parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _output_root(spark, "revenue_parity")
    versions = [materialise(mart(spark, sf_dir), f"{root}/{mart.__name__}") for mart in (_incremental, _revenue)]
    differences = quality.compare_by_checksum(*versions, ["order_date"])
    return differences.withColumn("differs_in", F.array_join("differs_in", ","))


class _Seeded(Models):
    """Models whose results are broken before they are checked."""

    int_sessionized_events = property(lambda self: DEFECTS["int_sessionized_events"](Models.int_sessionized_events.func(self)))
    int_user_first_purchase = property(lambda self: DEFECTS["int_user_first_purchase"](Models.int_user_first_purchase.func(self)))
    fct_revenue_trends = property(lambda self: DEFECTS["fct_revenue_trends"](Models.fct_revenue_trends.func(self)))
    monthly_cohort_retention = property(lambda self: DEFECTS["monthly_cohort_retention"](Models.monthly_cohort_retention.func(self)))
    funnel_summary = property(lambda self: DEFECTS["funnel_summary"](Models.funnel_summary.func(self)))


def _stored_models(spark: SparkSession, sf_dir: str, name: str, waves: Waves, counted: quality.RuleCounts | None = None) -> Models:
    """Models that store the tables several others read, so each raw table is parsed once; single-row checks are counted as they are written."""
    root, stored = _output_root(spark, name), {model for wave in waves for model in wave}
    rules = row_rules() if counted is not None else []

    def keep(model: str, df: DataFrame) -> DataFrame:
        if model not in stored:
            return df
        return materialise(df if counted is None else counted.watch(model, df, rules), f"{root}/{model}")

    models = Models(lambda table: RAW_FEEDS[table](spark, sf_dir), keep=keep)
    for wave in waves:
        side_by_side(spark, models.table, wave)
    return models


def _run(select: Callable[[Models], list[quality.Check]], store_as: str = "", waves: Waves = ()) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        counted = quality.RuleCounts()
        models = _stored_models(spark, sf_dir, store_as, waves, counted) if store_as else _models(spark, sf_dir)
        checks = select(models)
        return quality.run_checks({c.table: models.table(c.table) for c in checks}, checks, counted)

    return query


def _business(check: str) -> Query:
    return _run(lambda models: [BUSINESS_CHECKS[check](models)])


def _seeded(check: str) -> Query:
    """A business check on results that violate it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        models = _Seeded(lambda table: RAW_FEEDS[table](spark, sf_dir))
        rule = BUSINESS_CHECKS[check](models)
        return quality.run_checks({rule.table: getattr(models, rule.table)}, [rule])

    return query


def _seeded_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The null and listing checks on tables with nulls and an unlisted step."""
    models = _stored_models(spark, sf_dir, "dq_columns_seeded", (*STAGED, SESSIONS))
    checks = [*not_null_checks(), *accepted_checks()]
    tables = {c.table: nulled(c.table, models.table(c.table)) for c in checks}
    return quality.run_checks(tables, checks)


def _sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["order_id", "ordered_at", "order_value", "order_status"]
    bad = audit.sample_rows(parse_orders(raw_orders(spark, sf_dir)), F.col("order_value") <= 0, columns, 5)
    return _civil(bad.select("order_id", "user_id", "ordered_at", "order_value", "order_status"))


def _output_root(spark: SparkSession, name: str) -> str:
    """The folder for what a query writes, on storage that driver and executors share.

    Each session has one per query; what an earlier call left there is removed.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    root = f"{shared.rstrip('/')}/tallyroom-output/{spark.sparkContext.applicationId}/{name}"
    delete_folder(spark, root)
    return root


def _load_csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders written as a CSV extract and loaded back by position."""
    extract = f"{_output_root(spark, 'load_csv_orders')}/orders_csv"
    write_csv(raw_orders(spark, sf_dir), extract, RAW_ORDERS_SCHEMA.names)
    return _civil(stage_orders(read_raw_csv(spark, extract, RAW_ORDERS_SCHEMA)))


def _revenue_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental scenario through the versioned store."""
    root = _output_root(spark, "revenue_published")
    target, orders = _incremental_inputs(spark, sf_dir)
    publish_version({"fct_revenue_trends": target}, root, replace=False)
    refresh_revenue(spark, orders, root)
    return read_mart(spark, root, "fct_revenue_trends")


def _revenue_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental scenario through a month-partitioned table."""
    table = f"{_output_root(spark, 'revenue_by_month')}/revenue"
    target, orders = _incremental_inputs(spark, sf_dir)
    write_months(target, "order_date", table)
    refresh_revenue_months(spark, orders, table)
    return read_months(spark, table)


def _order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _output_root(spark, "order_feed_revenue")
    run_order_feed(raw_orders(spark, sf_dir, as_stream=True), root, f"{root}/checkpoint").awaitTermination()
    return read_published(spark, root, "fct_revenue_trends")


def _session_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _output_root(spark, "session_feed")
    closed = stream_gap_sessions(click_feed(spark, sf_dir, as_stream=True), "user_id", "ts")
    (
        closed.writeStream.outputMode("append")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/sessions", format="parquet")
        .awaitTermination()
    )
    return spark.read.schema(closed.schema).parquet(f"{root}/sessions")


def _deliver(spark: SparkSession, rows: DataFrame, part: Column, inbox: str, run: Callable[[DataFrame], None], parts: int = 3) -> None:
    """Deliver ``rows`` in ``parts`` batches, each with rows of every date, and run the feed after each."""
    for number in range(parts):
        rows.filter(part == number).write.mode("append").parquet(inbox)
        run(spark.readStream.schema(rows.schema).parquet(inbox))


def _order_feed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries out of date order; the attempts of one order arrive in different ones."""
    root = _output_root(spark, "order_feed_batches")
    feed = lambda rows: run_order_feed(rows, f"{root}/feed", f"{root}/checkpoint").awaitTermination()
    orders = raw_orders(spark, sf_dir)
    _deliver(spark, orders, F.pmod(F.xxhash64("order_id", "order_status", "order_amount"), F.lit(3)), f"{root}/inbox", feed)
    return read_published(spark, f"{root}/feed", "fct_revenue_trends")


def _session_log(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, DataFrame]:
    root, clicks = _output_root(spark, name), click_feed(spark, sf_dir)
    feed = lambda rows: run_session_log(rows, f"{root}/feed", f"{root}/checkpoint", "user_id", "ts").awaitTermination()
    _deliver(spark, clicks, F.pmod(F.col("event_id"), F.lit(3)), f"{root}/inbox", feed)
    return f"{root}/feed", clicks


def _session_feed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every session, closed and open, of a feed that came out of time order."""
    root, clicks = _session_log(spark, sf_dir, "session_feed_batches")
    return all_sessions(spark, root, clicks.schema, "user_id", "ts")


def _session_feed_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that came after the watermark, by batch."""
    root, clicks = _session_log(spark, sf_dir, "session_feed_late")
    return logged_events(spark, root, clicks.schema).groupBy("batch").agg(
        F.count(F.lit(1)).alias("events"), F.count_if("late").alias("late_events")
    )


def _build(mart: str, name: str) -> Query:
    """All marts built from an earlier load, then built again, incrementally, on all orders."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _output_root(spark, name)
        raw = {table: feed(spark, sf_dir) for table, feed in RAW_FEEDS.items()}
        earlier = raw | {"orders": raw["orders"].filter(F.col("order_id") % 13 != 0)}
        build_marts(spark, earlier, root)
        build_marts(spark, raw, root, with_checks=mart == "dq_results")
        return read_mart(spark, root, mart)

    return query


def _deletion_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish from raw attempts, lose the newest active day at the source, refresh twice, compare with the source."""
    root = _output_root(spark, "deletion_recovery")
    attempts = materialise(valid_attempts(parse_orders(raw_orders(spark, sf_dir))), f"{root}/attempts")
    refresh_revenue(spark, attempts, f"{root}/marts")
    lost = latest_active_day(read_published(spark, f"{root}/marts", "fct_revenue_trends")).first()["order_date"]
    remaining = attempts.filter(F.col("order_date") != F.lit(lost))
    for _ in range(2):
        refresh_revenue(spark, remaining, f"{root}/marts")
    mart = read_mart(spark, f"{root}/marts", "fct_revenue_trends")
    staged = best_attempts_since(remaining, dt.date(1970, 1, 1))
    wrong = quality.revenue_mismatches(mart, staged).select("order_date", F.lit(True).alias("differs"))
    return mart.join(wrong, "order_date", "left").withColumn("differs", F.coalesce("differs", F.lit(False)))


def _attempts_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw attempts with retries on both sides of the cut: every fifth order was also tried three days earlier."""
    attempts = valid_attempts(parse_orders(raw_orders(spark, sf_dir)))
    earlier = attempts.filter(F.col("order_id") % 5 == 0).withColumns(
        {
            "ordered_at": F.col("ordered_at") - F.expr("interval 3 days"),
            "order_date": F.date_sub("order_date", 3),
            "order_status": F.when(F.col("order_id") % 10 == 0, "completed").otherwise("pending"),
        }
    )
    both = attempts.unionByName(earlier)
    since = both.agg(F.date_sub(F.max("order_date"), 30)).first()[0]
    return _civil(best_attempts_since(both, since))


def _load_raw_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three CSV extracts loaded, published together and read back."""
    root = _output_root(spark, "load_raw_tables")
    schemas = {"users": RAW_USERS_SCHEMA, "orders": RAW_ORDERS_SCHEMA, "events": RAW_EVENTS_SCHEMA}
    for table, schema in schemas.items():
        write_csv(RAW_FEEDS[table](spark, sf_dir), f"{root}/{table}_csv", schema.names)
    publish_version(read_raw_tables(spark, {t: f"{root}/{t}_csv" for t in schemas}), f"{root}/raw", replace=False)
    keys = {"users": "user_id", "orders": "order_id", "events": "event_id"}
    counts = [
        read_published(spark, f"{root}/raw", table).agg(
            F.lit(table).alias("table"), F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("distinct_keys"),
            F.sum(key).alias("sum_of_keys"),
        )
        for table, key in keys.items()
    ]
    return counts[0].union(counts[1]).union(counts[2])


def _buyers_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads leave their days' bitmaps; months are counted from these, without the orders."""
    path = f"{_output_root(spark, 'buyers_per_month')}/days"
    orders = stage_orders(raw_orders(spark, sf_dir))
    for load in range(2):
        buyer_bitmaps(orders.filter(F.pmod("order_id", F.lit(2)) == load)).write.mode("append").parquet(path)
    days = merge_buyers(spark.read.parquet(path))
    return count_buyers(days, F.date_format("order_date", "yyyy-MM")).withColumnRenamed("period", "month")


def _retention_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohorts from the month masks that two loads left."""
    path = f"{_output_root(spark, 'cohort_retention_merged')}/masks"
    models = _models(spark, sf_dir)
    for load in range(2):
        month_masks(models.stg_orders.filter(F.pmod("order_id", F.lit(2)) == load)).write.mode("append").parquet(path)
    masks = materialise(merge_masks(spark.read.parquet(path)), f"{path}_merged")
    return retention_from_masks(models.stg_users, masks)


def _attempts_since_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attempts of the last days, in a history whose ids say nothing about time."""
    path = f"{_output_root(spark, 'attempts_since_shuffled')}/attempts"
    attempts = valid_attempts(parse_orders(raw_orders(spark, sf_dir)))
    mixed = F.pmod(F.col("order_id") * 2654435761, F.lit(1 << 32))
    write_attempts(attempts.withColumn("order_id", mixed), path)
    stored = spark.read.schema(attempts.schema).parquet(path)
    since = stored.agg(F.date_sub(F.max("order_date"), 2)).first()[0]
    return _civil(best_attempts_since(stored, since))


def _by_user(spark: SparkSession, sf_dir: str, name: str) -> UserTables:
    models = _models(spark, sf_dir)
    return UserTables(models.stg_users, models.stg_orders, _output_root(spark, name), buckets=8)


def _broken_orders(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    """An extract of orders in which some lines are broken, loaded: good rows and rejects."""
    path = f"{_output_root(spark, name)}/lines"
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_ORDERS_SCHEMA.names]
    kind = lambda *k: F.pmod("order_id", F.lit(50)).isin(*k)
    text[0] = F.when(kind(17), "").when(kind(19), F.concat(F.lit("o"), text[0])).otherwise(text[0])
    text[1] = F.when(kind(13), F.concat(F.lit("u"), text[1])).otherwise(text[1])
    text[3] = F.when(kind(11, 19), "n/a").otherwise(text[3])
    line = F.when(kind(3), F.concat_ws(",", *text[:-1])).when(kind(7), F.concat_ws(",", *text, F.lit("more")))
    raw_orders(spark, sf_dir).select(line.otherwise(F.concat_ws(",", *text)).alias("value")).write.text(path)
    return read_raw_csv_with_rejects(spark, path, RAW_ORDERS_SCHEMA, header=False)


def _guarded_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load does to a target: the first write, a second one, a forced one, and one to a target that isn't allowed."""
    target = f"{_output_root(spark, 'guarded_load')}/orders"
    orders = raw_orders(spark, sf_dir)
    half = orders.filter("order_id % 2 = 0")
    steps = [("first", half, {}), ("second", orders, {}), ("forced", orders, {"replace": True}), ("elsewhere", half, {"allowed_targets": ["raw"], "replace": True})]
    outcomes = []
    for number, (step, rows, options) in enumerate(steps, 1):
        try:
            guarded_write(rows, target, **options)
            outcome = "written"
        except TargetNotEmptyError:
            outcome = "refused"
        except ValueError:
            outcome = "not allowed"
        outcomes.append((number, step, outcome, spark.read.parquet(target).count()))
    return spark.createDataFrame(outcomes, "number int, step string, outcome string, row_count long")


def _parquet_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders staged from Parquet that names the amount its own way and has columns that aren't wanted."""
    path = f"{_output_root(spark, 'load_parquet_orders')}/orders"
    upstream = raw_orders(spark, sf_dir).withColumnsRenamed({"order_amount": "amount_total"}).withColumn("channel", F.lit("web"))
    upstream.write.parquet(path)
    return _civil(stage_orders(read_raw_parquet(spark, path, RAW_ORDERS_SCHEMA.names, {"amount_total": "order_amount"})))


def _exact_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order times read by one exact pattern."""
    orders = raw_orders(spark, sf_dir)
    exact = parse_instant(F.col("order_date"), orders.schema["order_date"].dataType, exact_format="yyyy-MM-dd'T'HH:mm:ss'Z'")
    return _civil(orders.select("order_id", exact.alias("ordered_at"), "order_amount"))


def _models_as_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report in SQL over the models' views."""
    _models(spark, sf_dir).register_views("shop_")
    return spark.sql(
        """
        select u.country, count(*) as users, count_if(f.has_purchased) as buyers, sum(f.total_lifetime_value) as lifetime_value
        from shop_stg_users u join shop_int_user_first_purchase f using (user_id)
        group by u.country
        """
    )


def _report_order(mart: str, order_by: tuple[str, ...], name: str) -> Query:
    """A published mart with each row's place in the report."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _output_root(spark, name)
        build_marts(spark, {table: feed(spark, sf_dir) for table, feed in RAW_FEEDS.items()}, root)
        ordered = read_mart(spark, root, mart, order_by=order_by).withColumn("at", F.monotonically_increasing_id())
        return ordered.withColumn("position", F.row_number().over(Window.orderBy("at"))).drop("at")

    return query


def entry(spark: SparkSession) -> DataFrame:
    """Daily revenue from raw orders: parse, filter, resolve retries, aggregate."""
    return _revenue(spark, SMOKE_DIR)


def _llm() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the text operators and their pipeline, if they are installed."""
    try:
        import corpus_pipeline
        from tallyroom.llm.queries import ORACLE as sql
        from tallyroom.llm.queries import QUERIES
    except ModuleNotFoundError as error:
        installed = (Path(__file__).resolve().parent / "tallyroom" / "llm" / "__init__.py").exists()
        if error.name == "corpus_pipeline" or (not installed and (error.name or "").startswith("tallyroom.llm")):
            return {}, {}
        raise
    pipeline_sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return QUERIES | {"pipeline": corpus_pipeline.run}, sql | pipeline_sql


def _core_queries() -> dict[str, Query]:
    return {
        "stg_users": _model("stg_users"),
        "stg_orders": _model("stg_orders"),
        "stg_events": _model("stg_events"),
        "user_first_purchase": _model("int_user_first_purchase"),
        "sessionized_events": _model("int_sessionized_events"),
        "funnel_summary": _model("funnel_summary"),
        "funnel_step_lag": lambda s, d: step_conversion(
            funnel_counts(_models(s, d).int_sessionized_events).drop("previous_count", "top_count"),
            "funnel_step_order",
            "session_count",
        ),
        "funnel_distinct_sessions": lambda s, d: funnel_summary(
            _models(s, d).int_sessionized_events, distinct_sessions=True
        ),
        "revenue_trends_full": _revenue,
        "revenue_trends_incremental": _incremental,
        "revenue_slice": _slice,
        "revenue_rolling_7": _rolling,
        "revenue_kpis": lambda s, d: revenue_kpis(_revenue(s, d)),
        "latest_active_day": lambda s, d: latest_active_day(_revenue(s, d)),
        "cohort_retention": _retention,
        "cohort_matrix": lambda s, d: cohort_matrix(_retention(s, d), months=MATRIX_MONTHS),
        "cohort_curves": _curves,
        "cohort_kpis": lambda s, d: cohort_kpis(_retention(s, d)),
        "dq_unique": _run(unique_checks, "dq_unique", STAGED),
        "dq_not_null": _run(lambda _models: not_null_checks(), "dq_not_null", (*STAGED, SESSIONS)),
        "dq_accepted": _run(lambda _models: accepted_checks()),
        "dq_session_duration": _business("session_duration"),
        "dq_causality": _business("purchase_after_signup"),
        "dq_first_completed": _business("first_purchase_completed"),
        "dq_revenue_non_negative": _business("revenue_non_negative"),
        "dq_revenue_reconcile": _business("revenue_reconciles"),
        "dq_retention_range": _business("retention_range"),
        "dq_cohort_spine": _business("cohort_spine_complete"),
        "dq_funnel_monotonic": _business("funnel_monotonic"),
        "dq_columns_seeded": _seeded_columns,
        "dq_session_duration_seeded": _seeded("session_duration"),
        "dq_causality_seeded": _seeded("purchase_after_signup"),
        "dq_first_completed_seeded": _seeded("first_purchase_completed"),
        "dq_revenue_non_negative_seeded": _seeded("revenue_non_negative"),
        "dq_revenue_reconcile_seeded": _seeded("revenue_reconciles"),
        "dq_retention_range_seeded": _seeded("retention_range"),
        "dq_cohort_spine_seeded": _seeded("cohort_spine_complete"),
        "dq_funnel_monotonic_seeded": _seeded("funnel_monotonic"),
        "dq_shared_sessions": lambda s, d: quality.unique(_models(s, d).int_sessionized_events, "session_id"),
        "revenue_parity": _parity,
        "audit_users": lambda s, d: audit.audit_users(raw_users(s, d)),
        "audit_orders": lambda s, d: audit.audit_orders(raw_orders(s, d), raw_users(s, d)),
        "audit_events": lambda s, d: audit.audit_events(raw_events(s, d), raw_users(s, d)),
        "audit_duplicate_conflicts": lambda s, d: audit.duplicate_conflicts(
            parse_orders(raw_orders(s, d)), "order_id", ["order_value", "order_status", "ordered_at"]
        ),
        "audit_duplicate_accounts": lambda s, d: _civil(audit.duplicate_accounts(raw_users(s, d))),
        "signups_per_month": lambda s, d: audit.count_by_month(parse_users(raw_users(s, d)), "signup_date"),
        "orders_per_weekday": lambda s, d: audit.count_by_weekday(parse_orders(raw_orders(s, d)), "order_date"),
        "weekend_share": lambda s, d: audit.weekend_share(stage_orders(raw_orders(s, d))),
        "attrition": lambda s, d: audit.attrition(raw_users(s, d), raw_orders(s, d), raw_events(s, d)),
        "sample_non_positive_orders": _sample,
        "gap_sessions": lambda s, d: gap_sessions(click_feed(s, d), "user_id", "ts"),
        "load_csv_orders": _load_csv_orders,
        "revenue_published": _revenue_published,
        "revenue_by_month": _revenue_by_month,
        "order_feed_revenue": _order_feed,
        "order_feed_batches": _order_feed_batches,
        "session_feed": _session_feed,
        "session_feed_batches": _session_feed_batches,
        "session_feed_late": _session_feed_late,
        "build_marts_revenue": _build("fct_revenue_trends", "build_marts_revenue"),
        "build_marts_cohorts": _build("monthly_cohort_retention", "build_marts_cohorts"),
        "build_marts_funnel": _build("funnel_summary", "build_marts_funnel"),
        "build_marts_checks": _build("dq_results", "build_marts_checks"),
        "deletion_recovery": _deletion_recovery,
        "attempts_since": _attempts_since,
        "load_raw_tables": _load_raw_tables,
        "buyers_per_month": _buyers_per_month,
        "cohort_retention_merged": _retention_merged,
        "attempts_since_shuffled": _attempts_since_shuffled,
        "first_purchase_by_user": lambda s, d: _by_user(s, d, "first_purchase_by_user").first_purchase(),
        "cohort_retention_by_user": lambda s, d: _by_user(s, d, "cohort_retention_by_user").retention(),
        "load_broken_orders": lambda s, d: _broken_orders(s, d, "load_broken_orders")[0],
        "load_broken_orders_rejects": lambda s, d: reject_counts(_broken_orders(s, d, "load_broken_orders_rejects")[1]),
        "guarded_load": _guarded_load,
        "load_parquet_orders": _parquet_orders,
        "exact_order_times": _exact_times,
        "models_as_views": _models_as_views,
        "report_order_cohorts": _report_order("monthly_cohort_retention", ("cohort_month", "month_number"), "report_order_cohorts"),
        "report_order_funnel": _report_order("funnel_summary", ("funnel_step_order",), "report_order_funnel"),
        "gap_session_events": lambda s, d: assign_sessions(click_feed(s, d), "user_id", "ts"),
    }


def queries() -> dict[str, Query]:
    return _core_queries() | _llm()[0]


def oracle_sql() -> dict[str, str]:
    return ORACLE | _llm()[1]
