"""Raw users, orders and events derived from the test tables.

The test tables are clean, so defects are derived from their keys: orphans,
non-positive amounts, conflicting retries, misspelt duplicate accounts, blank
fields, untrimmed labels.  Dates arrive as text, the way a CSV extract holds
them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.session import apply_required_conf

# Declared, so that reading starts without a job that looks at file footers.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


def _table(spark: SparkSession, sf_dir: str, name: str, as_stream: bool = False) -> DataFrame:
    apply_required_conf(spark)
    if as_stream:
        return spark.readStream.schema(SCHEMAS[name]).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str, as_stream: bool = False) -> DataFrame:
    """One in a hundred orders is followed by a retry, of four kinds.

    A retry is a second row made from the first, so rows are exploded and the
    table is read once.
    """
    base = _table(spark, sf_dir, "orders", as_stream).selectExpr(
        "o_orderkey as order_id",
        "if(o_orderkey % 67 = 0, o_custkey + 1000000, o_custkey) as user_id",
        "timestampadd(second, o_orderkey % 86400, o_orderdate) as ordered_ts",
        """cast(case o_orderkey % 125 when 0 then 0 when 1 then -o_totalprice else o_totalprice end
                as decimal(12,2)) as amount""",
        """case o_orderstatus when 'F' then 'completed' when 'O' then 'pending'
                else if(o_orderkey % 2 = 0, 'returned', 'cancelled') end as status""",
        "explode(if(o_orderkey % 100 = 0, array(-1L, o_orderkey % 400), array(-1L))) as retry",
    )
    return base.selectExpr(
        "order_id",
        "user_id",
        """date_format(if(retry = 100, timestampadd(second, 90, ordered_ts), ordered_ts),
                       "yyyy-MM-dd'T'HH:mm:ss'Z'") as order_date""",
        "cast(case retry when 200 then amount * 1.15 when 300 then 0 else amount end as decimal(12,2)) as order_amount",
        """case retry when 0 then if(status = 'completed', 'pending', 'completed')
                      when 300 then 'cancelled' else status end as order_status""",
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups precede the first order; some customers register again, misspelt, nine days later.

    A missing signup is blank for even customers and NULL for odd ones.
    """
    first_orders = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    customers = _table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    base = customers.join(first_orders, "o_custkey", "left").selectExpr(
        "o_custkey as key",
        "c_name as first_name",
        "if(o_custkey % 67 = 3, '', cast(c_nationkey as string)) as country",
        "if(o_custkey % 67 = 5, null, timestampadd(day, -(1 + o_custkey % 45), first_order)) as signup_ts",
        "explode(if(o_custkey % 25 = 1 or o_custkey % 100 = 0, array(false, true), array(false))) as again",
    )
    return base.selectExpr(
        "key + if(again, 500000, 0) as user_id",
        "first_name",
        "concat('c', key) as last_name",
        """if(again,
              concat('Cust', if(key % 4 = 0, '', '.'), key, '@',
                     elt(cast(key % 4 as int) + 1, 'GMIAL.com ', 'yaho.com', 'hotmal.com', 'outlok.com')),
              concat('cust.', key, '@',
                     elt(cast(key % 4 as int) + 1, 'gmail.com', 'yahoo.com', 'hotmail.com', 'outlook.com'))) as email""",
        "country",
        """coalesce(date_format(if(again, timestampadd(day, 9, signup_ts), signup_ts), 'yyyy-MM-dd HH:mm:ss'),
                    if(key % 2 = 0, '', null)) as signup_date""",
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A session is a user's day; some events have no session, some users are unknown."""
    return _table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "if(event_id % 97 = 0, user_id + 1000000, user_id) as user_id",
        "if(event_id % 211 = 0, null, concat('s_', user_id, '_', date_format(ts, 'yyyy-MM-dd'))) as session_id",
        "case event_type when 'view' then ' Page_View' when 'click' then 'add_to_cart' else event_type end as event_name",
        "cast(ts as string) as event_timestamp",
        "case user_id % 3 when 0 then 'Mobile' when 1 then 'desktop ' else 'tablet' end as device_type",
        "concat('/p/', event_id % 8) as page_url",
    )


def click_feed(spark: SparkSession, sf_dir: str, as_stream: bool = False) -> DataFrame:
    """The click feed as it is before any session id exists."""
    return _table(spark, sf_dir, "events", as_stream).select("event_id", "user_id", "ts")


RAW_FEEDS = {"users": raw_users, "orders": raw_orders, "events": raw_events}


# Key of each checked table; where the key is divisible by three, the other checked columns are made NULL.
NULL_KEYS = {
    "stg_users": "user_id",
    "stg_orders": "order_id",
    "stg_events": "event_id",
    "int_user_first_purchase": "user_id",
    "int_sessionized_events": "user_id",
    "monthly_cohort_retention": "month_number",
    "funnel_summary": "funnel_step_order",
    "fct_revenue_trends": "day(order_date)",
}


def nulled(table: str, df: DataFrame) -> DataFrame:
    """A checked table with missing values, and an unlisted funnel step."""
    key = NULL_KEYS[table]
    gone = F.expr(f"{key} % 3 = 0")
    broken = df.withColumns({c: F.when(~gone, F.col(c)) for c in df.columns if c not in key})
    if table == "funnel_summary":
        broken = broken.withColumn("funnel_step", F.expr("if(funnel_step = 'add_to_cart', 'basket', funnel_step)"))
    return broken


# Results made to violate the business checks.
DEFECTS = {
    "int_sessionized_events": lambda df: df.withColumn(
        "session_duration_seconds",
        F.expr("case total_events_count % 7 when 0 then -5 when 1 then 90000 else session_duration_seconds end"),
    ),
    "int_user_first_purchase": lambda df: df.withColumns(
        {
            "first_purchase_at": F.expr("if(user_id % 5 = 0, first_purchase_at - interval 400 days, first_purchase_at)"),
            "first_purchase_order_id": F.expr("if(user_id % 7 = 0, first_purchase_order_id + 1, first_purchase_order_id)"),
        }
    ),
    "fct_revenue_trends": lambda df: df.withColumn(
        "total_revenue", F.expr("cast(if(day(order_date) % 9 = 0, -total_revenue, total_revenue) as decimal(24,2))")
    ),
    "monthly_cohort_retention": lambda df: df.filter("month_number % 5 <> 2").withColumn(
        "retention_pct", F.expr("cast(if(month_number = 3, 101, retention_pct) as decimal(9,2))")
    ),
    "funnel_summary": lambda df: df.withColumn("session_count", F.expr("if(funnel_step_order = 3, 1000000000, session_count)")),
}
