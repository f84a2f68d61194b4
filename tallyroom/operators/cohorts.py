"""Monthly cohort retention and its dashboard shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import month_number, month_start, percent
from .staging import COMPLETED

EPOCH_DAY = "1970-01-01"
#: Months in one word of a user's stored months.
WORD_MONTHS = 60


def user_cohorts(users: DataFrame) -> DataFrame:
    """Distinct user and signup month."""
    return users.select("user_id", month_start(F.col("signup_date")).alias("cohort_month")).distinct()


def last_observed_day(orders: DataFrame, users: DataFrame) -> DataFrame:
    """One row, ``last_day``: the latest order of any status or signup."""
    seen = orders.agg(F.max("order_date").alias("day")).unionAll(users.agg(F.max("signup_date").alias("day")))
    return seen.agg(F.coalesce(F.max("day"), F.lit(EPOCH_DAY).cast("date")).alias("last_day"))


def month_spine(cohorts: DataFrame, last_day: DataFrame) -> DataFrame:
    """A row for each elapsed month of each cohort, up to the observed horizon.

    ``cohorts`` is small (one row per calendar month); the horizon is a scalar
    subquery, so no join is involved.
    """
    horizon = month_number(F.col("cohort_month"), last_day.scalar())
    elapsed = F.sequence(F.lit(0), F.greatest(F.lit(0), horizon))
    return cohorts.select("*", F.explode(elapsed).alias("month_number")).withColumn(
        "activity_month", F.add_months("cohort_month", F.col("month_number"))
    )


def cohort_activity(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Buyers per cohort and calendar month.

    Orders are first reduced to one row per user holding the set of months
    with a purchase, which is bounded by the calendar.  The sets merge
    map-side, so a user with very many orders is a single row per task, and
    their shuffle by user also serves the join.  Users and months are then
    unique, which makes the distinct count a plain count.
    """
    active_months = (
        orders.filter(F.col("order_status") == COMPLETED)
        .groupBy("user_id")
        .agg(F.collect_set(month_start(F.col("order_date"))).alias("months"))
    )
    return (
        active_months.join(user_cohorts(users), "user_id")
        .select("cohort_month", F.explode("months").alias("activity_month"))
        .groupBy("cohort_month", "activity_month")
        .agg(F.count(F.lit(1)).alias("active_users"))
    )


def month_masks(orders: DataFrame) -> DataFrame:
    """``user_id``, ``word``, ``months``: a bit per month in which a user bought, 60 months to a word; a row or a few per user.

    The row without a user holds, as ``last_day``, the latest order of any
    status; it is what a horizon needs of the orders.
    """
    month = F.col("order_date")
    index = (F.year(month) - 1970) * 12 + F.month(month) - 1
    bought = orders.filter((F.col("order_status") == COMPLETED) & F.col("user_id").isNotNull() & month.isNotNull())
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(index, F.lit(WORD_MONTHS)))
    masks = bought.select("user_id", F.floor(index / WORD_MONTHS).cast("int").alias("word"), bit.alias("months"))
    masks = masks.groupBy("user_id", "word").agg(F.bit_or("months").alias("months"))
    return masks.unionByName(orders.agg(F.max("order_date").alias("last_day")), allowMissingColumns=True)


def merge_masks(masks: DataFrame) -> DataFrame:
    """The masks of several loads as one."""
    return masks.groupBy("user_id", "word").agg(F.bit_or("months").alias("months"), F.max("last_day").alias("last_day"))


def _mask_activity(users: DataFrame, masks: DataFrame) -> DataFrame:
    """Buyers per cohort and calendar month from masks; users and months are unique, so rows are counted."""
    set_bit = lambda i: F.call_function("shiftright", "months", i).bitwiseAND(F.lit(1).cast("long")) == 1
    bits = F.filter(F.sequence(F.lit(0), F.lit(WORD_MONTHS - 1)), set_bit)
    indexes = F.transform(bits, lambda i: i + F.col("word") * WORD_MONTHS)
    months = masks.filter(F.col("user_id").isNotNull()).select("user_id", F.explode(indexes).alias("index"))
    named = F.make_date(F.floor(F.col("index") / 12).cast("int") + 1970, F.pmod("index", F.lit(12)) + 1, F.lit(1))
    return (
        months.join(user_cohorts(users), "user_id")
        .groupBy("cohort_month", named.alias("activity_month"))
        .agg(F.count(F.lit(1)).alias("active_users"))
    )


def retention_from_masks(users: DataFrame, masks: DataFrame) -> DataFrame:
    """``cohort_retention`` from stored months; the orders are not read."""
    orders_seen = masks.select(F.col("last_day").alias("order_date"))
    return retention_from_activity(cohort_sizes(users), _mask_activity(users, masks), last_observed_day(orders_seen, users))


def cohort_retention(users: DataFrame, orders: DataFrame, horizon_users: DataFrame | None = None) -> DataFrame:
    """Share of each signup cohort that bought in each elapsed month.

    ``users`` is any table with user_id and signup_date; ``horizon_users``
    adds signups that only extend the observed period.  Months without a
    purchase are present with 0; months after the horizon are absent.
    """
    observed = users if horizon_users is None else users.select("signup_date").unionAll(horizon_users.select("signup_date"))
    return retention_from_activity(cohort_sizes(users), cohort_activity(users, orders), last_observed_day(orders, observed))


def cohort_sizes(users: DataFrame) -> DataFrame:
    return user_cohorts(users).groupBy("cohort_month").agg(F.count("user_id").alias("cohort_size"))


def retention_from_activity(sizes: DataFrame, activity: DataFrame, last_day: DataFrame) -> DataFrame:
    """Retention from users per cohort, buyers per cohort and calendar month, and the last day observed."""
    spine = month_spine(sizes, last_day)
    active = F.coalesce("active_users", F.lit(0))
    return spine.join(activity, ["cohort_month", "activity_month"], "left").select(
        "cohort_month",
        "cohort_size",
        "month_number",
        active.cast("bigint").alias("active_users"),
        percent(active, F.col("cohort_size")).alias("retention_pct"),
    )


def cohort_matrix(retention: DataFrame, months: int | None = None) -> DataFrame:
    """One row per cohort, one column per elapsed month (``m0``, ``m1``, ...).

    Unobserved months are NULL.  ``months`` fixes the number of columns ahead
    of time and the job fails if the data needs more; without it the widest
    cohort is looked up first.
    """
    if months is None:
        months = retention.agg(F.coalesce(F.max("month_number"), F.lit(-1))).first()[0] + 1
    too_late = F.raise_error(F.concat(F.lit("no column for month "), F.col("month_number").cast("string")))
    checked = retention.withColumn("month_number", F.when(F.col("month_number") < months, F.col("month_number")).otherwise(too_late))
    wide = checked.groupBy("cohort_month").pivot("month_number", list(range(months))).agg(F.first("retention_pct"))
    return wide.select("cohort_month", *[F.col(str(m)).alias(f"m{m}") for m in range(months)])


def cohort_curves(retention: DataFrame) -> DataFrame:
    """One row per cohort: a label and its retention ordered by elapsed month.

    A cohort has one row per month, so the collected array is small.
    """
    point = F.struct("month_number", "retention_pct")
    label = F.format_string("Cohort %s (N=%d)", F.date_format("cohort_month", "yyyy-MM"), F.col("cohort_size"))
    return (
        retention.groupBy("cohort_month", "cohort_size")
        .agg(F.sort_array(F.collect_list(point)).alias("curve"))
        .select("cohort_month", label.alias("label"), "curve")
    )


def cohort_kpis(retention: DataFrame) -> DataFrame:
    """One row: mart rows, cohorts and cohorted users."""
    first_month = F.col("month_number") == 0
    return retention.agg(
        F.count(F.lit(1)).alias("mart_rows"),
        F.count_if(first_month).alias("cohorts"),
        F.coalesce(F.sum(F.when(first_month, F.col("cohort_size"))), F.lit(0)).cast("bigint").alias("cohorted_users"),
    )
