"""Data-quality checks.

Each check function returns the violating rows; a check passes when there are
none.  ``run_checks`` turns a list of checks into one result row per check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import month_number, month_start
from .cohorts import last_observed_day
from .revenue import daily_revenue
from .sessions import DEFAULT_STEPS, FunnelStep
from .staging import COMPLETED

SECONDS_PER_DAY = 86_400


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL is exempt."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``columns``."""
    return df.filter(reduce(Column.__or__, [F.col(c).isNull() for c in columns]))


def accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Rows whose value is not listed; NULL is exempt."""
    return df.filter(~F.col(column).isin(*values))


def violations(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which ``predicate`` is true."""
    return df.filter(predicate)


def session_duration_rule() -> Column:
    seconds = F.col("session_duration_seconds")
    return (seconds > SECONDS_PER_DAY) | (seconds < 0)


def revenue_negative_rule() -> Column:
    return (F.col("total_revenue") < 0) | (F.col("average_order_value") < 0)


def retention_range_rule() -> Column:
    return (F.col("retention_pct") < 0) | (F.col("retention_pct") > 100)


def purchase_before_signup(first_purchases: DataFrame, users: DataFrame) -> DataFrame:
    """First purchases not strictly after the signup instant.

    Of several users under one id the latest signup decides, so a repeated id
    does not multiply rows.
    """
    bought = first_purchases.filter(F.col("first_purchase_date").isNotNull())
    latest = F.max(F.struct(F.col("signup_at").alias("registered_at"), F.col("signup_date").alias("registered_on")))
    signups = users.groupBy("user_id").agg(latest.alias("signup")).select("user_id", "signup.*")
    return (
        bought.join(signups, "user_id")
        .filter(F.col("first_purchase_at") <= F.col("registered_at"))
        .select("user_id", "registered_on", "first_purchase_date", "registered_at", "first_purchase_at")
    )


def first_purchase_not_completed(first_purchases: DataFrame, orders: DataFrame) -> DataFrame:
    """First purchases whose order is not a completed one."""
    bought = first_purchases.filter(F.col("has_purchased")).withColumn("order_id", F.col("first_purchase_order_id"))
    # Only unfinished orders can violate, so the rest never reach the join.
    unfinished = orders.filter(F.col("order_status") != COMPLETED).select("order_id", "order_status")
    return bought.join(unfinished, "order_id").select(
        "user_id", "first_purchase_order_id", "first_purchase_at", "first_purchase_value", "order_status"
    )


def reconcile(actual: DataFrame, expected: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Keys for which any measure differs; a side without the key counts as 0.

    Keys holding NULL cannot be matched and are not compared.
    """
    named = [F.col(k).isNotNull() for k in keys]
    have = actual.filter(reduce(Column.__and__, named)).select(*keys, *measures)
    want = (
        expected.filter(reduce(Column.__and__, named))
        .select(*keys, *measures)
        .withColumnsRenamed({m: f"expected_{m}" for m in measures})
    )
    both = have.join(want, list(keys), "full_outer")
    zero_filled = [F.coalesce(c, F.lit(0)).alias(c) for m in measures for c in (m, f"expected_{m}")]
    differs = reduce(Column.__or__, [F.col(m) != F.col(f"expected_{m}") for m in measures])
    return both.select(*keys, *zero_filled).filter(differs)


REVENUE_MEASURES = ("total_revenue", "order_count", "distinct_user_count", "average_order_value")


def revenue_mismatches(revenue: DataFrame, orders: DataFrame) -> DataFrame:
    """Days on which the mart differs from the completed orders."""
    expected = daily_revenue(orders.filter(F.col("order_status") == COMPLETED))
    return reconcile(revenue, expected, ["order_date"], REVENUE_MEASURES)


def cohort_spine_gaps(retention: DataFrame, users: DataFrame, orders: DataFrame) -> DataFrame:
    """Cohorts that are missing or do not run from month 0 to the horizon without holes."""
    horizon = last_observed_day(orders, users).scalar()
    expected = (
        users.select(month_start(F.col("signup_date")).alias("cohort_month"))
        .distinct()
        .withColumn("expected_last_month", F.greatest(F.lit(0), month_number(F.col("cohort_month"), horizon)))
    )
    present = retention.groupBy("cohort_month").agg(
        F.min("month_number").alias("first_month"),
        F.max("month_number").alias("last_month"),
        F.count(F.lit(1)).alias("months"),
        F.lit(True).alias("present"),
    )
    gap = (
        F.col("present").isNull()
        | (F.col("first_month") != 0)
        | (F.col("last_month") != F.col("expected_last_month"))
        | (F.col("months") != F.col("expected_last_month") + 1)
    )
    return expected.join(present, "cohort_month", "left").filter(gap).drop("present")


def funnel_increases(funnel: DataFrame, steps: Sequence[FunnelStep] = DEFAULT_STEPS) -> DataFrame:
    """The pivoted funnel (one row) if a later step has more sessions than the one before it."""
    by_step = [F.max(F.when(F.col("funnel_step") == s.event, F.col("session_count"))).alias(f"{s.event}_sessions") for s in steps]
    rising = [F.col(f"{later.event}_sessions") > F.col(f"{earlier.event}_sessions") for earlier, later in zip(steps, steps[1:])]
    return funnel.agg(*by_step).filter(reduce(Column.__or__, rising))


@dataclass(frozen=True)
class RowRule:
    """Rows for which ``violated`` is true break the rule."""

    check: str
    table: str
    column: str | None
    violated: Column


@dataclass(frozen=True)
class RowsCheck:
    """``rows`` are the violating rows."""

    check: str
    table: str
    column: str | None
    rows: DataFrame


Check = RowRule | RowsCheck


def not_null_rules(table: str, columns: Sequence[str]) -> list[RowRule]:
    return [RowRule("not_null", table, c, F.col(c).isNull()) for c in columns]


def accepted_values_rule(table: str, column: str, values: Sequence[object]) -> RowRule:
    return RowRule("accepted_values", table, column, ~F.col(column).isin(*values))


def unique_check(table: str, df: DataFrame, column: str) -> RowsCheck:
    return RowsCheck("unique", table, column, unique(df, column))


def _result_rows(counted: DataFrame, checks: Sequence[Check], columns: Sequence[str]) -> DataFrame:
    """One row per check from a single row of violation counts, one column each."""

    def text(value: str | None) -> str:
        return "cast(null as string)" if value is None else f"'{value}'"

    rows = [
        f"{text(check.check)}, {text(check.table)}, {text(check.column)}, {count}, {count} = 0"
        for check, count in zip(checks, columns)
    ]
    return counted.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) as (check, table, column, violations, passed)")


class RuleCounts:
    """Counts of broken row rules, taken in the jobs that write the tables.

    ``watch`` belongs directly before the write: there the counts come from the
    job's last stage, whose tasks count once each, also when some are repeated.
    """

    def __init__(self) -> None:
        self._observed: dict[str, tuple[list[RowRule], Observation]] = {}

    def watch(self, table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
        """``df``, whose next action also counts its row rules among ``checks``."""
        rules = [c for c in checks if isinstance(c, RowRule) and c.table == table]
        if not rules:
            return df
        observation = Observation()
        self._observed[table] = (rules, observation)
        return df.observe(observation, *[F.count_if(rule.violated).alias(f"rule_{i}") for i, rule in enumerate(rules)])

    def __contains__(self, table: str) -> bool:
        return table in self._observed

    def results(self, spark: SparkSession, table: str, checks: Sequence[Check]) -> DataFrame:
        """One row for each of the table's row rules among ``checks``; waits for the action that counts."""
        rules, observation = self._observed[table]
        counts = {(r.check, r.column): observation.get[f"rule_{i}"] for i, r in enumerate(rules)}
        asked = [c for c in checks if isinstance(c, RowRule) and c.table == table]
        columns = [f"rule_{i}" for i in range(len(asked))]
        counted = spark.range(1).select(*[F.lit(counts[c.check, c.column]).cast("long").alias(n) for c, n in zip(asked, columns)])
        return _result_rows(counted, asked, columns)


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check], counted: RuleCounts | None = None) -> DataFrame:
    """One row per check: check, table, column, violations, passed.

    All row rules of a table are counted in one scan without a shuffle of its
    rows, or not again where ``counted`` has them; every other check adds its
    own plan.
    """
    results = []
    for table, df in tables.items():
        rules = [c for c in checks if isinstance(c, RowRule) and c.table == table]
        if rules and counted is not None and table in counted:
            results.append(counted.results(df.sparkSession, table, rules))
        elif rules:
            columns = [f"rule_{i}" for i in range(len(rules))]
            totals = df.agg(*[F.count_if(rule.violated).alias(c) for rule, c in zip(rules, columns)])
            results.append(_result_rows(totals, rules, columns))
    for check in checks:
        if isinstance(check, RowsCheck):
            results.append(_result_rows(check.rows.agg(F.count(F.lit(1)).alias("n")), [check], ["n"]))
        elif check.table not in tables:
            raise ValueError(f"no table named {check.table!r} for check {check.check!r}")
    return reduce(DataFrame.unionAll, results)


#: Buckets of the checksum tree at each of its two levels.
FANOUT = 256


def _with_buckets(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the two buckets of their key and a hash of all values, in which a null is unlike any value and has its column."""
    key = F.xxhash64(*keys)
    columns = sorted(df.columns)
    row = F.xxhash64(*[F.col(c).isNull() for c in columns], *columns)
    return df.withColumns(
        {
            "__upper": F.pmod(key, F.lit(FANOUT)).cast("int"),
            "__lower": F.pmod(F.shiftright(key, 16), F.lit(FANOUT)).cast("int"),
            "__row": row,
        }
    )


def differing_buckets(left: DataFrame, right: DataFrame, buckets: Sequence[str]) -> DataFrame:
    """Buckets whose number of rows, xor or sum of row hashes differ between two tables with buckets."""

    def checksums(df: DataFrame, side: int) -> DataFrame:
        halves = F.sum(F.col("__row").bitwiseAND(F.lit(0xFFFFFFFF))).alias("total")
        return df.groupBy(*buckets).agg(F.count(F.lit(1)).alias("n"), F.bit_xor("__row").alias("xor"), halves).withColumn("side", F.lit(side))

    both = checksums(left, 0).unionByName(checksums(right, 1)).groupBy(*buckets)
    same = [(F.min(c) == F.max(c)) for c in ("n", "xor", "total")]
    return both.agg((F.count(F.lit(1)) == 2).alias("both"), reduce(Column.__and__, same).alias("same")).filter("not (both and same)").select(*buckets)


def compare_by_checksum(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``compare_frames`` of the rows in buckets of keys whose checksums differ.

    Equal tables cost one aggregation each; where few buckets differ, only
    their rows are read into finer buckets, and only those of the finer ones
    that differ are joined.  What is gathered are at most 256 bucket numbers.
    """
    a, b = _with_buckets(left, keys), _with_buckets(right, keys)
    upper = [r[0] for r in differing_buckets(a, b, ["__upper"]).collect()]
    a, b = (df.filter(F.col("__upper").isin(*upper)) for df in (a, b))
    if not upper:
        return compare_frames(left.filter(F.lit(False)), right.filter(F.lit(False)), keys)
    lower = differing_buckets(a, b, ["__upper", "__lower"])
    a, b = (df.join(lower, ["__upper", "__lower"], "left_semi").drop("__upper", "__lower", "__row") for df in (a, b))
    return compare_frames(a, b, keys)


def compare_frames(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ between two versions of a table, with the columns that do.

    ``differs_in`` lists column names, or is ``missing left`` / ``missing
    right``.  Money and percentages are decimals with two places, so equality
    is exact; NULL equals NULL, in keys as well.  Keys must be unique on each
    side.
    """
    columns = [c for c in left.columns if c not in keys]
    if set(left.columns) != set(right.columns):
        raise ValueError(f"columns differ: {sorted(left.columns)} and {sorted(right.columns)}")
    a = left.withColumn("__here", F.lit(True)).alias("a")
    b = right.withColumn("__here", F.lit(True)).alias("b")
    same_key = reduce(Column.__and__, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    changed = F.array_compact(
        F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in columns])
    )
    differs_in = (
        F.when(F.col("a.__here").isNull(), F.array(F.lit("missing left")))
        .when(F.col("b.__here").isNull(), F.array(F.lit("missing right")))
        .otherwise(changed)
    )
    key_columns = [F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys]
    return a.join(b, same_key, "full_outer").select(*key_columns, differs_in.alias("differs_in")).filter(F.size("differs_in") > 0)
