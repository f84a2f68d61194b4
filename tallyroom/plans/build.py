"""Build, publish and read the marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import RuleCounts, run_checks
from ..operators.revenue import LOOKBACK_DAYS, daily_revenue, lookback_start, replace_slice, revenue_slice
from ..operators.staging import best_attempts, best_attempts_since
from ..session import apply_required_conf
from ..sources.store import (
    materialise,
    publish_version,
    read_months,
    read_published,
    scratch_dir,
    side_by_side,
    write_months,
)
from .checks import row_rules, standard_checks
from .models import MODEL_NAMES, Models

MARTS = ("fct_revenue_trends", "monthly_cohort_retention", "funnel_summary")
CHECK_RESULTS = "dq_results"

# Read by several models, so computed once and stored.
SHARED_MODELS = ("stg_users", "stg_orders")
# Read again by the checks; each group derives from the ones before it.
CHECKED_MODELS = (
    (*SHARED_MODELS, "stg_events"),
    ("int_sessionized_events", "int_user_first_purchase", "fct_revenue_trends", "monthly_cohort_retention"),
    ("funnel_summary",),
)


def build_marts(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    full_refresh: bool = False,
    lookback_days: int = LOOKBACK_DAYS,
    with_checks: bool = False,
    extra_tables: Sequence[str] = (),
) -> str:
    """Run every model, publish the marts under one new version and return it.

    Tables that several models read are written once to shared storage and
    read back.  ``with_checks`` also publishes the check results as a table;
    checks of single rows are counted by the jobs that write the tables.
    ``extra_tables`` publishes further models by name.
    """
    apply_required_conf(spark)
    waves = CHECKED_MODELS if with_checks else (SHARED_MODELS,)
    stored = {name for wave in waves for name in wave}
    counted, rules = RuleCounts(), row_rules() if with_checks else []
    with scratch_dir(spark, root) as scratch:

        def keep(name: str, df: DataFrame) -> DataFrame:
            return materialise(counted.watch(name, df, rules), f"{scratch}/{name}") if name in stored else df

        models = Models(
            raw.__getitem__,
            existing_revenue=None if full_refresh else read_published(spark, root, "fct_revenue_trends"),
            lookback_days=lookback_days,
            full_refresh=full_refresh,
            keep=keep,
        )
        for wave in waves:
            side_by_side(spark, models.table, wave)
        outputs = {name: models.table(name) for name in (*MARTS, *extra_tables)}
        if with_checks:
            checked = {name: models.table(name) for name in MODEL_NAMES}
            outputs[CHECK_RESULTS] = run_checks(checked, standard_checks(models), counted)
        return publish_version(outputs, root)


def refresh_revenue(
    spark: SparkSession,
    attempts: DataFrame,
    root: str,
    lookback_days: int = LOOKBACK_DAYS,
    full_refresh: bool = False,
) -> str:
    """Bring the published revenue mart up to date; returns the new version.

    ``attempts`` are parsed, valid order attempts, ``valid_attempts(parse_orders(raw))``.
    An incremental run ranks only the attempts of orders seen inside the
    look-back window, see ``best_attempts_since``.
    """
    apply_required_conf(spark)
    existing = None if full_refresh else read_published(spark, root, "fct_revenue_trends")
    if existing is None:
        return publish_version({"fct_revenue_trends": daily_revenue(best_attempts(attempts))}, root)
    start = lookback_start(existing, lookback_days)
    with scratch_dir(spark, root) as scratch:
        orders = best_attempts_since(attempts, start, keep=lambda ids: materialise(ids, f"{scratch}/recent_ids"))
        revenue = replace_slice(existing, revenue_slice(orders, existing, start), start)
        return publish_version({"fct_revenue_trends": revenue}, root)


def refresh_revenue_months(
    spark: SparkSession,
    attempts: DataFrame,
    target: str,
    lookback_days: int = LOOKBACK_DAYS,
    full_refresh: bool = False,
) -> None:
    """``refresh_revenue`` for a mart kept as one month-partitioned table at ``target``.

    Only the months the look-back window touches are rewritten.  The new rows
    are stored aside first, because they derive from the months they replace.
    """
    apply_required_conf(spark)
    existing = None if full_refresh else read_months(spark, target)
    if existing is None:
        write_months(daily_revenue(best_attempts(attempts)), "order_date", target, replace_all=True)
        return
    start = lookback_start(existing, lookback_days)
    touched_months = existing.filter(F.col("order_date") >= F.lit(start.replace(day=1)))
    with scratch_dir(spark, f"{target.rstrip('/')}_aside") as scratch:
        orders = best_attempts_since(attempts, start, keep=lambda ids: materialise(ids, f"{scratch}/recent_ids"))
        revenue = replace_slice(touched_months, revenue_slice(orders, existing, start), start)
        write_months(materialise(revenue, f"{scratch}/revenue"), "order_date", target)


def read_mart(
    spark: SparkSession, root: str, mart: str, columns: Sequence[str] | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """A published mart for a report: chosen columns in a stated order."""
    published = read_published(spark, root, mart)
    if published is None:
        raise LookupError(f"{mart} has not been published under {root}")
    chosen = published.select(*columns) if columns else published
    return chosen.orderBy(*[F.asc_nulls_last(c) for c in order_by]) if order_by else chosen
