from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyroom.operators.quality import compare_frames, revenue_mismatches
from tallyroom.operators.revenue import (
    REVENUE_COLUMNS,
    daily_revenue,
    latest_active_day,
    lookback_start,
    revenue_kpis,
    revenue_slice,
    revenue_trends,
)
from tallyroom.operators.series import rolling_mean
from tallyroom.operators.staging import parse_orders, stage_orders, valid_attempts
from tallyroom.plans import Models, build_marts, read_mart, refresh_revenue, refresh_revenue_months
from tallyroom.sources import read_months, read_published

from .builders import raw_events, raw_orders, raw_users, revenue_mart, staged_orders


def as_text(rows):
    return [tuple(str(v) for v in r) for r in rows]


ORDERS = (
    (1, 1, "2023-01-01", "10.00", "completed"),
    (2, 1, "2023-01-01", "5.01", "completed"),
    (3, 2, "2023-01-01", "0.10", "completed"),
    (4, 2, "2023-01-02", "9.00", "pending"),
    (5, 900, "2023-01-10", "4.00", "completed"),
)


def test_daily_revenue_with_zero_days_and_unknown_users(spark, rows):
    assert as_text(rows(daily_revenue(staged_orders(spark, *ORDERS)))) == [
        ("2023-01-01", "15.11", "3", "2", "5.04"),
        ("2023-01-02", "0.00", "0", "0", "0.00"),
        ("2023-01-10", "4.00", "1", "1", "4.00"),
    ]


def test_undated_orders_form_a_zero_row(spark, rows):
    got = rows(daily_revenue(staged_orders(spark, (1, 1, None, "10.00", "completed"))))
    assert as_text(got) == [("None", "0.00", "0", "0", "0.00")]


def test_hot_day_and_user_reach_the_reducer_aggregated(spark):
    plan = daily_revenue(staged_orders(spark, *ORDERS))._jdf.queryExecution().executedPlan().toString()
    first_shuffle = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "partial_sum" in first_shuffle and "user_id" in first_shuffle.splitlines()[0]
    assert plan.count("Scan ExistingRDD") == 1


def test_incremental_equals_full_refresh_for_changes_in_the_window(spark, rows):
    before = staged_orders(spark, *ORDERS)
    mart = daily_revenue(before)
    after = before.unionByName(staged_orders(spark, (6, 3, "2023-01-05", "8.00", "completed"), (7, 3, "2023-01-11", "2.00", "completed")))
    assert rows(revenue_trends(after, mart)) == rows(revenue_trends(after))


def test_incremental_without_change_is_identity(spark, rows):
    orders = staged_orders(spark, *ORDERS)
    mart = daily_revenue(orders)
    assert rows(revenue_trends(orders, mart)) == rows(mart)


def test_late_order_outside_the_window_waits_for_a_full_refresh(spark, rows):
    before = staged_orders(spark, *ORDERS)
    mart = daily_revenue(before)
    after = before.unionByName(staged_orders(spark, (6, 3, "2023-01-01", "100.00", "completed"), (7, 3, "2023-01-02", "100.00", "completed")))
    assert rows(revenue_trends(after, mart)) == rows(mart)
    full = dict((r[0], r[1]) for r in rows(revenue_trends(after, mart, full_refresh=True)))
    assert full[date(2023, 1, 1)] == Decimal("115.11")
    wider = dict((r[0], r[1]) for r in rows(revenue_trends(after, mart, lookback_days=8)))
    assert (wider[date(2023, 1, 1)], wider[date(2023, 1, 2)]) == (Decimal("15.11"), Decimal("100.00"))


def test_deleted_day_is_zeroed_incrementally_and_gone_after_a_full_refresh(spark, rows):
    before = staged_orders(spark, *ORDERS)
    mart = daily_revenue(before)
    after = before.filter(F.col("order_date") != F.lit(date(2023, 1, 10)))
    healed = revenue_trends(after, mart)
    assert as_text(rows(healed))[-1] == ("2023-01-10", "0.00", "0", "0", "0.00")
    assert revenue_mismatches(healed, after).count() == 0
    assert revenue_mismatches(mart, after).count() == 1
    assert date(2023, 1, 10) not in [r[0] for r in rows(revenue_trends(after, mart, full_refresh=True))]


def test_empty_target_recomputes_everything(spark, rows):
    orders = staged_orders(spark, *ORDERS)
    empty = revenue_mart(spark)
    assert lookback_start(empty) == date(1969, 12, 25)
    assert rows(revenue_trends(orders, empty)) == rows(daily_revenue(orders))


def test_null_day_of_the_target_is_left_alone(spark, rows):
    mart = revenue_mart(spark, (None, "0.00", 0, 0, "0.00"), ("2023-01-10", "4.00", 1, 1, "4.00"))
    got = rows(revenue_trends(staged_orders(spark, *ORDERS), mart))
    assert [r[0] for r in got] == [date(2023, 1, 10), None]


def test_slice_holds_only_the_window(spark, rows):
    orders = staged_orders(spark, *ORDERS)
    mart = daily_revenue(orders)
    assert [r[0] for r in rows(revenue_slice(orders, mart, lookback_start(mart)))] == [date(2023, 1, 10)]


def test_kpis_and_latest_day(spark):
    mart = daily_revenue(staged_orders(spark, *ORDERS))
    k = revenue_kpis(mart).first()
    assert (k.tracked_days, k.active_days, str(k.total_revenue), k.completed_orders, str(k.mean_active_day_aov)) == (3, 2, "19.11", 4, "4.52")
    assert latest_active_day(mart).first().order_date == date(2023, 1, 10)
    empty = revenue_kpis(mart.limit(0)).first()
    assert (empty.tracked_days, str(empty.total_revenue), str(empty.mean_active_day_aov)) == (0, "0.00", "0.00")


def test_rolling_mean_counts_rows_not_days(spark):
    mart = revenue_mart(spark, *[(f"2023-0{m}-01", f"{m}.00", 1, 1, "1.00") for m in range(1, 10)])
    means = rolling_mean(mart.select("order_date", "total_revenue"), "order_date", {"total_revenue": "m"}, rows=3)
    assert [r.m for r in means.orderBy("order_date").collect()] == [1.0, 1.5, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]


def iso(rows):
    return [(i, u, f"{d}T12:00:00Z", v, s) for i, u, d, v, s in rows]


def attempts(raw):
    return valid_attempts(parse_orders(raw))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "marts")


def test_published_mart_heals_a_deleted_day(spark, rows, root):
    """Build, delete the newest day at the source, refresh twice: the day stays as zeros and reconciles."""
    raw = raw_orders(spark, *iso(ORDERS))
    refresh_revenue(spark, attempts(raw), root)
    target_day = latest_active_day(read_published(spark, root, "fct_revenue_trends")).first().order_date
    remaining = raw.filter(F.col("order_date").substr(1, 10) != str(target_day))
    for _ in range(2):
        refresh_revenue(spark, attempts(remaining), root)
        mart = read_published(spark, root, "fct_revenue_trends")
        assert as_text(rows(mart))[-1] == (str(target_day), "0.00", "0", "0", "0.00")
    refresh_revenue(spark, attempts(remaining), root, full_refresh=True)
    assert read_published(spark, root, "fct_revenue_trends").filter(F.col("order_date") == F.lit(target_day)).isEmpty()


def test_month_partitioned_mart_rewrites_only_touched_months(spark, rows, tmp_path):
    target = str(tmp_path / "by_month")
    early = (9, 9, "2022-11-05", "3.00", "completed")
    raw = raw_orders(spark, *iso((*ORDERS, early)))
    refresh_revenue_months(spark, attempts(raw), target)
    november = sorted(p.name for p in (tmp_path / "by_month" / "month=2022-11").iterdir())

    changed = raw_orders(spark, *iso((*ORDERS[:4], early, (6, 3, "2023-01-04", "8.00", "completed"), (7, 3, "2022-11-06", "9.00", "completed"))))
    refresh_revenue_months(spark, attempts(changed), target)
    assert as_text(rows(read_months(spark, target), "order_date", "total_revenue")) == [
        ("2022-11-05", "3.00"), ("2023-01-01", "15.11"), ("2023-01-02", "0.00"), ("2023-01-04", "8.00"), ("2023-01-10", "0.00"),
    ]
    assert sorted(p.name for p in (tmp_path / "by_month" / "month=2022-11").iterdir()) == november

    refresh_revenue_months(spark, attempts(changed.filter("order_id < 9")), target, full_refresh=True)
    assert as_text(rows(read_months(spark, target), "order_date"))[0] == ("2022-11-06",)


def test_models_as_views(spark):
    raw = {"orders": raw_orders(spark, *iso(ORDERS)), "users": raw_users(spark, (1, "a@x.com", "2022-12-20 00:00:00")), "events": raw_events(spark)}
    Models(raw.__getitem__).register_views("v_")
    assert str(spark.sql("select sum(total_revenue) from v_fct_revenue_trends").first()[0]) == "19.11"
    assert spark.sql("select count(*) from v_funnel_summary").first()[0] == 3


def test_build_marts_full_then_incremental(spark, rows, root):
    raw = {
        "users": raw_users(spark, (1, "a@x.com", "2022-12-20 00:00:00"), (2, "b@x.com", "2023-01-01 08:00:00")),
        "orders": raw_orders(spark, *iso(ORDERS)),
        "events": raw_events(spark, (1, 1, "s", "page_view", "2023-01-01 10:00:00"), (2, 1, "s", "add_to_cart", "2023-01-01 10:01:00")),
    }
    first = build_marts(spark, raw, root, with_checks=True, extra_tables=["stg_orders"])
    assert build_marts(spark, raw, root) > first
    results = read_mart(spark, root, "dq_results")
    assert results.count() == 68
    assert rows(results.filter(~F.col("passed")), "check") == []
    staged = stage_orders(raw["orders"])
    assert rows(read_mart(spark, root, "stg_orders")) == rows(staged)
    mart = read_mart(spark, root, "fct_revenue_trends", REVENUE_COLUMNS, ["order_date"])
    assert compare_frames(mart, daily_revenue(staged), ["order_date"]).isEmpty()
    retention = read_mart(spark, root, "monthly_cohort_retention", order_by=["cohort_month", "month_number"]).collect()
    assert [(str(r.cohort_month), r.month_number, r.active_users, str(r.retention_pct)) for r in retention] == [
        ("2022-12-01", 0, 0, "0.00"),
        ("2022-12-01", 1, 1, "100.00"),
        ("2023-01-01", 0, 1, "100.00"),
    ]
    with pytest.raises(LookupError):
        read_mart(spark, root, "nothing")
