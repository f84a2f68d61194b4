"""Properties that hold for any input."""

import random
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tallyroom.operators.cohorts import cohort_retention
from tallyroom.operators.dedupe import keep_first
from tallyroom.operators.quality import cohort_spine_gaps, compare_frames, revenue_mismatches, unique
from tallyroom.operators.revenue import daily_revenue, lookback_start, revenue_trends
from tallyroom.operators.staging import stage_orders, stage_orders_since

from .builders import raw_orders, staged_orders, staged_users

STATUSES = ("completed", "pending", "returned", "cancelled")
CENT = Decimal("0.01")


def random_raw_orders(seed, n=250, days=40):
    rng = random.Random(seed)
    first = date(2023, 1, 1)
    return [
        (
            rng.choice([None, *range(n // 2)]),
            rng.choice([None, *range(12)]),
            f"{first + timedelta(days=rng.randrange(days))}T{rng.randrange(24):02d}:00:0{rng.randrange(3)}Z",
            str(Decimal(rng.randrange(-200, 5000)).scaleb(-2)),
            rng.choice(STATUSES),
        )
        for _ in range(n)
    ]


def best_attempt(attempts):
    """The rule for one order id, written out."""
    return sorted(attempts, key=lambda r: (r[4] != "completed", [-ord(c) for c in r[2]], -Decimal(r[3]), r[4], (r[1] is None, r[1] or 0)))[0]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_staged_orders_follow_the_rule(spark, rows, seed):
    data = random_raw_orders(seed)
    by_id = {}
    for row in data:
        if Decimal(row[3]) > 0:
            by_id.setdefault(row[0], []).append(row)
    expected = sorted(((k, b[1], Decimal(b[3]), b[4]) for k, b in ((k, best_attempt(v)) for k, v in by_id.items())), key=str)
    staged = stage_orders(raw_orders(spark, *data))
    assert sorted((tuple(r) for r in staged.select("order_id", "user_id", "order_value", "order_status").collect()), key=str) == expected
    assert unique(staged, "order_id").isEmpty()


@pytest.mark.parametrize("seed", [4, 5])
def test_incremental_staging_is_full_staging_cut_by_date(spark, seed):
    raw = raw_orders(spark, *random_raw_orders(seed))
    since = date(2023, 1, 30)
    full = stage_orders(raw).filter(F.col("order_date") >= F.lit(since))
    assert compare_frames(stage_orders_since(raw, since), full, ["order_id"]).isEmpty()


@pytest.mark.parametrize("seed", [6, 7])
def test_keep_first_is_idempotent(spark, rows, seed):
    staged = stage_orders(raw_orders(spark, *random_raw_orders(seed)))
    again = keep_first(staged, ["order_id"], [F.col("order_value").desc()])
    assert rows(again) == rows(staged)


@pytest.mark.parametrize("seed", [8, 9, 10])
def test_daily_revenue_matches_plain_python(spark, rows, seed):
    staged = stage_orders(raw_orders(spark, *random_raw_orders(seed)))
    days = {}
    for r in staged.collect():
        values = days.setdefault(r.order_date, [])
        if r.order_status == "completed":
            values.append(r)
    expected = []
    for day, done in days.items():
        total = sum((r.order_value for r in done), Decimal("0.00"))
        mean = (total / len(done)).quantize(CENT, ROUND_HALF_UP) if done else Decimal("0.00")
        ids, users = [r.order_id for r in done if r.order_id is not None], {r.user_id for r in done if r.user_id is not None}
        expected.append((day, total, len(ids), len(users), mean))
    mart = daily_revenue(staged)
    assert rows(mart) == sorted(expected)
    assert revenue_mismatches(mart, staged).isEmpty()


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_incremental_differs_from_full_only_before_the_window_and_on_emptied_days(spark, seed):
    rng = random.Random(seed)
    data = random_raw_orders(seed)
    before = stage_orders(raw_orders(spark, *[r for r in data if rng.random() < 0.7 and r[2] < "2023-02-05"]))
    mart = spark.createDataFrame(daily_revenue(before).collect(), daily_revenue(before).schema)
    gone = mart.agg(F.max("order_date")).first()[0]
    after = stage_orders(raw_orders(spark, *data)).filter(F.col("order_date") != F.lit(gone))
    start = lookback_start(mart)
    merged, full = revenue_trends(after, mart), revenue_trends(after)
    inside = F.col("order_date") >= F.lit(start)
    assert [(r.order_date, r.differs_in) for r in compare_frames(merged.filter(inside), full.filter(inside), ["order_date"]).collect()] == [
        (gone, ["missing right"])
    ]
    assert compare_frames(merged.filter(~inside), mart.filter(~inside), ["order_date"]).isEmpty()
    emptied = merged.filter(F.col("order_date") == F.lit(gone)).first()
    assert (emptied.total_revenue, emptied.order_count, emptied.distinct_user_count, emptied.average_order_value) == (0, 0, 0, 0)
    assert compare_frames(revenue_trends(after, merged), merged, ["order_date"]).isEmpty()


@pytest.mark.parametrize("seed", [14, 15, 16])
def test_retention_matches_plain_python(spark, seed):
    rng = random.Random(seed)
    first = date(2022, 6, 1)
    users = [(u, str(first + timedelta(days=rng.randrange(200)))) for u in range(40)]
    orders = [
        (i, rng.randrange(50), str(first + timedelta(days=rng.randrange(420))), "1.00", rng.choice(STATUSES)) for i in range(200)
    ]
    month = lambda text: (int(text[:4]), int(text[5:7]))
    ordinal = lambda m: m[0] * 12 + m[1]
    horizon = max(ordinal(month(t)) for t in [d for _, d in users] + [o[2] for o in orders])
    cohort_of = {u: month(d) for u, d in users}
    expected = {}
    for cohort in set(cohort_of.values()):
        members = {u for u, c in cohort_of.items() if c == cohort}
        for n in range(horizon - ordinal(cohort) + 1):
            active = {o[1] for o in orders if o[1] in members and o[4] == "completed" and ordinal(month(o[2])) == ordinal(cohort) + n}
            pct = (Decimal(100 * len(active)) / len(members)).quantize(CENT, ROUND_HALF_UP)
            expected[cohort, n] = (len(members), len(active), pct)
    staged_u, staged_o = staged_users(spark, *users), staged_orders(spark, *orders)
    mart = cohort_retention(staged_u, staged_o)
    got = {((r.cohort_month.year, r.cohort_month.month), r.month_number): (r.cohort_size, r.active_users, r.retention_pct) for r in mart.collect()}
    assert got == expected
    assert cohort_spine_gaps(mart, staged_u, staged_o).isEmpty()
