from datetime import date

import pytest
from pyspark.errors import PySparkException

from tallyroom.operators.cohorts import cohort_curves, cohort_kpis, cohort_matrix, cohort_retention
from tallyroom.operators.quality import cohort_spine_gaps

from .builders import staged_orders, staged_users

USERS = ((1, "2023-01-05"), (2, "2023-01-31"), (3, "2023-03-10"))
ORDERS = (
    (1, 1, "2023-01-06", "1.00", "completed"),
    (2, 1, "2023-01-07", "1.00", "completed"),
    (3, 2, "2023-02-01", "1.00", "pending"),
    (4, 3, "2023-02-28", "1.00", "completed"),  # before its signup month
    (5, 99, "2023-03-01", "1.00", "completed"),  # unknown user
    (6, 1, "2023-03-31", "1.00", "completed"),
    (7, 2, "2023-05-02", "1.00", "returned"),  # extends the horizon only
)


def retention(spark):
    return cohort_retention(staged_users(spark, *USERS), staged_orders(spark, *ORDERS))


def test_dense_spine_to_the_last_order_of_any_status(spark, rows):
    got = [(str(c), s, m, a, str(p)) for c, s, m, a, p in rows(retention(spark))]
    assert got == [
        ("2023-01-01", 2, 0, 1, "50.00"),
        ("2023-01-01", 2, 1, 0, "0.00"),
        ("2023-01-01", 2, 2, 1, "50.00"),
        ("2023-01-01", 2, 3, 0, "0.00"),
        ("2023-01-01", 2, 4, 0, "0.00"),
        ("2023-03-01", 1, 0, 0, "0.00"),
        ("2023-03-01", 1, 1, 0, "0.00"),
        ("2023-03-01", 1, 2, 0, "0.00"),
    ]


def test_horizon_reaches_the_latest_signup(spark, rows):
    users = staged_users(spark, (1, "2023-01-05"), (2, "2023-04-01"))
    got = cohort_retention(users, staged_orders(spark, (1, 1, "2023-01-06", "1.00", "completed")))
    assert [(str(r[0]), r[1]) for r in rows(got, "cohort_month", "month_number")] == [
        ("2023-01-01", 0), ("2023-01-01", 1), ("2023-01-01", 2), ("2023-01-01", 3), ("2023-04-01", 0),
    ]


def test_extra_signups_only_extend_the_horizon(spark):
    users, orders = staged_users(spark, (1, "2023-01-05")), staged_orders(spark, (1, 1, "2023-01-06", "1.00", "completed"))
    got = cohort_retention(users, orders, horizon_users=staged_users(spark, (5, "2023-02-05")))
    assert sorted(r.month_number for r in got.collect()) == [0, 1]


def test_a_user_listed_twice_is_counted_once(spark):
    users = staged_users(spark, (1, "2023-01-05"), (1, "2023-01-09"), (2, "2023-01-01"))
    got = cohort_retention(users, staged_orders(spark, (1, 1, "2023-01-06", "1.00", "completed"))).first()
    assert (got.cohort_size, got.active_users, str(got.retention_pct)) == (2, 1, "50.00")


def test_no_orders_and_no_users(spark):
    users, none = staged_users(spark, *USERS), staged_orders(spark)
    assert cohort_retention(users, none).count() == 4
    assert cohort_retention(staged_users(spark), staged_orders(spark, *ORDERS)).count() == 0


def test_plan_has_no_cross_join(spark):
    plan = retention(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "Join Inner\n" not in plan


def test_matrix_marks_unobserved_months_null(spark, rows):
    got = [(str(r[0]), *[None if v is None else str(v) for v in r[1:]]) for r in rows(cohort_matrix(retention(spark)))]
    assert got == [
        ("2023-01-01", "50.00", "0.00", "50.00", "0.00", "0.00"),
        ("2023-03-01", "0.00", "0.00", "0.00", None, None),
    ]
    assert cohort_matrix(retention(spark), months=7).columns == ["cohort_month", *[f"m{i}" for i in range(7)]]


def test_matrix_never_drops_a_month(spark):
    with pytest.raises(PySparkException):
        cohort_matrix(retention(spark), months=3).collect()


def test_curves_are_ordered(spark):
    got = {str(r.cohort_month): (r.label, [p.month_number for p in r.curve]) for r in cohort_curves(retention(spark)).collect()}
    assert got == {
        "2023-01-01": ("Cohort 2023-01 (N=2)", [0, 1, 2, 3, 4]),
        "2023-03-01": ("Cohort 2023-03 (N=1)", [0, 1, 2]),
    }


def test_kpis(spark):
    k = cohort_kpis(retention(spark)).first()
    assert (k.mart_rows, k.cohorts, k.cohorted_users) == (8, 2, 3)


def test_spine_check_sees_holes_and_missing_cohorts(spark, rows):
    users, orders = staged_users(spark, *USERS), staged_orders(spark, *ORDERS)
    mart = cohort_retention(users, orders)
    assert cohort_spine_gaps(mart, users, orders).isEmpty()
    jan, mar = date(2023, 1, 1), date(2023, 3, 1)
    for broken, cohort in [
        (mart.filter("month_number <> 2 or cohort_month <> date'2023-01-01'"), jan),
        (mart.filter("month_number <> 0 or cohort_month <> date'2023-01-01'"), jan),
        (mart.filter("month_number < 4"), jan),
        (mart.filter("cohort_month <> date'2023-03-01'"), mar),
    ]:
        assert rows(cohort_spine_gaps(broken, users, orders), "cohort_month") == [(cohort,)]
