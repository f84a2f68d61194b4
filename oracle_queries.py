"""DuckDB SQL for every query that can be checked against it.

The SQL is the plain definition of each result, written without regard to the
Spark plans, so that the two can disagree.
"""

from __future__ import annotations

# The checked columns, written out here so that one left out of the suite shows.
UNIQUE_COLUMN = {
    "stg_users": "user_id",
    "stg_orders": "order_id",
    "stg_events": "event_id",
    "int_user_first_purchase": "user_id",
    "int_sessionized_events": "session_id",
    "fct_revenue_trends": "order_date",
}
NOT_NULL_COLUMNS = {
    "stg_users": ("user_id", "email", "signup_at", "signup_date"),
    "stg_orders": ("order_id", "user_id", "ordered_at", "order_date", "order_value", "order_status"),
    "stg_events": ("event_id", "user_id", "session_id", "event_name", "event_at", "event_date"),
    "int_user_first_purchase": ("user_id", "signup_at", "signup_date", "total_orders_count", "total_lifetime_value", "has_purchased"),
    "int_sessionized_events": (
        "session_id",
        "user_id",
        "session_date",
        "session_start_at",
        "session_end_at",
        "session_duration_seconds",
        "total_events_count",
        "page_view_count",
        "add_to_cart_count",
        "purchase_count",
        "has_page_view",
        "has_cart_add",
        "has_purchase",
        "has_sequential_cart",
        "has_sequential_purchase",
        "furthest_funnel_step",
    ),
    "monthly_cohort_retention": ("cohort_month", "cohort_size", "month_number", "active_users", "retention_pct"),
    "funnel_summary": ("funnel_step_order", "funnel_step", "session_count", "step_conversion_pct", "overall_conversion_pct"),
    "fct_revenue_trends": ("order_date", "total_revenue", "order_count", "distinct_user_count", "average_order_value"),
}

# Name -> (tables it reads, definition).
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "order_base": (
        (),
        """
        select o_orderkey as order_id,
               if(o_orderkey % 67 = 0, o_custkey + 1000000, o_custkey) as user_id,
               o_orderdate + to_seconds(o_orderkey % 86400) as ordered_ts,
               cast(case o_orderkey % 125 when 0 then 0 when 1 then -o_totalprice else o_totalprice end
                    as decimal(12,2)) as order_amount,
               case o_orderstatus when 'F' then 'completed' when 'O' then 'pending'
                    else if(o_orderkey % 2 = 0, 'returned', 'cancelled') end as order_status
        from orders
        """,
    ),
    "order_rows": (
        ("order_base",),
        """
        select * from order_base
        union all
        select order_id, user_id,
               if(order_id % 400 = 100, ordered_ts + interval 90 second, ordered_ts),
               cast(case order_id % 400 when 200 then order_amount * 1.15 when 300 then 0 else order_amount end
                    as decimal(12,2)),
               case order_id % 400 when 0 then if(order_status = 'completed', 'pending', 'completed')
                                   when 300 then 'cancelled' else order_status end
        from order_base where order_id % 100 = 0
        """,
    ),
    "raw_orders": (
        ("order_rows",),
        """
        select order_id, user_id, strftime(ordered_ts, '%Y-%m-%dT%H:%M:%SZ') as order_date, order_amount, order_status
        from order_rows
        """,
    ),
    "user_rows": (
        (),
        """
        select c_custkey as user_id, c_name as first_name, 'c' || c_custkey as last_name,
               'cust.' || c_custkey || '@' || (['gmail.com', 'yahoo.com', 'hotmail.com', 'outlook.com'])[c_custkey % 4 + 1] as email,
               if(c_custkey % 67 = 3, '', cast(c_nationkey as varchar)) as country,
               if(c_custkey % 67 = 5, null, fo - to_days(cast(1 + c_custkey % 45 as integer))) as signup_ts,
               c_custkey
        from customer left join (select o_custkey, min(o_orderdate) as fo from orders group by 1) on o_custkey = c_custkey
        """,
    ),
    "raw_users": (
        ("user_rows",),
        """
        select user_id, first_name, last_name, email, country,
               coalesce(strftime(signup_ts, '%Y-%m-%d %H:%M:%S'), if(c_custkey % 2 = 0, '', null)) as signup_date
        from (select * from user_rows
              union all
              select user_id + 500000, first_name, last_name,
                     'Cust' || if(c_custkey % 4 = 0, '', '.') || c_custkey || '@'
                       || (['GMIAL.com ', 'yaho.com', 'hotmal.com', 'outlok.com'])[c_custkey % 4 + 1],
                     country, signup_ts + interval 9 day, c_custkey
              from user_rows where c_custkey % 25 = 1 or c_custkey % 100 = 0)
        """,
    ),
    "raw_events": (
        (),
        """
        select event_id, if(event_id % 97 = 0, user_id + 1000000, user_id) as user_id,
               if(event_id % 211 = 0, null, 's_' || user_id || '_' || strftime(ts, '%Y-%m-%d')) as session_id,
               case event_type when 'view' then ' Page_View' when 'click' then 'add_to_cart' else event_type end as event_name,
               ts as event_timestamp,
               (['Mobile', 'desktop ', 'tablet'])[user_id % 3 + 1] as device_type,
               '/p/' || (event_id % 8) as page_url
        from events
        """,
    ),
    "parsed_users": (
        ("raw_users",),
        r"""
        select user_id, first_name, last_name, lower(trim(email)) as email,
               if(trim(country) = '', null, trim(country)) as country,
               cast(nullif(trim(signup_date), '') as timestamp) as signup_at,
               cast(left(nullif(trim(signup_date), ''), 10) as date) as signup_date,
               coalesce(dom.canonical, split_part(lower(trim(email)), '@', 2)) as provider,
               if(dom.canonical = 'gmail.com', replace(split_part(lower(trim(email)), '@', 1), '.', ''),
                  split_part(lower(trim(email)), '@', 1)) || '@' || provider as account_email
        from raw_users
        -- fixed values: providers' spellings
        left join (values ('gmail.com', 'gmail.com'), ('googlemail.com', 'gmail.com'), ('gmial.com', 'gmail.com'),
                          ('gmai.com', 'gmail.com'), ('gamil.com', 'gmail.com'), ('yaho.com', 'yahoo.com'),
                          ('yahooo.com', 'yahoo.com'), ('yaho.co', 'yahoo.com'), ('hotmial.com', 'hotmail.com'),
                          ('hotmal.com', 'hotmail.com'), ('outlok.com', 'outlook.com'), ('outlookk.com', 'outlook.com')
                  ) as dom(spelling, canonical) on dom.spelling = split_part(lower(trim(email)), '@', 2)
        """,
    ),
    "account_rank": (
        ("parsed_users",),
        """
        select *, row_number() over (partition by account_email
                    order by signup_at nulls last, user_id nulls last, email, first_name, last_name, country, signup_date) as place
        from parsed_users where signup_date is not null
        """,
    ),
    "stg_users": (
        ("account_rank",),
        "select user_id, first_name, last_name, email, country, signup_at, signup_date from account_rank where place = 1",
    ),
    "parsed_orders": (
        ("raw_orders",),
        """
        select order_id, user_id, strptime(raw_orders.order_date, '%Y-%m-%dT%H:%M:%SZ') as ordered_at,
               cast(left(raw_orders.order_date, 10) as date) as order_date,
               order_amount as order_value, lower(trim(raw_orders.order_status)) as order_status
        from raw_orders
        """,
    ),
    "stg_orders": (
        ("parsed_orders",),
        """
        select * from parsed_orders where order_value > 0
        qualify 1 = row_number() over (partition by order_id
                  order by order_status = 'completed' desc, ordered_at desc nulls first, order_value desc nulls first,
                           order_status, user_id, order_date)
        """,
    ),
    "stg_events": (
        ("raw_events",),
        """
        select event_id, user_id, session_id, lower(trim(raw_events.event_name)) as event_name,
               event_timestamp as event_at, cast(event_timestamp as date) as event_date,
               lower(trim(raw_events.device_type)) as device_type, page_url
        from raw_events where user_id is not null and session_id is not null
        """,
    ),
    "completed": (("stg_orders",), "select * from stg_orders where order_status = 'completed'"),
    "first_purchase": (
        ("stg_users", "completed"),
        """
        select u.user_id, u.signup_at, u.signup_date,
               t.first_purchase_at, t.first_purchase_date,
               f.order_id as first_purchase_order_id, f.order_value as first_purchase_value,
               coalesce(t.orders, 0) as total_orders_count,
               cast(coalesce(t.value, 0) as decimal(24,2)) as total_lifetime_value,
               t.first_purchase_at is not null as has_purchased
        from stg_users u
        left join (select user_id, count(order_id) as orders, sum(order_value) as value,
                          min(ordered_at) as first_purchase_at, min(order_date) as first_purchase_date
                   from completed group by user_id) t using (user_id)
        left join (select * from completed
                   qualify 1 = row_number() over (partition by user_id order by ordered_at nulls last, order_id nulls last)
                  ) f using (user_id)
        """,
    ),
    "session_totals": (
        ("stg_events",),
        """
        select session_id, user_id, min(device_type) as device_type, min(event_date) as session_date,
               min(event_at) as session_start_at, max(event_at) as session_end_at,
               count(event_id) as total_events_count,
               count(*) filter (event_name = 'page_view') as page_view_count,
               count(*) filter (event_name = 'add_to_cart') as add_to_cart_count,
               count(*) filter (event_name = 'purchase') as purchase_count,
               min(event_at) filter (event_name = 'page_view') as first_page_view_at,
               min(event_at) filter (event_name = 'add_to_cart') as first_add_to_cart_at,
               min(event_at) filter (event_name = 'purchase') as first_purchase_at
        from stg_events group by all
        """,
    ),
    "sessions": (
        ("session_totals",),
        """
        select *, cast(round(epoch(session_end_at - session_start_at)) as integer) as session_duration_seconds,
               page_view_count > 0 as has_page_view, add_to_cart_count > 0 as has_cart_add,
               purchase_count > 0 as has_purchase,
               coalesce(first_page_view_at <= first_add_to_cart_at, false) as has_sequential_cart,
               coalesce(first_page_view_at <= first_add_to_cart_at and first_add_to_cart_at <= first_purchase_at, false)
                 as has_sequential_purchase,
               case when has_sequential_purchase then 'purchase' when has_sequential_cart then 'add_to_cart'
                    when has_page_view then 'page_view' else 'none' end as furthest_funnel_step
        from session_totals
        """,
    ),
    "funnel_steps": (
        ("sessions",),
        """
        select 1 as funnel_step_order, 'page_view' as funnel_step, count(*) as session_count from sessions where has_page_view
        union all
        select 2, 'add_to_cart', count(*) from sessions where has_sequential_cart
        union all
        select 3, 'purchase', count(*) from sessions where has_sequential_purchase
        """,
    ),
    "funnel": (
        ("funnel_steps",),
        """
        select funnel_step_order, funnel_step, session_count,
               lag(session_count, 1, session_count) over steps as before, first_value(session_count) over steps as top,
               {pct:session_count:before} as step_conversion_pct, {pct:session_count:top} as overall_conversion_pct
        from funnel_steps window steps as (order by funnel_step_order)
        """,
    ),
    "order_days": (("stg_orders",), "select distinct order_date from stg_orders"),
    "revenue": (
        ("order_days", "completed"),
        """
        select d.order_date, cast(coalesce(sum(c.order_value), 0) as decimal(24,2)) as total_revenue,
               count(c.order_id) as order_count, count(distinct c.user_id) as distinct_user_count,
               {mean:sum(c.order_value):count(c.order_value)} as average_order_value
        from order_days d left join completed c on d.order_date = c.order_date
        group by d.order_date
        """,
    ),
    "user_months": (
        ("stg_users",),
        "select user_id, cast(date_trunc('month', signup_date) as date) as cohort_month from stg_users",
    ),
    "cohort_sizes": (
        ("user_months",),
        "select cohort_month, count(distinct user_id) as cohort_size from user_months group by 1",
    ),
    "spine": (
        ("cohort_sizes", "stg_orders", "stg_users"),
        """
        select cohort_month, cohort_size, cast(n as integer) as month_number,
               cast(cohort_month + to_months(cast(n as integer)) as date) as activity_month
        from cohort_sizes,
             unnest(range(0, 1 + date_diff('month', cohort_month,
                 greatest((select max(order_date) from stg_orders), (select max(signup_date) from stg_users))))) as months(n)
        """,
    ),
    "cohort_active": (
        ("user_months", "completed"),
        """
        select cohort_month, cast(date_trunc('month', order_date) as date) as activity_month,
               count(distinct user_id) as active_users
        from completed join user_months using (user_id) group by all
        """,
    ),
    "retention": (
        ("spine", "cohort_active"),
        """
        select s.cohort_month, s.cohort_size, s.month_number, coalesce(a.active_users, 0) as active_users,
               {pct:coalesce(a.active_users, 0):s.cohort_size} as retention_pct
        from spine s left join cohort_active a using (cohort_month, activity_month)
        """,
    ),
    # Incremental scenario: an older load, then a snapshot without one day.
    "old_orders": (
        ("stg_orders",),
        """
        select * from stg_orders
        where order_date <= (select max(order_date) from stg_orders) - 10 and order_id % 13 <> 0
        """,
    ),
    "target": (
        ("old_orders",),
        """
        select order_date,
               cast(coalesce(sum(order_value) filter (order_status = 'completed'), 0) as decimal(24,2)) as total_revenue,
               count(order_id) filter (order_status = 'completed') as order_count,
               count(distinct user_id) filter (order_status = 'completed') as distinct_user_count,
               {mean:sum(order_value) filter (order_status = 'completed'):count(*) filter (order_status = 'completed')}
                 as average_order_value
        from old_orders group by order_date
        """,
    ),
    "new_orders": (
        ("stg_orders", "target"),
        "select * from stg_orders where order_date <> (select max(order_date) from target)",
    ),
    "in_scope": (
        ("target", "new_orders"),
        """
        select order_date from new_orders where order_date >= (select max(order_date) - 7 from target)
        union
        select order_date from target where order_date >= (select max(order_date) - 7 from target)
        """,
    ),
    "recomputed": (
        ("in_scope", "new_orders"),
        """
        select s.order_date, cast(coalesce(sum(o.order_value), 0) as decimal(24,2)) as total_revenue,
               count(o.order_id) as order_count, count(distinct o.user_id) as distinct_user_count,
               {mean:sum(o.order_value):count(o.order_id)} as average_order_value
        from in_scope s left join new_orders o on o.order_date = s.order_date and o.order_status = 'completed'
        group by s.order_date
        """,
    ),
    "merged": (
        ("target", "recomputed"),
        """
        select * from target where order_date not in (select order_date from recomputed)
        union all
        select * from recomputed
        """,
    ),
    # Marts built from part of the orders, then incrementally from all of them.
    "target13": (
        ("stg_orders",),
        """
        select order_date,
               cast(coalesce(sum(order_value) filter (order_status = 'completed'), 0) as decimal(24,2)) as total_revenue,
               count(order_id) filter (order_status = 'completed') as order_count,
               count(distinct user_id) filter (order_status = 'completed') as distinct_user_count,
               {mean:sum(order_value) filter (order_status = 'completed'):count(*) filter (order_status = 'completed')}
                 as average_order_value
        from stg_orders where order_id % 13 <> 0 group by order_date
        """,
    ),
    "merged13": (
        ("target13", "revenue"),
        """
        select * from target13 where order_date < (select max(order_date) - 7 from target13)
        union all
        select * from revenue where order_date >= (select max(order_date) - 7 from target13)
        """,
    ),
    # The newest active day lost at the source.
    "lost_day": (("revenue",), "select max(order_date) as lost from revenue where order_count > 0"),
    "remaining": (
        ("parsed_orders", "lost_day"),
        """
        select * from parsed_orders where order_value > 0 and order_date <> (select lost from lost_day)
        qualify 1 = row_number() over (partition by order_id
                  order by order_status = 'completed' desc, ordered_at desc nulls first, order_value desc nulls first,
                           order_status, user_id, order_date)
        """,
    ),
    "remaining_days": (
        ("revenue", "remaining"),
        """
        select order_date from revenue where order_date >= (select max(order_date) - 7 from revenue)
        union
        select order_date from remaining where order_date >= (select max(order_date) - 7 from revenue)
        """,
    ),
    "healed": (
        ("revenue", "remaining", "remaining_days"),
        """
        select * from revenue where order_date < (select max(order_date) - 7 from revenue)
        union all
        select d.order_date, cast(coalesce(sum(o.order_value), 0) as decimal(24,2)) as total_revenue,
               count(o.order_id) as order_count, count(distinct o.user_id) as distinct_user_count,
               {mean:sum(o.order_value):count(o.order_id)} as average_order_value
        from remaining_days d left join remaining o on o.order_date = d.order_date and o.order_status = 'completed'
        group by d.order_date
        """,
    ),
    "tried_earlier": (
        ("parsed_orders",),
        """
        select * from parsed_orders where order_value > 0
        union all
        select * replace (ordered_at - interval 3 day as ordered_at, order_date - 3 as order_date,
                          if(order_id % 10 = 0, 'completed', 'pending') as order_status)
        from parsed_orders where order_value > 0 and order_id % 5 = 0
        """,
    ),
    # Results made to violate the checks.
    "bad_sessions": (
        ("sessions",),
        """
        select * replace (case total_events_count % 7 when 0 then -5 when 1 then 90000
                               else session_duration_seconds end as session_duration_seconds) from sessions
        """,
    ),
    "bad_first_purchase": (
        ("first_purchase",),
        """
        select * replace (if(user_id % 5 = 0, first_purchase_at - interval 400 day, first_purchase_at) as first_purchase_at,
                          if(user_id % 7 = 0, first_purchase_order_id + 1, first_purchase_order_id) as first_purchase_order_id)
        from first_purchase
        """,
    ),
    "bad_revenue": (
        ("revenue",),
        "select * replace (if(day(order_date) % 9 = 0, -total_revenue, total_revenue) as total_revenue) from revenue",
    ),
    "bad_retention": (
        ("retention",),
        "select * replace (if(month_number = 3, 101, retention_pct) as retention_pct) from retention where month_number % 5 <> 2",
    ),
    "bad_funnel": (
        ("funnel",),
        "select * replace (if(funnel_step_order = 3, 1000000000, session_count) as session_count) from funnel",
    ),
    "gap_events": (
        (),
        """
        select event_id, user_id, ts,
               sum(opens) over (partition by user_id order by ts, event_id) as session_seq
        from (select event_id, user_id, ts,
                     if(ts <= lag(ts) over (partition by user_id order by ts, event_id) + interval 30 minute, 0, 1) as opens
              from events where user_id is not null and ts is not null)
        """,
    ),
}


def _expand(sql: str) -> str:
    """Fill in the exact two-decimal forms ``{pct:a:b}`` and ``{mean:sum:count}``."""
    while "{" in sql:
        start = sql.index("{")
        end = sql.index("}", start)
        kind, a, b = sql[start + 1 : end].split(":")
        if kind == "pct":
            text = f"cast(if({b} = 0, 0, (20000 * cast({a} as hugeint) + ({b})) // (2 * ({b}))) as decimal(12,0)) * 0.01"
            text = f"cast({text} as decimal(9,2))"
        else:
            cents = f"cast(100 * coalesce({a}, 0) as hugeint)"
            text = f"cast(if({b} = 0, 0, (2 * {cents} + {b}) // (2 * {b})) as decimal(18,0)) * 0.01"
            text = f"cast({text} as decimal(18,2))"
        sql = sql[:start] + text + sql[end + 1 :]
    return sql


def _ordered(names: tuple[str, ...], done: list[str]) -> list[str]:
    for name in names:
        if name not in done:
            _ordered(CTES[name][0], done)
            done.append(name)
    return done


def sql(tables: tuple[str, ...], select: str) -> str:
    parts = [f"{name} as ({_expand(CTES[name][1])})" for name in _ordered(tables, [])]
    return (f"with {', '.join(parts)}\n" if parts else "") + _expand(select)


FIRST_PURCHASE_COLUMNS = (
    "user_id, signup_at, signup_date, first_purchase_at, first_purchase_date, first_purchase_order_id, "
    "first_purchase_value, total_orders_count, total_lifetime_value, has_purchased"
)
MODEL_CTE = {
    "stg_users": "stg_users",
    "stg_orders": "stg_orders",
    "stg_events": "stg_events",
    "int_user_first_purchase": "first_purchase",
    "int_sessionized_events": "sessions",
    "fct_revenue_trends": "revenue",
    "monthly_cohort_retention": "retention",
    "funnel_summary": "funnel",
}
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


def _result(check: str, table: str, column: str | None, count: str) -> str:
    col = f"'{column}'" if column else "cast(null as varchar)"
    return (
        f"select '{check}' as \"check\", '{table}' as \"table\", {col} as \"column\", "
        f"cast({count} as bigint) as violations, ({count}) = 0 as passed"
    )


def _count(select: str) -> str:
    return f"(select count(*) from ({select}))"


def _dq(check: str, table: str, tables: tuple[str, ...], violating: str, column: str | None = None) -> str:
    return sql(tables, _result(check, table, column, _count(violating)))


def _dq_unique() -> str:
    rows = [
        _result("unique", t, c, _count(f"select {c} from {MODEL_CTE[t]} where {c} is not null group by {c} having count(*) > 1"))
        for t, c in UNIQUE_COLUMN.items()
    ]
    return sql(tuple(MODEL_CTE[t] for t in UNIQUE_COLUMN), " union all ".join(rows))


def _dq_not_null() -> str:
    rows = [
        _result("not_null", t, c, f"(select count(*) - count({c}) from {MODEL_CTE[t]})")
        for t, columns in NOT_NULL_COLUMNS.items()
        for c in columns
    ]
    return sql(tuple(MODEL_CTE[t] for t in NOT_NULL_COLUMNS), " union all ".join(rows))


def _dq_columns_seeded() -> str:
    """Where a table's key is divisible by three, all other checked columns are missing; one step is unlisted."""
    rows = []
    for t, columns in NOT_NULL_COLUMNS.items():
        for c in columns:
            missing = "false" if c in NULL_KEYS[t] else f"{NULL_KEYS[t]} % 3 = 0"
            rows.append(_result("not_null", t, c, f"(select count(*) from {MODEL_CTE[t]} where {c} is null or {missing})"))
    rows.append(
        _result("accepted_values", "funnel_summary", "funnel_step", "(select count(*) from funnel where funnel_step = 'add_to_cart')")
    )
    return sql(tuple(MODEL_CTE[t] for t in NOT_NULL_COLUMNS), " union all ".join(rows))


# Name -> (check, table, CTEs, violating rows); ``<x>`` stands for the checked table, which may be replaced.
BUSINESS = {
    "dq_session_duration": (
        "session_duration",
        "int_sessionized_events",
        ("sessions",),
        "select 1 from <sessions> where session_duration_seconds not between 0 and 86400",
    ),
    "dq_causality": (
        "purchase_after_signup",
        "int_user_first_purchase",
        ("first_purchase", "stg_users"),
        """
        select 1 from <first_purchase> f, stg_users u
        where f.user_id = u.user_id and first_purchase_date is not null and f.first_purchase_at <= u.signup_at
        """,
    ),
    "dq_first_completed": (
        "first_purchase_completed",
        "int_user_first_purchase",
        ("first_purchase", "stg_orders"),
        """
        select 1 from <first_purchase> f join stg_orders o on o.order_id = f.first_purchase_order_id
        where f.has_purchased and o.order_status <> 'completed'
        """,
    ),
    "dq_revenue_non_negative": (
        "revenue_non_negative",
        "fct_revenue_trends",
        ("revenue",),
        "select 1 from <revenue> where least(total_revenue, average_order_value) < 0",
    ),
    "dq_revenue_reconcile": (
        "revenue_reconciles",
        "fct_revenue_trends",
        ("revenue", "completed"),
        """
        select 1 from (select order_date from <revenue> union select order_date from completed)
        left join <revenue> r using (order_date)
        left join (select order_date, sum(order_value) as v, count(order_id) as n, count(distinct user_id) as u
                   from completed group by order_date) c using (order_date)
        where coalesce(total_revenue, 0) <> coalesce(v, 0) or coalesce(order_count, 0) <> coalesce(n, 0)
           or coalesce(distinct_user_count, 0) <> coalesce(u, 0)
        """,
    ),
    "dq_retention_range": (
        "retention_range",
        "monthly_cohort_retention",
        ("retention",),
        "select 1 from <retention> where retention_pct not between 0 and 100",
    ),
    "dq_cohort_spine": (
        "cohort_spine_complete",
        "monthly_cohort_retention",
        ("retention", "user_months", "stg_orders", "stg_users"),
        """
        select 1 from (select distinct cohort_month,
                         date_diff('month', cohort_month, greatest((select max(order_date) from stg_orders),
                                                                   (select max(signup_date) from stg_users))) as last
                       from user_months)
        left join (select cohort_month, min(month_number) as lo, max(month_number) as hi, count(*) as n
                   from <retention> group by 1) using (cohort_month)
        where lo is null or lo <> 0 or hi <> last or n <> last + 1
        """,
    ),
    "dq_funnel_monotonic": (
        "funnel_monotonic",
        "funnel_summary",
        ("funnel",),
        "select 1 from (select session_count > lag(session_count) over (order by funnel_step_order) as up from <funnel>) where up",
    ),
}


def _business(name: str, replaced: dict[str, str]) -> str:
    """A business check with some of its tables replaced."""
    check, table, tables, violating = BUSINESS[name]
    for cte in tables:
        violating = violating.replace(f"<{cte}>", replaced.get(cte, cte))
    return _dq(check, table, tuple(replaced.get(t, t) for t in tables), violating)


def _seeded(name: str) -> str:
    checked = BUSINESS[name][2][0]
    return _business(name, {checked: f"bad_{checked}"})


def _all_checks(replaced: dict[str, str]) -> str:
    """All 68 results, with some tables replaced."""
    suite = [_dq_unique(), _dq_not_null(), ORACLE["dq_accepted"], *(_business(name, replaced) for name in BUSINESS)]
    return " union all ".join(f"(select * from ({one}))" for one in suite)


def _metrics(tables: tuple[str, ...], total: str, metrics: dict[str, str]) -> str:
    counts = {"total_rows": total, **metrics}
    rows = [
        f"select '{m}' as metric, cast({c} as bigint) as row_count, {{pct:{c}:{total}}} as pct" for m, c in counts.items()
    ]
    return sql(tables, " union all ".join(rows))


def _outcomes(tables: tuple[str, ...], rows: list[tuple[str, str, str]]) -> str:
    return sql(
        tables,
        " union all ".join(
            f"select '{t}' as \"table\", '{o}' as outcome, cast({c} as bigint) as row_count" for t, o, c in rows
        ),
    )


def _orphans(rows: str, users: str) -> str:
    return f"(select count(*) from {rows} x where user_id is not null and not exists (select 1 from {users} u where u.user_id = x.user_id))"


REVENUE = "order_date, total_revenue, order_count, distinct_user_count, average_order_value"
FUNNEL = "funnel_step_order, funnel_step, session_count, step_conversion_pct, overall_conversion_pct"
WEEKDAYS = "['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']"

ORACLE: dict[str, str] = {
    "stg_users": sql(("stg_users",), "select * from stg_users"),
    "stg_orders": sql(("stg_orders",), "select * from stg_orders"),
    "stg_events": sql(("stg_events",), "select * from stg_events"),
    "user_first_purchase": sql(("first_purchase",), f"select {FIRST_PURCHASE_COLUMNS} from first_purchase"),
    "sessionized_events": sql(("sessions",), "select * from sessions"),
    "funnel_summary": sql(("funnel",), f"select {FUNNEL} from funnel"),
    "funnel_step_lag": sql(
        ("funnel_steps",),
        """
        select funnel_step_order, funnel_step, session_count, {pct:session_count:before} as step_conversion_pct
        from (select *, lag(session_count, 1, session_count) over (order by funnel_step_order) as before from funnel_steps)
        """,
    ),
    "funnel_distinct_sessions": sql(
        ("sessions",),
        """
        , counted as (
          select 1 as funnel_step_order, 'page_view' as funnel_step,
                 count(distinct session_id) filter (has_page_view) as session_count from sessions
          union all
          select 2, 'add_to_cart', count(distinct session_id) filter (has_sequential_cart) from sessions
          union all
          select 3, 'purchase', count(distinct session_id) filter (has_sequential_purchase) from sessions)
        select funnel_step_order, funnel_step, session_count, {pct:session_count:before} as step_conversion_pct,
               {pct:session_count:top} as overall_conversion_pct
        from (select *, lag(session_count, 1, session_count) over w as before, first_value(session_count) over w as top
              from counted window w as (order by funnel_step_order))
        """,
    ),
    "revenue_trends_full": sql(("revenue",), f"select {REVENUE} from revenue"),
    "revenue_trends_incremental": sql(("merged",), f"select {REVENUE} from merged"),
    "revenue_slice": sql(("recomputed",), f"select {REVENUE} from recomputed"),
    "revenue_rolling_7": sql(
        ("revenue",),
        """
        select order_date, total_revenue, average_order_value,
               cast(sum(total_revenue) over week as double) / count(*) over week as revenue_7d_mean,
               cast(sum(average_order_value) over week as double) / count(*) over week as aov_7d_mean
        from revenue window week as (order by order_date nulls last rows between 6 preceding and current row)
        """,
    ),
    "revenue_kpis": sql(
        ("revenue",),
        """
        select count(*) as tracked_days, count(*) filter (order_count > 0) as active_days,
               cast(sum(total_revenue) as decimal(30,2)) as total_revenue, cast(sum(order_count) as bigint) as completed_orders,
               {mean:sum(average_order_value) filter (order_count > 0):count(*) filter (order_count > 0)} as mean_active_day_aov
        from revenue
        """,
    ),
    "latest_active_day": sql(
        ("revenue",),
        f"""
        select {REVENUE} from revenue
        where order_count > 0 order by order_date desc limit 1
        """,
    ),
    "cohort_retention": sql(
        ("retention",), "select cohort_month, cohort_size, month_number, active_users, retention_pct from retention"
    ),
    "cohort_matrix": sql(
        ("retention",),
        "select cohort_month, "
        + ", ".join(f"max(case when month_number = {k} then retention_pct end) as m{k}" for k in range(96))
        + " from retention group by cohort_month",
    ),
    "cohort_curves": sql(
        ("retention",),
        """
        select cohort_month, 'Cohort ' || strftime(cohort_month, '%Y-%m') || ' (N=' || cohort_size || ')' as label,
               string_agg(month_number || ':' || retention_pct, ',' order by month_number) as curve
        from retention group by cohort_month, cohort_size
        """,
    ),
    "cohort_kpis": sql(
        ("retention", "cohort_sizes"),
        """
        select (select count(*) from retention) as mart_rows, count(*) as cohorts, cast(sum(cohort_size) as bigint) as cohorted_users
        from cohort_sizes
        """,
    ),
    "dq_unique": _dq_unique(),
    "dq_not_null": _dq_not_null(),
    "dq_accepted": _dq(
        "accepted_values",
        "funnel_summary",
        ("funnel",),
        "select 1 from funnel where funnel_step not in ('page_view', 'add_to_cart', 'purchase')",
        "funnel_step",
    ),
    **{name: _business(name, {}) for name in BUSINESS},
    **{f"{name}_seeded": _seeded(name) for name in BUSINESS},
    "dq_columns_seeded": _dq_columns_seeded(),
    "dq_shared_sessions": sql(
        ("sessions",),
        "select session_id, count(*) as occurrences from sessions where session_id is not null group by 1 having count(*) > 1",
    ),
    "revenue_parity": sql(
        ("merged", "revenue"),
        """
        select coalesce(m.order_date, r.order_date) as order_date,
               case when m.order_date is null then 'missing left' when r.order_date is null then 'missing right'
                    else concat_ws(',',
                      if(m.total_revenue is distinct from r.total_revenue, 'total_revenue', null),
                      if(m.order_count is distinct from r.order_count, 'order_count', null),
                      if(m.distinct_user_count is distinct from r.distinct_user_count, 'distinct_user_count', null),
                      if(m.average_order_value is distinct from r.average_order_value, 'average_order_value', null)) end
                 as differs_in
        from merged m full join revenue r on m.order_date = r.order_date
        where differs_in <> ''
        """,
    ),
    "audit_users": _metrics(
        ("parsed_users",),
        "(select count(*) from parsed_users)",
        {
            "duplicate_accounts": "(select count(account_email) - count(distinct account_email) from parsed_users)",
            "null_signup_date": "(select count(*) from parsed_users where signup_date is null)",
            "null_country": "(select count(*) from parsed_users where country is null)",
        },
    ),
    "audit_orders": _metrics(
        ("raw_orders", "raw_users"),
        "(select count(*) from raw_orders)",
        {
            "orphaned_user": _orphans("raw_orders", "raw_users"),
            "non_positive_value": "(select count(*) from raw_orders where order_amount <= 0)",
            "duplicate_order_ids": "(select count(*) from (select order_id from raw_orders group by 1 having count(*) > 1))",
        },
    ),
    "audit_events": _metrics(
        ("raw_events", "raw_users"),
        "(select count(*) from raw_events)",
        {
            "orphaned_user": _orphans("raw_events", "raw_users"),
            **{
                step: f"(select count(*) from raw_events where lower(trim(event_name)) = '{step}')"
                for step in ("page_view", "add_to_cart", "purchase")
            },
        },
    ),
    "audit_duplicate_conflicts": sql(
        ("parsed_orders",),
        """
        select conflict_type, count(*) as duplicate_sets, {pct:count(*):sum(count(*)) over ()} as pct
        from (select coalesce(nullif(concat_ws(' + ',
                       if(count(distinct order_value) > 1, 'order_value', null),
                       if(count(distinct order_status) > 1, 'order_status', null),
                       if(count(distinct ordered_at) > 1, 'ordered_at', null)), ''), 'identical') as conflict_type
              from parsed_orders group by order_id having count(*) > 1)
        group by conflict_type
        """,
    ),
    "audit_duplicate_accounts": sql(
        ("account_rank",),
        """
        select k.account_email, k.user_id as kept_user_id, k.email as kept_email, k.signup_at as kept_signup_at,
               d.user_id as duplicate_user_id, d.email as duplicate_email, d.signup_at as duplicate_signup_at
        from account_rank k join account_rank d using (account_email)
        where k.place = 1 and d.place > 1
        """,
    ),
    "signups_per_month": sql(
        ("parsed_users",),
        "select coalesce(strftime(signup_date, '%Y-%m'), 'NULL (Missing)') as month, count(*) as row_count from parsed_users group by 1",
    ),
    "orders_per_weekday": sql(
        ("parsed_orders",),
        f"""
        select cast(i as integer) as weekday_number, ({WEEKDAYS})[i + 1] as weekday, count(order_date) as row_count
        from range(7) as days(i) left join parsed_orders on isodow(order_date) = i + 1 group by i
        """,
    ),
    "weekend_share": sql(
        ("completed",),
        """
        select count(*) as completed_orders, count(*) filter (isodow(order_date) > 5) as weekend_orders,
               {pct:count(*) filter (isodow(order_date) > 5):count(*)} as weekend_pct
        from completed
        """,
    ),
    "attrition": _outcomes(
        ("parsed_users", "stg_users", "parsed_orders", "stg_orders", "raw_events", "stg_events"),
        [
            ("users", "raw", "(select count(*) from parsed_users)"),
            ("users", "dropped_no_signup_date", "(select count(*) from parsed_users where signup_date is null)"),
            (
                "users",
                "dropped_duplicate_account",
                "(select count(account_email) - count(distinct account_email) from parsed_users where signup_date is not null)",
            ),
            (
                "users",
                "dropped_null_email",
                "(select greatest(count(*) - 1, 0) from parsed_users where signup_date is not null and account_email is null)",
            ),
            ("users", "kept", "(select count(*) from stg_users)"),
            ("orders", "raw", "(select count(*) from parsed_orders)"),
            (
                "orders",
                "dropped_non_positive_value",
                "(select count(*) from parsed_orders where order_value is null or order_value <= 0)",
            ),
            (
                "orders",
                "dropped_retry",
                "(select count(order_id) - count(distinct order_id) from parsed_orders where order_value > 0)",
            ),
            (
                "orders",
                "dropped_null_order_id",
                "(select greatest(count(*) - 1, 0) from parsed_orders where order_value > 0 and order_id is null)",
            ),
            ("orders", "kept", "(select count(*) from stg_orders)"),
            ("orders", "kept_orphaned_user", _orphans("stg_orders", "stg_users")),
            ("events", "raw", "(select count(*) from raw_events)"),
            (
                "events",
                "dropped_no_user_or_session",
                "(select count(*) from raw_events) - (select count(*) from stg_events)",
            ),
            ("events", "kept", "(select count(*) from stg_events)"),
            ("events", "kept_orphaned_user", _orphans("stg_events", "stg_users")),
        ],
    ),
    "sample_non_positive_orders": sql(
        ("parsed_orders",),
        """
        select order_id, user_id, ordered_at, order_value, order_status from parsed_orders where order_value <= 0
        order by order_id, ordered_at, order_value, order_status limit 5
        """,
    ),
    "gap_sessions": sql(
        ("gap_events",),
        """
        select user_id, cast(session_seq as bigint) as session_seq, min(ts) as session_start_at, max(ts) as session_end_at,
               count(*) as total_events_count
        from gap_events group by user_id, session_seq
        """,
    ),
    "load_csv_orders": sql(("stg_orders",), "select * from stg_orders"),
    "revenue_published": sql(("merged",), f"select {REVENUE} from merged"),
    "revenue_by_month": sql(("merged",), f"select {REVENUE} from merged"),
    "order_feed_revenue": sql(("revenue",), f"select {REVENUE} from revenue"),
    # A session is emitted once the watermark, an hour behind the newest event, has passed its gap.
    "session_feed": sql(
        ("gap_events",),
        """
        select user_id, min(ts) as session_start_at, max(ts) as session_end_at, count(*) as total_events_count
        from gap_events group by user_id, session_seq
        having max(ts) + interval 30 minute <= (select max(ts) from events) - interval 1 hour
        """,
    ),
    "gap_session_events": sql(
        ("gap_events",),
        """
        select event_id, user_id, ts, cast(session_seq as bigint) as session_seq,
               user_id || '_' || cast(session_seq as bigint) as session_id
        from gap_events
        """,
    ),
    "order_feed_batches": sql(("revenue",), f"select {REVENUE} from revenue"),
    "session_feed_batches": sql(
        ("gap_events",),
        """
        select user_id, cast(session_seq as bigint) as session_seq, min(ts) as session_start_at, max(ts) as session_end_at,
               count(*) as total_events_count,
               max(ts) + interval 30 minute <= (select max(ts) from events) - interval 1 hour as closed
        from gap_events group by user_id, session_seq
        """,
    ),
    "session_feed_late": """
        select event_id % 3 as batch, count(*) as events,
               count(*) filter (ts < (select max(e.ts) - interval 1 hour from events e where e.event_id % 3 < events.event_id % 3)) as late_events
        from events group by 1
    """,
    "build_marts_revenue": sql(("merged13",), f"select {REVENUE} from merged13"),
    "build_marts_cohorts": sql(
        ("retention",), "select cohort_month, cohort_size, month_number, active_users, retention_pct from retention"
    ),
    "build_marts_funnel": sql(("funnel",), f"select {FUNNEL} from funnel"),
    "deletion_recovery": sql(
        ("healed", "remaining"),
        f"""
        select {REVENUE}, total_revenue <> coalesce(v, 0) or order_count <> coalesce(n, 0) or distinct_user_count <> coalesce(u, 0) as differs
        from healed left join (select order_date, sum(order_value) as v, count(order_id) as n, count(distinct user_id) as u
                               from remaining where order_status = 'completed' group by order_date) using (order_date)
        """,
    ),
    "attempts_since": sql(
        ("tried_earlier",),
        """
        select * from (
          select * from tried_earlier
          qualify 1 = row_number() over (partition by order_id
                    order by order_status = 'completed' desc, ordered_at desc nulls first, order_value desc nulls first,
                             order_status, user_id, order_date))
        where order_date >= (select max(order_date) - 30 from tried_earlier)
        """,
    ),
    "buyers_per_month": sql(
        ("completed",),
        "select strftime(order_date, '%Y-%m') as month, count(distinct user_id) as buyers from completed group by 1",
    ),
    "cohort_retention_merged": sql(
        ("retention",), "select cohort_month, cohort_size, month_number, active_users, retention_pct from retention"
    ),
    "attempts_since_shuffled": sql(
        ("stg_orders",),
        """
        select * replace ((order_id * 2654435761) % 4294967296 as order_id) from stg_orders
        where order_date >= (select max(order_date) - 2 from stg_orders)
        """,
    ),
    "first_purchase_by_user": sql(("first_purchase",), f"select {FIRST_PURCHASE_COLUMNS} from first_purchase"),
    "cohort_retention_by_user": sql(
        ("retention",), "select cohort_month, cohort_size, month_number, active_users, retention_pct from retention"
    ),
    "load_broken_orders": sql(
        ("raw_orders",),
        """
        select if(order_id % 50 = 17, null, order_id) as order_id, user_id, order_date, order_amount, order_status
        from raw_orders where order_id % 50 not in (3, 7, 11, 13, 19)
        """,
    ),
    "load_broken_orders_rejects": sql(
        ("raw_orders",),
        """
        select case order_id % 50 when 11 then 'order_amount' when 13 then 'user_id' when 19 then 'order_id+order_amount' else 'fields' end as reason,
               count(*) as row_count
        from raw_orders where order_id % 50 in (3, 7, 11, 13, 19) group by 1
        """,
    ),
    "guarded_load": sql(
        ("raw_orders",),
        """
        select number, step, outcome, if(number < 3, (select count(*) from raw_orders where order_id % 2 = 0), (select count(*) from raw_orders)) as row_count
        from (values (1, 'first', 'written'), (2, 'second', 'refused'), (3, 'forced', 'written'), (4, 'elsewhere', 'not allowed')) as steps(number, step, outcome)
        """,
    ),
    "load_parquet_orders": sql(("stg_orders",), "select * from stg_orders"),
    "exact_order_times": sql(("order_rows",), "select order_id, ordered_ts as ordered_at, order_amount from order_rows"),
    "models_as_views": sql(
        ("stg_users", "first_purchase"),
        """
        select u.country, count(*) as users, count(*) filter (f.has_purchased) as buyers,
               cast(sum(f.total_lifetime_value) as decimal(34,2)) as lifetime_value
        from stg_users u join first_purchase f using (user_id) group by u.country
        """,
    ),
    "report_order_cohorts": sql(
        ("retention",),
        """
        select cohort_month, cohort_size, month_number, active_users, retention_pct,
               cast(row_number() over (order by cohort_month, month_number) as integer) as position from retention
        """,
    ),
    "report_order_funnel": sql(
        ("funnel",), f"select {FUNNEL}, cast(row_number() over (order by funnel_step_order) as integer) as position from funnel"
    ),
    "load_raw_tables": sql(
        ("raw_users", "raw_orders", "raw_events"),
        """
        select 'users' as "table", count(*) as row_count, count(distinct user_id) as distinct_keys, cast(sum(user_id) as bigint) as sum_of_keys from raw_users
        union all
        select 'orders', count(*), count(distinct order_id), cast(sum(order_id) as bigint) from raw_orders
        union all
        select 'events', count(*), count(distinct event_id), cast(sum(event_id) as bigint) from raw_events
        """,
    ),
}
ORACLE["build_marts_checks"] = _all_checks({"revenue": "merged13"})
