"""DuckDB SQL for the registered queries, written against the same parquet views."""

from __future__ import annotations

from forgemeter.plans.rules import CONTRIBUTION_RULES, PULL_RULES, SOURCE_RULES

# Input rows -----------------------------------------------------------------

LINES = """
lines AS (
    SELECT concat('user_', l_suppkey) AS username, l_shipdate::DATE AS date, l_returnflag AS flag
    FROM lineitem
)"""

LONG = f"""{LINES},
days AS (
    SELECT username, date, sum(CASE WHEN flag = 'N' THEN 0 ELSE 1 END)::INTEGER AS n
    FROM lines GROUP BY ALL
)"""

COPIES = f"""{LINES},
copies AS (
    SELECT username, date, count(*)::INTEGER AS n, ascii(flag) AS arrival
    FROM lines GROUP BY username, date, flag
)"""

DENSE = """
days AS (
    SELECT concat('user_', user_id) AS username, ts::DATE AS date,
           sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)::INTEGER AS n
    FROM events GROUP BY ALL
)"""

ORDERS = """
reviews AS (
    SELECT c_mktsegment || '/' || o_orderpriority AS repo_name,
           o_orderkey AS pr_id,
           CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'closed' END AS state,
           o_orderdate AS created_at,
           CASE o_orderstatus WHEN 'F' THEN (
               SELECT min(l_shipdate) FROM lineitem
               WHERE l_orderkey = o_orderkey AND l_shipdate > o_orderdate) END AS merged_at,
           c_name AS user_login
    FROM orders JOIN customer ON c_custkey = o_custkey
)"""

EVENTS = """
reviews AS (
    SELECT 'org/repo_' || (regexp_extract(props, '([0-9]+)', 1)::INTEGER % 10) AS repo_name,
           event_id AS pr_id,
           CASE event_type WHEN 'view' THEN 'open' ELSE 'closed' END AS state,
           ts AS created_at,
           CASE WHEN event_type IN ('purchase', 'click', 'signup')
                THEN lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) END AS merged_at,
           concat('user_', user_id) AS user_login
    FROM events
)"""

LONG_AS_OF = "DATE '2001-11-04'"
DENSE_AS_OF = "DATE '2024-01-31'"
ORDERS_AS_OF = "DATE '2001-08-01'"

# Shorthands -----------------------------------------------------------------

DAY_NAMES = "rpad(strftime({d}, '%A'), 9, ' ') AS day_of_week, dayofweek({d})::INTEGER AS day_of_week_num"
MONTH_NAMES = "rpad(strftime({d}, '%B'), 9, ' ') AS month_name, month({d})::INTEGER AS month_num"

MERGED = "count(*) FILTER (WHERE state = 'closed' AND merged_at IS NOT NULL)"
DROPPED = "count(*) FILTER (WHERE state = 'closed' AND merged_at IS NULL)"
OPEN = "count(*) FILTER (WHERE state = 'open')"
CLOSED = "count(*) FILTER (WHERE state = 'closed')"
RATE = f"""CASE WHEN {CLOSED} > 0
    THEN ((20000 * {MERGED} + {CLOSED}) // (2 * {CLOSED}))::DOUBLE / 100 END"""
MICROS = "date_diff('microsecond', created_at, merged_at)"
DAY_US = "86400000000"
# Whole hundredths of a day by integer division of HUGEINTs, exact.
AVG_DAYS = f"""CASE WHEN count({MICROS}) > 0
    THEN ((200 * sum({MICROS})::HUGEINT + count({MICROS}) * {DAY_US}) // (2 * count({MICROS}) * {DAY_US}))::DOUBLE / 100
    END"""


def hundredths(num: str, den: str) -> str:
    """num / den rounded half away from zero to two digits."""
    return f"(sign({num}) * ((200 * abs({num}) + ({den})) // (2 * ({den}))))::DOUBLE / 100"


# Daily activity -------------------------------------------------------------


def contrib(as_of: str) -> dict[str, str]:
    """SELECTs over the view ``days``."""
    totals = """count(*)::BIGINT AS days_with_contributions, sum(n)::BIGINT AS total_contributions,
        sum(n)::DOUBLE / count(*) AS avg_daily_contributions,
        max(n) AS max_daily_contributions, min(n) AS min_daily_contributions"""
    return {
        "contrib_patterns": f"""
            SELECT username, {DAY_NAMES.format(d='date')}, {MONTH_NAMES.format(d='date')},
                   count(DISTINCT date)::BIGINT AS days_with_contributions,
                   sum(n)::BIGINT AS total_contributions,
                   sum(n)::DOUBLE / count(*) AS avg_contributions, max(n) AS max_contributions
            FROM days WHERE n > 0 GROUP BY ALL""",
        "contrib_leaderboard": f"""
            SELECT username, d AS days_active, t AS total_contributions,
                   {hundredths('t', 'd')} AS avg_daily_contributions,
                   m AS max_daily_contributions, last AS last_contribution_date,
                   r1 AS rank_by_total, r2 AS rank_by_avg, r3 AS rank_by_consistency,
                   round((5 * r1 + 3 * r2 + 2 * r3)::DOUBLE / 10, 2) AS overall_score
            FROM (SELECT *, rank() OVER (ORDER BY t DESC) AS r1,
                         rank() OVER (ORDER BY t::DOUBLE / d DESC) AS r2,
                         rank() OVER (ORDER BY d DESC) AS r3
                  FROM (SELECT username, count(*)::BIGINT AS d, sum(n)::BIGINT AS t, max(n) AS m, max(date) AS last
                        FROM days GROUP BY username))""",
        "contrib_monthly": f"""
            SELECT username, date_trunc('month', date)::DATE AS month_start,
                   strftime(date_trunc('month', date), '%Y-%m') AS month_label, {totals},
                   {hundredths('100 * count(*)', 'max(day(last_day(date)))')} AS contribution_rate_percent
            FROM days GROUP BY username, date_trunc('month', date)""",
        "contrib_weekly": f"""
            SELECT username, date_trunc('week', date)::DATE AS week_start, {totals}
            FROM days GROUP BY username, date_trunc('week', date)""",
        "contrib_recent": f"""
            SELECT username, date, n AS contribution_count,
                   sum(n) OVER week::BIGINT AS contributions_last_7_days,
                   sum(n) OVER week::DOUBLE / count(*) OVER week AS avg_contributions_last_7_days,
                   sum(n) OVER month::BIGINT AS contributions_last_30_days,
                   sum(n) OVER month::DOUBLE / count(*) OVER month AS avg_contributions_last_30_days
            FROM days WHERE date >= {as_of} - 90
            WINDOW week AS (PARTITION BY username ORDER BY date ROWS 6 PRECEDING),
                   month AS (PARTITION BY username ORDER BY date ROWS 29 PRECEDING)""",
        "contrib_streaks": f"""
            SELECT username, min(date) AS streak_start, max(date) AS streak_end,
                   count(*)::BIGINT AS streak_length_days, sum(n)::BIGINT AS streak_total_contributions,
                   sum(n)::DOUBLE / count(*) AS streak_avg_contributions,
                   CASE WHEN max(date) >= {as_of} - 1 THEN 'active' ELSE 'ended' END AS streak_status
            FROM (SELECT *, sum(CASE WHEN gap = 1 THEN 0 ELSE 1 END)
                            OVER (PARTITION BY username ORDER BY date) AS island
                  FROM (SELECT *, date - lag(date) OVER (PARTITION BY username ORDER BY date) AS gap
                        FROM days WHERE n > 0))
            GROUP BY username, island HAVING count(*) >= 3""",
        "contrib_trends": f"""
            SELECT username, month_start, t AS monthly_contributions, p AS prev_month_contributions,
                   t - coalesce(p, 0) AS month_over_month_change,
                   CASE WHEN p > 0 THEN {hundredths('100 * (t - p)', 'p')} END AS month_over_month_pct_change,
                   {hundredths('s', 'k')} AS three_month_avg
            FROM (SELECT *, lag(t) OVER w AS p,
                         sum(t) OVER (w ROWS 2 PRECEDING)::BIGINT AS s, count(*) OVER (w ROWS 2 PRECEDING) AS k
                  FROM (SELECT username, date_trunc('month', date)::DATE AS month_start, sum(n)::BIGINT AS t
                        FROM days GROUP BY ALL)
                  WINDOW w AS (PARTITION BY username ORDER BY month_start))""",
        "contrib_user_summary": f"""
            SELECT username, count(DISTINCT date)::BIGINT AS total_days_with_contributions,
                   min(date) AS first_contribution_date, max(date) AS last_contribution_date,
                   sum(n)::BIGINT AS total_contributions, sum(n)::DOUBLE / count(*) AS avg_daily_contributions,
                   max(n) AS max_daily_contributions, round(stddev_samp(n), 6) AS stddev_daily_contributions,
                   (max(date) - min(date) + 1)::INTEGER AS total_days_in_range,
                   {hundredths('100 * count(*)', 'max(date) - min(date) + 1')} AS overall_activity_rate_percent,
                   ({as_of} - max(date))::INTEGER AS days_since_last_contribution
            FROM days GROUP BY username""",
    }


# Reviews --------------------------------------------------------------------


def pulls(as_of: str) -> dict[str, str]:
    """SELECTs over the view ``reviews``."""
    period = f"""count(*)::BIGINT AS total_pulls, {MERGED} AS merged_pulls,
        {DROPPED} AS closed_not_merged_pulls, {OPEN} AS open_pulls, {RATE} AS merge_rate_percent,
        count(DISTINCT user_login) AS unique_contributors, count(DISTINCT repo_name) AS unique_repos,
        {AVG_DAYS} AS avg_days_to_merge"""
    summary = f"""count(*)::BIGINT AS total_pulls, {MERGED} AS merged_pulls,
        {DROPPED} AS closed_not_merged_pulls, {OPEN} AS open_pulls, {RATE} AS merge_rate_percent,
        min(created_at) AS first_pr_date, max(created_at) AS last_pr_date, {AVG_DAYS} AS avg_days_to_merge"""
    detail = f"""user_login, repo_name, pr_id, state, created_at, merged_at,
        {MICROS}::DOUBLE / {DAY_US} AS days_to_merge"""
    return {
        "pulls_patterns": f"""
            SELECT user_login, {DAY_NAMES.format(d='created_at')}, {MONTH_NAMES.format(d='created_at')},
                   count(*)::BIGINT AS total_pulls, {MERGED} AS merged_pulls, {OPEN} AS open_pulls
            FROM reviews GROUP BY ALL""",
        "pulls_leaderboard": f"""
            SELECT *, round((4 * rank_by_total + 3 * rank_by_merged + 2 * rank_by_merge_rate + rank_by_repos)::DOUBLE
                            / 10, 2) AS overall_score
            FROM (SELECT *, rank() OVER (ORDER BY total_pulls DESC) AS rank_by_total,
                         rank() OVER (ORDER BY merged_pulls DESC) AS rank_by_merged,
                         rank() OVER (ORDER BY merge_rate_percent DESC NULLS LAST) AS rank_by_merge_rate,
                         rank() OVER (ORDER BY repos_contributed_to DESC) AS rank_by_repos
                  FROM (SELECT user_login, count(*)::BIGINT AS total_pulls, {MERGED} AS merged_pulls,
                               {OPEN} AS open_pulls, count(DISTINCT repo_name) AS repos_contributed_to,
                               {RATE} AS merge_rate_percent, {AVG_DAYS} AS avg_days_to_merge
                        FROM reviews GROUP BY user_login))""",
        "pulls_monthly": f"""
            SELECT date_trunc('month', created_at)::DATE AS month_start,
                   strftime(date_trunc('month', created_at), '%Y-%m') AS month_label, {period}
            FROM reviews GROUP BY date_trunc('month', created_at)""",
        "pulls_weekly": f"""
            SELECT date_trunc('week', created_at)::DATE AS week_start, {period}
            FROM reviews GROUP BY date_trunc('week', created_at)""",
        "pulls_recent": f"""
            SELECT {detail}, count(*) OVER w AS pulls_last_30_days,
                   count(*) FILTER (WHERE state = 'closed' AND merged_at IS NOT NULL) OVER w AS merged_last_30_days
            FROM reviews WHERE created_at >= {as_of} - 90
            WINDOW w AS (PARTITION BY user_login ORDER BY created_at, pr_id ROWS 29 PRECEDING)""",
        "pulls_repo_summary": f"""
            SELECT repo_name, {summary}, count(DISTINCT user_login) AS unique_contributors,
                   quantile_cont({MICROS}::DOUBLE, 0.5) / {DAY_US} AS median_days_to_merge
            FROM reviews GROUP BY repo_name""",
        "pulls_time_to_merge": f"""
            SELECT {detail}, {MICROS}::DOUBLE / 3600000000 AS hours_to_merge,
                   CASE WHEN merged_at IS NOT NULL THEN 'merged' WHEN state = 'closed' THEN 'closed_not_merged'
                        ELSE 'open' END AS pr_status
            FROM reviews WHERE merged_at IS NOT NULL OR state = 'closed'""",
        "pulls_trends": f"""
            SELECT month_start, strftime(month_start, '%Y-%m') AS month_label,
                   a AS monthly_pulls, m AS monthly_merged, pa AS prev_month_pulls, pm AS prev_month_merged,
                   a - coalesce(pa, 0) AS month_over_month_change,
                   m - coalesce(pm, 0) AS merged_month_over_month_change,
                   CASE WHEN pa > 0 THEN {hundredths('100 * (a - pa)', 'pa')} END AS month_over_month_pct_change,
                   {hundredths('sa', 'k')} AS three_month_avg_pulls,
                   {hundredths('sm', 'k')} AS three_month_avg_merged
            FROM (SELECT *, lag(a) OVER w AS pa, lag(m) OVER w AS pm, count(*) OVER (w ROWS 2 PRECEDING) AS k,
                         sum(a) OVER (w ROWS 2 PRECEDING)::BIGINT AS sa,
                         sum(m) OVER (w ROWS 2 PRECEDING)::BIGINT AS sm
                  FROM (SELECT date_trunc('month', created_at)::DATE AS month_start,
                               count(*)::BIGINT AS a, {MERGED} AS m
                        FROM reviews GROUP BY 1)
                  WINDOW w AS (ORDER BY month_start NULLS LAST))""",
        "pulls_user_summary": f"""
            SELECT user_login, {summary}, count(DISTINCT repo_name) AS repos_contributed_to
            FROM reviews GROUP BY user_login""",
    }


def over(view: str, select: str) -> str:
    return f"WITH {view.strip()} {select.strip()}"


_LONG_MARTS = contrib(LONG_AS_OF)
_ORDER_MARTS = pulls(ORDERS_AS_OF)
_EVENT_MARTS = pulls(DENSE_AS_OF)

ORACLE = {
    **{name: over(LONG, sql) for name, sql in _LONG_MARTS.items()},
    **{name: over(ORDERS, sql) for name, sql in _ORDER_MARTS.items()},
    "contrib_streaks": over(DENSE, contrib(DENSE_AS_OF)["contrib_streaks"]),
    "contrib_monthly_merged": over(LONG, _LONG_MARTS["contrib_monthly"]),
    "contrib_user_summary_merged": over(LONG, _LONG_MARTS["contrib_user_summary"]),
    "contrib_streaks_merged": over(LONG, _LONG_MARTS["contrib_streaks"]),
    "pulls_recent_micro": over(EVENTS, _EVENT_MARTS["pulls_recent"]),
    "pulls_repo_summary_micro": over(EVENTS, _EVENT_MARTS["pulls_repo_summary"]),
    "pulls_time_to_merge_micro": over(EVENTS, _EVENT_MARTS["pulls_time_to_merge"]),
    "pulls_user_summary_micro": over(EVENTS, _EVENT_MARTS["pulls_user_summary"]),
    "pulls_monthly_rolled": over(ORDERS, _ORDER_MARTS["pulls_monthly"]),
}

# Ingest ---------------------------------------------------------------------

FAILURE_KIND = """CASE WHEN username LIKE '%3' THEN 0
    ELSE (regexp_extract(username, '([0-9]+)', 1)::BIGINT + year(date)) % 7 END"""

# Users ending in 4 have a count too large on the 9th of a month, those ending in 6 too long a name.
TROUBLED_DAYS = """
troubled AS (
    SELECT *, CASE WHEN username LIKE '%6' THEN 'username: longer than 255'
                   WHEN username LIKE '%4' AND day(date) = 9 THEN 'contribution_count: not a int' END AS violation
    FROM days
), bad AS (SELECT DISTINCT username FROM troubled WHERE violation IS NOT NULL)"""

TROUBLED_REVIEWS = """
troubled AS (
    SELECT *, CASE WHEN repo_name LIKE 'MACHINERY/%' AND pr_id % 50 = 1 THEN 'user_login: longer than 255' END AS violation
    FROM reviews
), bad AS (SELECT DISTINCT repo_name FROM troubled WHERE violation IS NOT NULL)"""

ORACLE |= {
    "pull_pages_parsed": over(
        EVENTS,
        """SELECT repo_name, pr_id, state, created_at, merged_at,
                  CASE WHEN pr_id % 10 <> 7 THEN user_login END AS user_login
           FROM reviews""",
    ),
    "calendar_flattened": over(
        LONG, "SELECT username, date::VARCHAR AS date, n::VARCHAR AS count_text FROM days"
    ),
    "calendar_counts_cast": over(
        LONG,
        "SELECT username, date::VARCHAR AS date, n AS contribution_count FROM days WHERE day(date) NOT IN (2, 3, 5)",
    ),
    "calendar_triage": over(
        LONG,
        f"""SELECT DISTINCT username, year(date)::BIGINT AS range_seq,
                   CASE {FAILURE_KIND} WHEN 0 THEN 'fetch_failed' WHEN 1 THEN 'bad_json'
                        WHEN 2 THEN 'api_errors' WHEN 3 THEN 'user_missing' ELSE 'ok' END AS status
            FROM days""",
    ),
    "calendars_quarantined": over(
        LONG,
        f"""SELECT username, range_seq, CASE kind WHEN 0 THEN 502 ELSE 200 END AS http_status,
                   ['fetch_failed', 'bad_json', 'api_errors', 'user_missing'][kind + 1] AS status
            FROM (SELECT DISTINCT username, year(date)::BIGINT AS range_seq, {FAILURE_KIND} AS kind FROM days)
            WHERE kind < 4""",
    ),
    "calendar_failed_users": over(
        LONG,
        f"""SELECT username, count(*)::BIGINT AS ranges, count(*)::BIGINT AS failed_ranges
            FROM (SELECT DISTINCT username, year(date) AS y, {FAILURE_KIND} < 4 AS failed FROM days)
            GROUP BY username HAVING bool_and(failed)""",
    ),
    "known_dates": over(LINES, "SELECT DISTINCT username, date::VARCHAR AS date FROM lines"),
    "fetch_ranges": over(
        LONG,
        f"""SELECT username, seq AS range_seq, 'backfill' AS mode, make_date(1995 + seq, 1, 1) AS range_start,
                   least(make_date(1995 + seq, 12, 31), {LONG_AS_OF}) AS range_end
            FROM (SELECT concat('user_', c_custkey) AS username FROM customer)
            CROSS JOIN (SELECT range AS seq FROM range(0, 7))
            WHERE username NOT IN (SELECT username FROM days GROUP BY username HAVING count(*) >= 534)
            UNION ALL
            SELECT username, 0, 'incremental', {LONG_AS_OF} - 7, {LONG_AS_OF}
            FROM (SELECT concat('user_', c_custkey) AS username FROM customer)
            WHERE username IN (SELECT username FROM days GROUP BY username HAVING count(*) >= 534)""",
    ),
    "new_rows_merged": over(
        DENSE,
        """SELECT username, date, n + 1 AS contribution_count, 1::BIGINT AS arrival
           FROM days WHERE day(date) > 20""",
    ),
    "new_rows_restated": over(
        DENSE,
        """SELECT username, date, CASE WHEN day(date) >= 18 THEN n + 1 ELSE n END AS contribution_count,
                  CASE WHEN day(date) >= 18 THEN 1 ELSE 0 END::BIGINT AS arrival
           FROM days""",
    ),
    "calendars_refetched": over(
        DENSE,
        """SELECT username, date, CASE WHEN day(date) >= 18 THEN n + 100 ELSE n END AS contribution_count
           FROM days""",
    ),
    "calendars_refetched_kept": over(
        DENSE,
        """SELECT username, date, CASE WHEN day(date) > 25 THEN n + 100 ELSE n END AS contribution_count
           FROM days""",
    ),
    "calendars_isolated": over(
        f"{LONG},{TROUBLED_DAYS}",
        "SELECT username, date, n AS contribution_count FROM troubled WHERE username NOT IN (SELECT username FROM bad)",
    ),
    "calendars_refused": over(
        f"{LONG},{TROUBLED_DAYS}",
        """SELECT CASE WHEN username LIKE '%6' THEN rpad(username, 300, 'x') ELSE username END AS unit, violation,
                  date::VARCHAR AS date, CASE WHEN violation LIKE 'contribution%' THEN 3000000000 ELSE n END AS given_count
           FROM troubled WHERE username IN (SELECT username FROM bad)""",
    ),
    "pulls_isolated": over(
        f"{ORDERS},{TROUBLED_REVIEWS}",
        """SELECT repo_name, pr_id, state, created_at, merged_at FROM troubled
           WHERE repo_name NOT IN (SELECT repo_name FROM bad)""",
    ),
    "pulls_refused": over(
        f"{ORDERS},{TROUBLED_REVIEWS}",
        """SELECT repo_name AS unit, violation, count(*)::BIGINT AS reviews FROM troubled
           WHERE repo_name IN (SELECT repo_name FROM bad) GROUP BY ALL""",
    ),
    "pages_refetched": over(
        ORDERS,
        """SELECT pr_id, CASE WHEN created_at >= DATE '2000-01-01' THEN state ELSE 'open' END AS state,
                  CASE WHEN created_at >= DATE '2000-01-01' THEN merged_at END AS merged_at
           FROM reviews""",
    ),
    "pages_quarantined": over(
        ORDERS,
        """SELECT DISTINCT repo_name, pr_id // 100 AS seq, 'not_a_page' AS status,
                  '{"message": "Not Found"}' AS body
           FROM reviews WHERE pr_id // 100 % 7 = 3""",
    ),
    "upsert_counts": over(
        LONG,
        """SELECT username, date, CASE WHEN date > DATE '2000-03-31' THEN 2 * n ELSE n END AS contribution_count
           FROM days""",
    ),
    "upsert_pulls": over(
        ORDERS,
        """SELECT repo_name, pr_id, user_login, created_at,
                  CASE WHEN created_at >= DATE '2000-07-01' THEN state ELSE 'open' END AS state,
                  CASE WHEN created_at >= DATE '2000-07-01' THEN merged_at END AS merged_at
           FROM reviews""",
    ),
    "upsert_pull_fields": over(
        ORDERS,
        """SELECT repo_name, pr_id, created_at,
                  CASE WHEN created_at >= DATE '2001-01-01' THEN 'was ' || user_login ELSE user_login END AS user_login,
                  CASE WHEN created_at >= DATE '2000-07-01' THEN state ELSE 'open' END AS state,
                  CASE WHEN created_at >= DATE '2000-07-01' THEN merged_at END AS merged_at
           FROM reviews""",
    ),
    "schema_enforced": over(
        ORDERS,
        """SELECT pr_id AS order_key, CASE WHEN pr_id % 7 <> 0 THEN pr_id END AS pr_id,
                  CASE WHEN pr_id % 13 <> 0 THEN created_at END AS created_at,
                  CASE WHEN pr_id % 5 = 0 THEN 'repo_name: missing'
                       WHEN pr_id % 7 = 0 THEN 'pr_id: not a bigint'
                       WHEN pr_id % 11 = 0 AND 20 * length(state) > 50 THEN 'state: longer than 50'
                       WHEN pr_id % 13 = 0 THEN 'created_at: not a timestamp_ntz'
                       WHEN pr_id % 17 = 0 AND 30 * length(user_login) > 255 THEN 'user_login: longer than 255'
                  END AS violation
           FROM reviews""",
    ),
    "batch_day_duplicates": over(
        COPIES,
        """SELECT username, date, count(*)::BIGINT AS occurrences
           FROM copies GROUP BY username, date HAVING count(*) > 1""",
    ),
    "contrib_dedup": over(
        COPIES,
        """SELECT username, date, n AS contribution_count, 1::BIGINT AS row_num
           FROM copies QUALIFY row_number() OVER (PARTITION BY username, date ORDER BY arrival) = 1""",
    ),
    "contrib_dedup_largest": over(
        COPIES,
        """SELECT username, date, max(n) AS contribution_count, 1::BIGINT AS row_num
           FROM copies GROUP BY username, date""",
    ),
    "pulls_keyed": over(
        ORDERS,
        """SELECT *, row_number() OVER (ORDER BY created_at NULLS LAST, pr_id) AS primary_key FROM reviews""",
    ),
    "run_pulls_end_to_end": over(
        EVENTS + """,
        loaded AS (SELECT * REPLACE (CASE WHEN pr_id % 10 <> 7 THEN user_login END AS user_login) FROM reviews)""",
        _EVENT_MARTS["pulls_user_summary"].replace("FROM reviews", "FROM loaded"),
    ),
    "run_contributions_end_to_end": over(LONG, _LONG_MARTS["contrib_monthly"]),
    "raw_after_two_loads": over(
        DENSE,
        """SELECT username, date, CASE WHEN day(date) <= 20 THEN n ELSE n + 5 END AS contribution_count
           FROM days""",
    ),
}

# Data tests -----------------------------------------------------------------

DIRTY_REVIEWS = ORDERS.replace("reviews AS", "clean AS") + """,
reviews AS (
    SELECT CASE WHEN pr_id % 19 <> 0 THEN repo_name END AS repo_name,
           CASE WHEN pr_id % 10 = 3 THEN pr_id + 1 ELSE pr_id END AS pr_id,
           CASE WHEN pr_id % 23 = 0 THEN 'draft' WHEN pr_id % 29 = 0 THEN 'locked'
                WHEN pr_id % 31 <> 0 THEN state END AS state,
           CASE WHEN pr_id % 37 <> 0 THEN created_at END AS created_at,
           merged_at,
           CASE WHEN pr_id % 41 <> 0 THEN user_login END AS user_login
    FROM clean
)"""

DIRTY_DAYS = LONG.replace("days AS", "clean_days AS") + """,
staged_days AS (
    SELECT username, date, max(n) AS n
    FROM (SELECT CASE WHEN username NOT LIKE '%7' THEN username END AS username, date,
                 CASE WHEN day(date) <> 13 THEN n END AS n FROM clean_days)
    GROUP BY username, date
),
days AS (SELECT * FROM staged_days WHERE n IS NOT NULL)"""


def rule_sql(rule, table: str) -> str:
    column = f'"{rule.column}"'
    if rule.test == "not_null":
        failures = f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
    elif rule.test == "unique":
        failures = f"""SELECT count(*) FROM (
            SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"""
    else:
        words = ", ".join(f"'{v}'" for v in rule.values)
        failures = f"SELECT count(DISTINCT {column}) FROM {table} WHERE {column} NOT IN ({words})"
    return f"""SELECT '{rule.model}' AS model, '{rule.column}' AS "column", '{rule.test}' AS test,
        ({failures})::BIGINT AS failures"""


def suite_sql(views: str, rules, tables: dict[str, str]) -> str:
    parts = "\nUNION ALL ".join(rule_sql(r, tables.get(r.model, f"t_{r.model}")) for r in rules)
    return f"""WITH {views.strip()}
        SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({parts})"""


def _mart_views(selects: dict[str, str]) -> str:
    return "".join(f",\nt_{name} AS ({sql})" for name, sql in selects.items())


_STAGED = """,
t_contrib_staged AS (SELECT username, date, n AS contribution_count FROM staged_days)"""
_ON_REVIEWS = {"pulls_staged": "reviews"}
_STAGED_RULES = [r for r in PULL_RULES if r.model == "pulls_staged"]

ORACLE |= {
    "dq_not_null": suite_sql(DIRTY_REVIEWS, [r for r in _STAGED_RULES if r.test == "not_null"], _ON_REVIEWS),
    "dq_accepted_values": suite_sql(
        DIRTY_REVIEWS, [r for r in _STAGED_RULES if r.test == "accepted_values"], _ON_REVIEWS
    ),
    "dq_unique": over(
        DIRTY_REVIEWS,
        """SELECT 'raw_pulls' AS model, 'pr_id' AS "column", 'unique' AS test, f::BIGINT AS failures,
                  CASE WHEN f = 0 THEN 'pass' ELSE 'fail' END AS status
           FROM (SELECT count(*) AS f FROM (SELECT pr_id FROM reviews GROUP BY pr_id HAVING count(*) > 1))""",
    ),
    "dq_duplicated_values": over(
        DIRTY_REVIEWS, "SELECT pr_id, count(*) AS occurrences FROM reviews GROUP BY pr_id HAVING count(*) > 1"
    ),
    "batch_key_duplicates": over(
        DIRTY_REVIEWS, "SELECT pr_id, count(*) AS occurrences FROM reviews GROUP BY pr_id HAVING count(*) > 1"
    ),
    "dq_sources": suite_sql(DIRTY_REVIEWS, SOURCE_RULES, {"raw_pulls": "reviews"}),
    "dq_suite": suite_sql(
        DIRTY_DAYS + "," + DIRTY_REVIEWS + _STAGED + _mart_views(_LONG_MARTS) + _mart_views(_ORDER_MARTS),
        [*CONTRIBUTION_RULES, *PULL_RULES],
        _ON_REVIEWS,
    ),
}
