"""Column names, order and types of every table."""

import pytest

from forgemeter.operators import staging
from forgemeter.plans import contributions as c
from forgemeter.plans import pulls as p
from forgemeter.sources import samples

SF = "/root/testdata/sf0.001"

# The columns each table promises.
CONTRACT = {
    "contrib_staged": "username string, date date, contribution_count int, row_num bigint",
    "pulls_staged": (
        "repo_name string, pr_id bigint, state string, created_at timestamp_ntz, merged_at timestamp_ntz, "
        "user_login string, primary_key bigint"
    ),
    "contrib_patterns": (
        "username string, day_of_week string, day_of_week_num int, month_name string, month_num int, "
        "days_with_contributions bigint, total_contributions bigint, avg_contributions double, max_contributions int"
    ),
    "contrib_leaderboard": (
        "username string, days_active bigint, total_contributions bigint, avg_daily_contributions double, "
        "max_daily_contributions int, last_contribution_date date, rank_by_total bigint, rank_by_avg bigint, "
        "rank_by_consistency bigint, overall_score double"
    ),
    "contrib_monthly": (
        "username string, month_start date, month_label string, days_with_contributions bigint, "
        "total_contributions bigint, avg_daily_contributions double, max_daily_contributions int, "
        "min_daily_contributions int, contribution_rate_percent double"
    ),
    "contrib_recent": (
        "username string, date date, contribution_count int, contributions_last_7_days bigint, "
        "avg_contributions_last_7_days double, contributions_last_30_days bigint, "
        "avg_contributions_last_30_days double"
    ),
    "contrib_streaks": (
        "username string, streak_start date, streak_end date, streak_length_days bigint, "
        "streak_total_contributions bigint, streak_avg_contributions double, streak_status string"
    ),
    "contrib_trends": (
        "username string, month_start date, monthly_contributions bigint, prev_month_contributions bigint, "
        "month_over_month_change bigint, month_over_month_pct_change double, three_month_avg double"
    ),
    "contrib_user_summary": (
        "username string, total_days_with_contributions bigint, first_contribution_date date, "
        "last_contribution_date date, total_contributions bigint, avg_daily_contributions double, "
        "max_daily_contributions int, stddev_daily_contributions double, total_days_in_range int, "
        "overall_activity_rate_percent double, days_since_last_contribution int"
    ),
    "contrib_weekly": (
        "username string, week_start date, days_with_contributions bigint, total_contributions bigint, "
        "avg_daily_contributions double, max_daily_contributions int, min_daily_contributions int"
    ),
    "pulls_patterns": (
        "user_login string, day_of_week string, day_of_week_num int, month_name string, month_num int, "
        "total_pulls bigint, merged_pulls bigint, open_pulls bigint"
    ),
    "pulls_leaderboard": (
        "user_login string, total_pulls bigint, merged_pulls bigint, open_pulls bigint, repos_contributed_to bigint, "
        "merge_rate_percent double, avg_days_to_merge double, rank_by_total bigint, rank_by_merged bigint, "
        "rank_by_merge_rate bigint, rank_by_repos bigint, overall_score double"
    ),
    "pulls_monthly": (
        "month_start date, month_label string, total_pulls bigint, merged_pulls bigint, "
        "closed_not_merged_pulls bigint, open_pulls bigint, merge_rate_percent double, unique_contributors bigint, "
        "unique_repos bigint, avg_days_to_merge double"
    ),
    "pulls_recent": (
        "user_login string, repo_name string, pr_id bigint, state string, created_at timestamp_ntz, "
        "merged_at timestamp_ntz, days_to_merge double, pulls_last_30_days bigint, merged_last_30_days bigint"
    ),
    "pulls_repo_summary": (
        "repo_name string, total_pulls bigint, merged_pulls bigint, closed_not_merged_pulls bigint, "
        "open_pulls bigint, merge_rate_percent double, unique_contributors bigint, first_pr_date timestamp_ntz, "
        "last_pr_date timestamp_ntz, avg_days_to_merge double, median_days_to_merge double"
    ),
    "pulls_time_to_merge": (
        "user_login string, repo_name string, pr_id bigint, state string, created_at timestamp_ntz, "
        "merged_at timestamp_ntz, days_to_merge double, hours_to_merge double, pr_status string"
    ),
    "pulls_trends": (
        "month_start date, month_label string, monthly_pulls bigint, monthly_merged bigint, prev_month_pulls bigint, "
        "prev_month_merged bigint, month_over_month_change bigint, merged_month_over_month_change bigint, "
        "month_over_month_pct_change double, three_month_avg_pulls double, three_month_avg_merged double"
    ),
    "pulls_user_summary": (
        "user_login string, total_pulls bigint, merged_pulls bigint, closed_not_merged_pulls bigint, "
        "open_pulls bigint, merge_rate_percent double, first_pr_date timestamp_ntz, last_pr_date timestamp_ntz, "
        "repos_contributed_to bigint, avg_days_to_merge double"
    ),
    "pulls_weekly": (
        "week_start date, total_pulls bigint, merged_pulls bigint, closed_not_merged_pulls bigint, "
        "open_pulls bigint, merge_rate_percent double, unique_contributors bigint, unique_repos bigint, "
        "avg_days_to_merge double"
    ),
}

CONTRIBUTION_TABLES = {
    "contrib_staged": staging.dedup_contributions,
    "contrib_patterns": c.activity_patterns,
    "contrib_leaderboard": lambda days: c.leaderboard(c.user_summary(days)),
    "contrib_monthly": c.monthly,
    "contrib_recent": c.recent_activity,
    "contrib_streaks": c.streaks,
    "contrib_trends": lambda days: c.trends(c.monthly(days)),
    "contrib_user_summary": c.user_summary,
    "contrib_weekly": c.weekly,
}

PULL_TABLES = {
    "pulls_staged": staging.key_pulls,
    "pulls_patterns": lambda rows: p.activity_patterns(p.review_facts(rows)),
    "pulls_leaderboard": lambda rows: p.leaderboard(p.user_summary(p.review_facts(rows))),
    "pulls_monthly": lambda rows: p.monthly(p.review_facts(rows)),
    "pulls_recent": p.recent_activity,
    "pulls_repo_summary": lambda rows: p.repo_summary(p.review_facts(rows), rows),
    "pulls_time_to_merge": p.time_to_merge,
    "pulls_trends": lambda rows: p.trends(p.monthly(p.review_facts(rows))),
    "pulls_user_summary": lambda rows: p.user_summary(p.review_facts(rows)),
    "pulls_weekly": lambda rows: p.weekly(p.review_facts(rows)),
}


def test_the_contract_is_complete():
    assert set(CONTRACT) == {*CONTRIBUTION_TABLES, *PULL_TABLES}


@pytest.mark.parametrize("name", CONTRACT)
def test_columns(spark, name):
    if name in CONTRIBUTION_TABLES:
        table = CONTRIBUTION_TABLES[name](samples.dense_contributions(spark, SF))
    else:
        table = PULL_TABLES[name](samples.order_pulls(spark, SF))
    assert ", ".join(" ".join(column) for column in table.dtypes) == CONTRACT[name]
