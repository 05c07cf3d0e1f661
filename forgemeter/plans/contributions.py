"""Daily-activity tables.

Functions take the staged contributions (one row per ``username`` and ``date``),
or a table already built from them, and return an unsorted DataFrame
(``presentation.show_order`` sorts it for display). ``date`` being unique per user has two consequences: distinct days
are counted with a plain ``count``, and a user's window holds at most one row per
calendar day, so windows by user stay small however active the user is.

"Days" are recorded days, days with a zero count included, except where a
function filters on a positive count.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgemeter.functions import calendar as cal
from forgemeter.functions.rounding import percent, rounded_ratio
from forgemeter.operators.ordering import with_ranks

N = "contribution_count"
RECENT_DAYS = 90
MIN_STREAK_DAYS = 3


def activity_patterns(staged: DataFrame) -> DataFrame:
    """Per user, weekday and month of year (all years together); positive days."""
    day = F.col("date")
    return (
        staged.filter(F.col(N) > 0)
        .groupBy(
            "username",
            cal.weekday_number(day).alias("day_of_week_num"),
            F.month(day).alias("month_num"),
        )
        .agg(
            F.count(F.lit(1)).alias("days_with_contributions"),
            F.sum(N).alias("total_contributions"),
            F.avg(N).alias("avg_contributions"),
            F.max(N).alias("max_contributions"),
        )
        .select(
            "username",
            cal.weekday_name(F.col("day_of_week_num")).alias("day_of_week"),
            "day_of_week_num",
            cal.month_name(F.col("month_num")).alias("month_name"),
            "month_num",
            "days_with_contributions",
            "total_contributions",
            "avg_contributions",
            "max_contributions",
        )
    )


def leaderboard(summary: DataFrame) -> DataFrame:
    """Users ranked by total, by unrounded daily average and by recorded days. Runs jobs.

    Takes ``user_summary``, which holds all it needs, one row per user.
    """
    ranked = with_ranks(
        summary.select(
            "username",
            F.col("total_days_with_contributions").alias("days_active"),
            "total_contributions",
            "avg_daily_contributions",
            "max_daily_contributions",
            "last_contribution_date",
        ),
        {
            "rank_by_total": "total_contributions",
            "rank_by_avg": "avg_daily_contributions",
            "rank_by_consistency": "days_active",
        },
    )
    score = F.col("rank_by_total") * 5 + F.col("rank_by_avg") * 3 + F.col("rank_by_consistency") * 2
    return ranked.select(
        "username",
        "days_active",
        "total_contributions",
        rounded_ratio(F.col("total_contributions"), F.col("days_active")).alias("avg_daily_contributions"),
        "max_daily_contributions",
        "last_contribution_date",
        "rank_by_total",
        "rank_by_avg",
        "rank_by_consistency",
        (score.cast("double") / F.lit(10.0)).alias("overall_score"),
    )


def _totals(staged: DataFrame, start: str, bucket) -> DataFrame:
    return staged.groupBy("username", bucket(F.col("date")).alias(start)).agg(
        F.count(F.lit(1)).alias("days_with_contributions"),
        F.sum(N).alias("total_contributions"),
        F.avg(N).alias("avg_daily_contributions"),
        F.max(N).alias("max_daily_contributions"),
        F.min(N).alias("min_daily_contributions"),
    )


def monthly(staged: DataFrame) -> DataFrame:
    """Per user and month, with the share of the month's days that are recorded."""
    start = F.col("month_start")
    return _totals(staged, "month_start", cal.month_start).select(
        "username",
        "month_start",
        cal.month_label(start).alias("month_label"),
        "days_with_contributions",
        "total_contributions",
        "avg_daily_contributions",
        "max_daily_contributions",
        "min_daily_contributions",
        percent(F.col("days_with_contributions"), cal.days_in_month(start)).alias("contribution_rate_percent"),
    )


def weekly(staged: DataFrame) -> DataFrame:
    """Per user and Monday-based week."""
    return _totals(staged, "week_start", cal.week_start)


def recent_activity(staged: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The last 90 days with sums and averages over a user's last 7 and 30 rows.

    Rows, not days: gaps widen the span. The cut comes before the windows, so
    the first rows of the cut have short ones.
    """
    by_day = Window.partitionBy("username").orderBy("date")
    last_7, last_30 = by_day.rowsBetween(-6, 0), by_day.rowsBetween(-29, 0)
    return staged.filter(F.col("date") >= F.date_sub(cal.as_date(as_of), RECENT_DAYS)).select(
        "username",
        "date",
        N,
        F.sum(N).over(last_7).alias("contributions_last_7_days"),
        F.avg(N).over(last_7).alias("avg_contributions_last_7_days"),
        F.sum(N).over(last_30).alias("contributions_last_30_days"),
        F.avg(N).over(last_30).alias("avg_contributions_last_30_days"),
    )


def streaks(staged: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Runs of at least three consecutive days with a positive count.

    Within a run the day minus its row number is constant. The grouping by
    (username, run) reuses the window's partitioning by username.
    """
    by_day = Window.partitionBy("username").orderBy("date")
    runs = (
        staged.filter(F.col(N) > 0)
        .withColumn("run", F.date_sub("date", F.row_number().over(by_day)))
        .groupBy("username", "run")
        .agg(
            F.min("date").alias("streak_start"),
            F.max("date").alias("streak_end"),
            F.count(F.lit(1)).alias("streak_length_days"),
            F.sum(N).alias("streak_total_contributions"),
            F.avg(N).alias("streak_avg_contributions"),
        )
    )
    still_on = F.col("streak_end") >= F.date_sub(cal.as_date(as_of), 1)
    return runs.filter(F.col("streak_length_days") >= MIN_STREAK_DAYS).select(
        "username",
        "streak_start",
        "streak_end",
        "streak_length_days",
        "streak_total_contributions",
        "streak_avg_contributions",
        F.when(still_on, "active").otherwise("ended").alias("streak_status"),
    )


def trends(monthly: DataFrame) -> DataFrame:
    """Monthly totals per user, from ``monthly``, against the user's previous recorded month."""
    months = Window.partitionBy("username").orderBy("month_start")
    last_3 = months.rowsBetween(-2, 0)
    now, before = F.col("monthly_contributions"), F.col("prev_month_contributions")
    return (
        monthly.select("username", "month_start", F.col("total_contributions").alias("monthly_contributions"))
        .select(
            "*",
            F.lag(now).over(months).alias("prev_month_contributions"),
            F.sum(now).over(last_3).alias("sum_3"),
            F.count(now).over(last_3).alias("n_3"),
        )
        .select(
            "username",
            "month_start",
            "monthly_contributions",
            "prev_month_contributions",
            (now - F.coalesce(before, F.lit(0))).alias("month_over_month_change"),
            F.when(before > 0, percent(now - before, before)).alias("month_over_month_pct_change"),
            rounded_ratio(F.col("sum_3"), F.col("n_3")).alias("three_month_avg"),
        )
    )


def user_summary(staged: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    first, last = F.col("first_contribution_date"), F.col("last_contribution_date")
    return (
        staged.groupBy("username")
        .agg(
            F.count(F.lit(1)).alias("total_days_with_contributions"),
            F.min("date").alias("first_contribution_date"),
            F.max("date").alias("last_contribution_date"),
            F.sum(N).alias("total_contributions"),
            F.avg(N).alias("avg_daily_contributions"),
            F.max(N).alias("max_daily_contributions"),
            F.stddev_samp(N).alias("stddev_daily_contributions"),
        )
        .withColumn("total_days_in_range", F.datediff(last, first) + 1)
        .withColumn(
            "overall_activity_rate_percent",
            percent(F.col("total_days_with_contributions"), F.col("total_days_in_range")),
        )
        .withColumn("days_since_last_contribution", F.datediff(cal.as_date(as_of), last))
    )
