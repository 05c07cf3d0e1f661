"""Code-review tables.

All aggregated tables are sums over *facts*: rows of (user_login, repo_name,
day) with additive measures. ``review_facts`` makes one fact per review, with no
shuffle; ``daily_rollup`` adds them up per user, repository and day. Either can
be passed to every function that takes ``facts``, so a full build scans the
reviews once and derives five tables from the stored rollup, and two more from
those.

Functions return unsorted DataFrames (``presentation.show_order`` sorts them).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgemeter.functions import calendar as cal
from forgemeter.functions import reviews as rv
from forgemeter.functions.rounding import percent, rounded_ratio
from forgemeter.operators.blocks import BLOCK_ROWS, neighbour_window
from forgemeter.operators.ordering import with_ranks
from forgemeter.operators.quantiles import grouped_median

RECENT_DAYS = 90
FRAME_ROWS = 30

FACT_KEYS = ["user_login", "repo_name", "day"]
FACT_SUMS = ["pulls", "merged", "dropped", "still_open", "timed", "merge_us"]


def review_facts(staged: DataFrame) -> DataFrame:
    """One fact per review."""

    def flag(condition: Column) -> Column:
        return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    micros = rv.merge_micros()
    return staged.select(
        "user_login",
        "repo_name",
        F.to_date("created_at").alias("day"),
        F.lit(1).cast("bigint").alias("pulls"),
        flag(rv.is_merged()).alias("merged"),
        flag(rv.is_dropped()).alias("dropped"),
        flag(rv.is_open()).alias("still_open"),
        flag(micros.isNotNull()).alias("timed"),
        # DECIMAL: the microseconds of many reviews overflow a BIGINT sum.
        micros.cast("decimal(18,0)").alias("merge_us"),
        F.col("created_at").alias("first_at"),
        F.col("created_at").alias("last_at"),
    )


def _sums(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def daily_rollup(facts: DataFrame) -> DataFrame:
    """Facts added up per user, repository and day; facts themselves."""
    rolled = facts.groupBy(*FACT_KEYS).agg(
        *_sums(*FACT_SUMS), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at")
    )
    return rolled.withColumn("merge_us", F.col("merge_us").cast("decimal(28,0)"))


def _merge_rate() -> Column:
    """Merged in percent of closed, NULL when nothing is closed."""
    return percent(F.col("merged"), F.col("merged") + F.col("dropped"))


def _average_days() -> Column:
    # As 38-digit whole numbers: sums of microseconds times 200 exceed a BIGINT.
    total = F.col("merge_us").cast("decimal(33,0)")
    whole = F.col("timed").cast("decimal(19,0)") * F.lit(rv.MICROS_PER_DAY).cast("decimal(12,0)")
    return rounded_ratio(total, whole)


def activity_patterns(facts: DataFrame) -> DataFrame:
    """Per user, weekday and month of year (all years together)."""
    return (
        facts.groupBy(
            "user_login",
            cal.weekday_number(F.col("day")).alias("day_of_week_num"),
            F.month("day").alias("month_num"),
        )
        .agg(*_sums("pulls", "merged", "still_open"))
        .select(
            "user_login",
            cal.weekday_name(F.col("day_of_week_num")).alias("day_of_week"),
            "day_of_week_num",
            cal.month_name(F.col("month_num")).alias("month_name"),
            "month_num",
            F.col("pulls").alias("total_pulls"),
            F.col("merged").alias("merged_pulls"),
            F.col("still_open").alias("open_pulls"),
        )
    )


def leaderboard(summary: DataFrame) -> DataFrame:
    """Users ranked by reviews, merges, merge rate (two digits) and repositories. Runs jobs.

    Takes ``user_summary``, which holds all it needs, one row per user.
    """
    ranked = with_ranks(
        summary.select(
            "user_login",
            "total_pulls",
            "merged_pulls",
            "open_pulls",
            "repos_contributed_to",
            "merge_rate_percent",
            "avg_days_to_merge",
        ),
        {
            "rank_by_total": "total_pulls",
            "rank_by_merged": "merged_pulls",
            "rank_by_merge_rate": "merge_rate_percent",
            "rank_by_repos": "repos_contributed_to",
        },
    )
    score = (
        F.col("rank_by_total") * 4
        + F.col("rank_by_merged") * 3
        + F.col("rank_by_merge_rate") * 2
        + F.col("rank_by_repos")
    )
    return ranked.select("*", (score.cast("double") / F.lit(10.0)).alias("overall_score"))


def _by_period(facts: DataFrame, start: str, bucket) -> DataFrame:
    return facts.groupBy(bucket(F.col("day")).alias(start)).agg(
        *_sums(*FACT_SUMS),
        F.count_distinct("user_login").alias("unique_contributors"),
        F.count_distinct("repo_name").alias("unique_repos"),
    )


def _period_columns() -> list[Column]:
    return [
        F.col("pulls").alias("total_pulls"),
        F.col("merged").alias("merged_pulls"),
        F.col("dropped").alias("closed_not_merged_pulls"),
        F.col("still_open").alias("open_pulls"),
        _merge_rate().alias("merge_rate_percent"),
        F.col("unique_contributors"),
        F.col("unique_repos"),
        _average_days().alias("avg_days_to_merge"),
    ]


def monthly(facts: DataFrame) -> DataFrame:
    """Per month of creation."""
    return _by_period(facts, "month_start", cal.month_start).select(
        "month_start", cal.month_label(F.col("month_start")).alias("month_label"), *_period_columns()
    )


def weekly(facts: DataFrame) -> DataFrame:
    """Per Monday-based week of creation."""
    return _by_period(facts, "week_start", cal.week_start).select("week_start", *_period_columns())


def user_summary(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy("user_login")
        .agg(
            *_sums(*FACT_SUMS),
            F.min("first_at").alias("first_pr_date"),
            F.max("last_at").alias("last_pr_date"),
            F.count_distinct("repo_name").alias("repos_contributed_to"),
        )
        .select(
            "user_login",
            F.col("pulls").alias("total_pulls"),
            F.col("merged").alias("merged_pulls"),
            F.col("dropped").alias("closed_not_merged_pulls"),
            F.col("still_open").alias("open_pulls"),
            _merge_rate().alias("merge_rate_percent"),
            "first_pr_date",
            "last_pr_date",
            "repos_contributed_to",
            _average_days().alias("avg_days_to_merge"),
        )
    )


def repo_summary(facts: DataFrame, staged: DataFrame) -> DataFrame:
    """Per repository, with the exact median merge time (from the single reviews). Runs jobs."""
    per_repo = (
        facts.groupBy("repo_name")
        .agg(
            *_sums(*FACT_SUMS),
            F.min("first_at").alias("first_pr_date"),
            F.max("last_at").alias("last_pr_date"),
            F.count_distinct("user_login").alias("unique_contributors"),
        )
        .select(
            "repo_name",
            F.col("pulls").alias("total_pulls"),
            F.col("merged").alias("merged_pulls"),
            F.col("dropped").alias("closed_not_merged_pulls"),
            F.col("still_open").alias("open_pulls"),
            _merge_rate().alias("merge_rate_percent"),
            "unique_contributors",
            "first_pr_date",
            "last_pr_date",
            _average_days().alias("avg_days_to_merge"),
        )
    )
    durations = staged.select(F.col("repo_name"), rv.merge_micros().alias("micros"))
    medians = grouped_median(durations, "repo_name", "micros", "median_micros").select(
        F.col("repo_name").alias("median_of"), rv.in_days(F.col("median_micros")).alias("median_days_to_merge")
    )
    return per_repo.join(medians, F.col("repo_name").eqNullSafe(F.col("median_of")), "left").drop("median_of")


def recent_reviews(staged: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The reviews created in the last 90 days."""
    first = F.date_sub(cal.as_date(as_of), RECENT_DAYS).cast("timestamp_ntz")
    return staged.filter(F.col("created_at") >= first).select(
        "user_login",
        "repo_name",
        "pr_id",
        "state",
        "created_at",
        "merged_at",
        rv.in_days(rv.merge_micros()).alias("days_to_merge"),
    )


def recent_activity(
    staged: DataFrame, as_of: dt.date | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The last 90 days with counts over an author's last 30 reviews. Runs a job.

    Reviews, not days, whatever the names say; the cut comes before the window.
    Reviews created at the same moment are taken in order of ``pr_id``.
    """
    merged = F.when(rv.is_merged(), F.lit(1))

    def rolling(window):
        frame = window.rowsBetween(-(FRAME_ROWS - 1), 0)
        return {
            "pulls_last_30_days": F.count(F.lit(1)).over(frame),
            "merged_last_30_days": F.count(merged).over(frame),
        }

    recent = recent_reviews(staged, as_of)
    order = [F.col("created_at").asc_nulls_last(), F.col("pr_id").asc()]
    return neighbour_window(recent, ["user_login"], order, rolling, before=FRAME_ROWS - 1, block_rows=block_rows)


def time_to_merge(staged: DataFrame) -> DataFrame:
    """Every merged or closed review with its merge time; row by row, no shuffle."""
    micros = rv.merge_micros()
    return staged.filter(F.col("merged_at").isNotNull() | (F.col("state") == "closed")).select(
        "user_login",
        "repo_name",
        "pr_id",
        "state",
        "created_at",
        "merged_at",
        rv.in_days(micros).alias("days_to_merge"),
        rv.in_hours(micros).alias("hours_to_merge"),
        F.when(F.col("merged_at").isNotNull(), "merged")
        .when(F.col("state") == "closed", "closed_not_merged")
        .otherwise("open")
        .alias("pr_status"),
    )


def trends(monthly: DataFrame) -> DataFrame:
    """Monthly counts, from ``monthly``, against the previous month that has any.

    The window has no partition: it runs over one row per calendar month.
    """
    months = Window.orderBy(F.col("month_start").asc_nulls_last())
    last_3 = months.rowsBetween(-2, 0)
    pulls, merged = F.col("monthly_pulls"), F.col("monthly_merged")
    before = F.col("prev_month_pulls")
    return (
        monthly.select(
            "month_start",
            "month_label",
            F.col("total_pulls").alias("monthly_pulls"),
            F.col("merged_pulls").alias("monthly_merged"),
        )
        .select(
            "*",
            F.lag(pulls).over(months).alias("prev_month_pulls"),
            F.lag(merged).over(months).alias("prev_month_merged"),
            F.sum(pulls).over(last_3).alias("pulls_3"),
            F.sum(merged).over(last_3).alias("merged_3"),
            F.count(F.lit(1)).over(last_3).alias("n_3"),
        )
        .select(
            "month_start",
            "month_label",
            "monthly_pulls",
            "monthly_merged",
            "prev_month_pulls",
            "prev_month_merged",
            (pulls - F.coalesce(before, F.lit(0))).alias("month_over_month_change"),
            (merged - F.coalesce(F.col("prev_month_merged"), F.lit(0))).alias("merged_month_over_month_change"),
            F.when(before > 0, percent(pulls - before, before)).alias("month_over_month_pct_change"),
            rounded_ratio(F.col("pulls_3"), F.col("n_3")).alias("three_month_avg_pulls"),
            rounded_ratio(F.col("merged_3"), F.col("n_3")).alias("three_month_avg_merged"),
        )
    )
