"""Mergeable states of a user's month, and the tables that come from merging them.

A state holds what adds up: recorded days, total, sum of squares, extremes, first
and last day, and the runs of consecutive positive days. A run that touches
neither end of its month is closed and kept only if it is long enough for a
streak; one that touches an end is open, whatever its length, and joins the open
run of the month next to it. A month's states depend on that month's rows alone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgemeter.functions import calendar as cal
from forgemeter.functions.rounding import percent

N = "contribution_count"

SCHEMA = (
    "username string, days bigint, total bigint, squares decimal(38,0), low int, high int, first_day date, last_day date, "
    "runs array<struct<first: date, last: date, days: bigint, total: bigint>>, month date"
)


def month_states(staged: DataFrame, shortest: int) -> DataFrame:
    """One state per user and month from one row per user and day.

    Rows partitioned by ``username`` need no shuffle. A month of a user has at
    most 31 rows and 16 runs.
    """
    by_day = Window.partitionBy("username", "month", "_positive").orderBy("date")
    day_runs = (
        staged.select("username", cal.month_start(F.col("date")).alias("month"), "date", F.col(N).alias("_n"))
        .withColumn("_positive", F.col("_n") > 0)
        # Within a run the day minus its row number is constant; days without a count are in no run.
        .withColumn("_run", F.when(F.col("_positive"), F.date_sub("date", F.row_number().over(by_day))))
    )
    parts = day_runs.groupBy("username", "month", "_positive", "_run").agg(
        F.count(F.lit(1)).alias("_days"),
        F.sum("_n").cast("bigint").alias("_total"),
        F.sum(F.col("_n").cast("decimal(20,0)") * F.col("_n")).cast("decimal(38,0)").alias("_squares"),
        F.min("_n").alias("_low"),
        F.max("_n").alias("_high"),
        F.min("date").alias("_first"),
        F.max("date").alias("_last"),
    )
    open_run = (F.col("_first") == F.col("month")) | (F.col("_last") == F.last_day("month"))
    kept = F.col("_positive") & (open_run | (F.col("_days") >= shortest))
    run = F.struct(
        F.col("_first").alias("first"), F.col("_last").alias("last"), F.col("_days").alias("days"), F.col("_total").alias("total")
    )
    return parts.groupBy("username", "month").agg(
        F.sum("_days").alias("days"),
        F.sum("_total").alias("total"),
        F.sum("_squares").cast("decimal(38,0)").alias("squares"),
        F.min("_low").alias("low"),
        F.max("_high").alias("high"),
        F.min("_first").alias("first_day"),
        F.max("_last").alias("last_day"),
        F.array_sort(F.collect_list(F.when(kept, run))).alias("runs"),
    ).select("username", "days", "total", "squares", "low", "high", "first_day", "last_day", "runs", "month")


def _ratio(above: str, below: str) -> Column:
    return F.col(above).cast("double") / F.col(below).cast("double")


def monthly(states: DataFrame) -> DataFrame:
    """The monthly table: a state is a row of it, no shuffle."""
    start = F.col("month")
    return states.select(
        "username",
        start.alias("month_start"),
        cal.month_label(start).alias("month_label"),
        F.col("days").alias("days_with_contributions"),
        F.col("total").alias("total_contributions"),
        _ratio("total", "days").alias("avg_daily_contributions"),
        F.col("high").alias("max_daily_contributions"),
        F.col("low").alias("min_daily_contributions"),
        percent(F.col("days"), cal.days_in_month(start)).alias("contribution_rate_percent"),
    )


def _deviation() -> Column:
    """The sample deviation from exact sums; NULL for a single day."""
    # There are fewer than 10^7 calendar days and a count has ten digits, so all products fit 38.
    days, total = F.col("days").cast("decimal(7,0)"), F.col("total").cast("decimal(18,0)")
    above = days * F.col("squares").cast("decimal(30,0)") - total * total
    below = F.col("days").cast("double") * (F.col("days") - 1).cast("double")
    return F.when(F.col("days") > 1, F.sqrt(above.cast("double") / below))


def user_summary(states: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The summary per user, from its months' states."""
    first, last = F.col("first_contribution_date"), F.col("last_contribution_date")
    return (
        states.groupBy("username")
        .agg(
            F.sum("days").alias("days"),
            F.min("first_day").alias("first_contribution_date"),
            F.max("last_day").alias("last_contribution_date"),
            F.sum("total").alias("total"),
            F.sum("squares").alias("squares"),
            F.max("high").alias("max_daily_contributions"),
        )
        .select(
            "username",
            F.col("days").alias("total_days_with_contributions"),
            "first_contribution_date",
            "last_contribution_date",
            F.col("total").alias("total_contributions"),
            _ratio("total", "days").alias("avg_daily_contributions"),
            "max_daily_contributions",
            _deviation().alias("stddev_daily_contributions"),
            (F.datediff(last, first) + 1).alias("total_days_in_range"),
            percent(F.col("days"), F.datediff(last, first) + 1).alias("overall_activity_rate_percent"),
            F.datediff(cal.as_date(as_of), last).alias("days_since_last_contribution"),
        )
    )


def streaks(states: DataFrame, shortest: int, as_of: dt.date | None = None) -> DataFrame:
    """Runs of at least ``shortest`` days: a run that begins the day after another one ended goes on with it.

    The window by user sees runs, a few per month, instead of days.
    """
    by_start = Window.partitionBy("username").orderBy("first")
    goes_on = F.col("first") == F.date_add(F.lag("last").over(by_start), 1)
    joined = (
        states.select("username", F.explode("runs").alias("run"))
        .select("username", "run.*")
        .withColumn("_new", F.when(goes_on, 0).otherwise(1))
        .withColumn("_streak", F.sum("_new").over(by_start))
        .groupBy("username", "_streak")
        .agg(F.min("first").alias("streak_start"), F.max("last").alias("streak_end"), F.sum("days").alias("days"), F.sum("total").alias("total"))
    )
    still_on = F.col("streak_end") >= F.date_sub(cal.as_date(as_of), 1)
    return joined.filter(F.col("days") >= shortest).select(
        "username",
        "streak_start",
        "streak_end",
        F.col("days").alias("streak_length_days"),
        F.col("total").alias("streak_total_contributions"),
        _ratio("total", "days").alias("streak_avg_contributions"),
        F.when(still_on, "active").otherwise("ended").alias("streak_status"),
    )
