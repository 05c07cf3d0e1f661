"""The order in which each table is shown.

Tables are built and stored unsorted: a stored table promises no row order, and
a global sort of every row is a shuffle that buys nothing. Sort on display.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# "-" marks a descending column.
SHOW_ORDER = {
    "contrib_patterns": ("username", "day_of_week_num", "month_num"),
    "contrib_leaderboard": ("overall_score", "-total_contributions"),
    "contrib_monthly": ("username", "-month_start"),
    "contrib_recent": ("username", "-date"),
    "contrib_streaks": ("username", "-streak_start"),
    "contrib_trends": ("username", "-month_start"),
    "contrib_user_summary": ("-total_contributions",),
    "contrib_weekly": ("username", "-week_start"),
    "pulls_patterns": ("user_login", "day_of_week_num", "month_num"),
    "pulls_leaderboard": ("overall_score", "-total_pulls"),
    "pulls_monthly": ("-month_start",),
    "pulls_recent": ("user_login", "-created_at"),
    "pulls_repo_summary": ("-total_pulls",),
    "pulls_time_to_merge": ("-created_at",),
    "pulls_trends": ("-month_start",),
    "pulls_user_summary": ("-total_pulls",),
    "pulls_weekly": ("-week_start",),
}


def show_order(name: str, df: DataFrame) -> DataFrame:
    """NULL sorts as the largest value: last going up, first going down."""
    return df.orderBy(
        *[
            F.col(c[1:]).desc_nulls_first() if c.startswith("-") else F.col(c).asc_nulls_last()
            for c in SHOW_ORDER[name]
        ]
    )
