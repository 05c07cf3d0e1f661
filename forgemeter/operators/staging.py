"""Staging tables: one row per user and day; reviews with a surrogate key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemeter.operators.ordering import with_row_number


def dedup_contributions(raw: DataFrame, arrival: str | None = None) -> DataFrame:
    """One row per (username, date), ``row_num`` always 1.

    The first row by ``arrival`` is kept, or, where rows carry no arrival order,
    the largest count. An aggregate rather than a window: copies of one day
    collapse before the shuffle, so a key with very many copies is no hot spot.
    """
    if arrival:
        kept = F.min_by("contribution_count", arrival)
    else:
        kept = F.max("contribution_count")
    return raw.groupBy("username", "date").agg(kept.alias("contribution_count")).withColumn(
        "row_num", F.lit(1).cast("bigint")
    )


def key_pulls(raw: DataFrame) -> DataFrame:
    """Add ``primary_key``: 1.. in order of creation, unknown dates last. Runs a job."""
    columns = ["repo_name", "pr_id", "state", "created_at", "merged_at", "user_login"]
    order = [F.col("created_at").asc_nulls_last(), F.col("pr_id").asc()]
    return with_row_number(raw.select(*columns), order, "primary_key")
