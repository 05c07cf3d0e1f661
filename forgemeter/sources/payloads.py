"""Landed HTTP answers and their JSON shapes.

A landed file holds one JSON object per answer: the answer's text in ``body``
plus what was asked for and when: ``fetched_at`` is the time of the fetch run
that asked, the same for all its ranges or pages; it orders runs that are loaded
together. Fetching is outside this package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LANDED_PAGES = "repo_name string, seq bigint, body string, fetched_at timestamp"
LANDED_CALENDARS = "username string, range_seq bigint, http_status int, body string, fetched_at timestamp"

PULL_PAGE = (
    "array<struct<id: bigint, state: string, created_at: string, merged_at: string, user: struct<login: string>>>"
)

# The count stays a VARIANT: whether "3.7" came as text or as a number decides
# how it is converted.
CALENDAR = (
    "data struct<user: struct<contributionsCollection: struct<contributionCalendar: struct<"
    "weeks: array<struct<contributionDays: array<struct<date: string, contributionCount: variant>>>>>>>>, "
    "errors array<string>, _corrupt_record string"
)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDED_PAGES).json(path)


def read_calendars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDED_CALENDARS).json(path)
