"""Activity and review rows derived from the TPC-H-style tables.

Two of each kind: order lines give daily counts over many months, events give
dense days; orders give reviews over many months, events give reviews with
microsecond timestamps.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.operators.blocks import BLOCK_ROWS, neighbour_window

LONG_AS_OF = dt.date(2001, 11, 4)
DENSE_AS_OF = dt.date(2024, 1, 31)
ORDERS_AS_OF = dt.date(2001, 8, 1)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _user(key: str):
    return F.concat(F.lit("user_"), F.col(key).cast("string"))


def long_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """username, date, contribution_count: lines not returned as 'N' per supplier and ship day."""
    return (
        _read(spark, sf_dir, "lineitem")
        .select(_user("l_suppkey").alias("username"), F.to_date("l_shipdate").alias("date"), "l_returnflag")
        .groupBy("username", "date")
        .agg(F.count_if(F.col("l_returnflag") != "N").cast("int").alias("contribution_count"))
    )


def duplicated_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several raw rows per user and day, one per return flag, with their order of arrival."""
    return (
        _read(spark, sf_dir, "lineitem")
        .select(_user("l_suppkey").alias("username"), F.to_date("l_shipdate").alias("date"), "l_returnflag")
        .groupBy("username", "date", "l_returnflag")
        .agg(F.count(F.lit(1)).cast("int").alias("contribution_count"))
        .select("username", "date", "contribution_count", F.ascii("l_returnflag").alias("arrival"))
    )


def dense_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events other than errors per user and day of one month."""
    return (
        _read(spark, sf_dir, "events")
        .groupBy(_user("user_id").alias("username"), F.to_date("ts").alias("date"))
        .agg(F.count_if(F.col("event_type") != "error").cast("int").alias("contribution_count"))
    )


def order_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as reviews, merged with the first line shipped after the order date."""
    # One row per order and ship day, however many lines an order has.
    shipped = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate").distinct()
    order = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    on_time = (
        (F.col("l_orderkey") == F.col("o_orderkey"))
        & (F.col("l_shipdate") > F.col("o_orderdate"))
        & (F.col("o_orderstatus") == "F")
    )
    return (
        _read(spark, sf_dir, "orders")
        .select(*order)
        .join(shipped, on_time, "left")
        .groupBy(*order)
        .agg(F.min("l_shipdate").alias("merged_at"))
        .join(
            _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        .select(
            F.concat_ws("/", "c_mktsegment", "o_orderpriority").alias("repo_name"),
            F.col("o_orderkey").alias("pr_id"),
            F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"),
            F.col("o_orderdate").alias("created_at"),
            "merged_at",
            F.col("c_name").alias("user_login"),
        )
    )


def event_pulls(spark: SparkSession, sf_dir: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Events as reviews, merged at the same user's next event."""
    events = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    following = neighbour_window(
        events,
        ["user_id"],
        [F.col("ts").asc(), F.col("event_id").asc()],
        lambda window: {"next_ts": F.lead("ts").over(window)},
        after=1,
        block_rows=block_rows,
    )
    number = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    return following.select(
        F.concat(F.lit("org/repo_"), (number % 10).cast("string")).alias("repo_name"),
        F.col("event_id").alias("pr_id"),
        F.when(F.col("event_type") == "view", "open").otherwise("closed").alias("state"),
        F.col("ts").alias("created_at"),
        F.when(F.col("event_type").isin("purchase", "click", "signup"), F.col("next_ts")).alias("merged_at"),
        _user("user_id").alias("user_login"),
    )


# Landed answers -------------------------------------------------------------


def landed_pages(pulls: DataFrame, ids_per_page: int = 100) -> DataFrame:
    """Reviews as landed pages of at most ``ids_per_page`` per repository.

    Authors are left out where the id ends in 7, as for a deleted account.
    """
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    deleted = F.col("pr_id") % 10 == 7
    pull = F.struct(
        F.col("pr_id").alias("id"),
        "state",
        F.date_format("created_at", stamp).alias("created_at"),
        F.date_format("merged_at", stamp).alias("merged_at"),
        F.when(~deleted, F.struct(F.col("user_login").alias("login"))).alias("user"),
    )
    return (
        pulls.groupBy("repo_name", F.call_function("div", F.col("pr_id"), F.lit(ids_per_page)).alias("seq"))
        .agg(F.to_json(F.collect_list(pull)).alias("body"))
        .select("repo_name", "seq", "body")
    )


def landed_calendars(days: DataFrame, count_json=None) -> DataFrame:
    """Daily counts as landed calendars: one answer per user and year, days grouped in weeks.

    ``count_json`` is the text of a day's count in the answer.
    """
    count_json = F.col("contribution_count").cast("string") if count_json is None else count_json
    day = F.concat(
        F.lit('{"date":"'), F.col("date").cast("string"), F.lit('","contributionCount":'), count_json, F.lit("}")
    )
    week = F.concat(F.lit('{"contributionDays":['), F.array_join(F.collect_list("day"), ","), F.lit("]}"))
    body = F.concat(
        F.lit('{"data":{"user":{"contributionsCollection":{"contributionCalendar":{"weeks":['),
        F.array_join(F.collect_list("week"), ","),
        F.lit("]}}}}}"),
    )
    # At most 7 days a week and 54 weeks a year.
    return (
        days.select(
            "username",
            F.year("date").cast("bigint").alias("range_seq"),
            F.trunc("date", "week").alias("monday"),
            day.alias("day"),
        )
        .groupBy("username", "range_seq", "monday")
        .agg(week.alias("week"))
        .groupBy("username", "range_seq")
        .agg(body.alias("body"))
        .select("username", "range_seq", F.lit(200).alias("http_status"), "body")
    )


def troubled_calendars(calendars: DataFrame) -> DataFrame:
    """The same answers with every kind of failure, chosen by user number and year.

    Users whose number ends in 3 fail throughout.
    """
    number = F.regexp_extract("username", r"(\d+)", 1).cast("bigint")
    kind = F.when(number % 10 == 3, F.lit(0)).otherwise((number + F.col("range_seq")) % 7)
    return calendars.select(
        "username",
        "range_seq",
        F.when(kind == 0, 502).otherwise(200).alias("http_status"),
        F.when(kind == 1, F.expr("substr(body, 1, length(body) - 3)"))
        .when(kind == 2, F.lit('{"data":{"user":null},"errors":[{"type":"NOT_FOUND","message":"no such login"}]}'))
        .when(kind == 3, F.lit('{"data":{"user":null}}'))
        .otherwise(F.col("body"))
        .alias("body"),
    )
