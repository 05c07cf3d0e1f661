"""The bitmaps of stored days that a raw table keeps beside its rows.

They are in a folder of the table that readers of the rows skip, by year. A
marker stands in it from before a load swaps rows in until the bitmaps have
followed, so whatever was cut short between is seen and the bitmaps are made
again from the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.operators.day_bitmaps import SCHEMA, day_bitmaps, merged
from forgemeter.operators.upsert import PENDING
from forgemeter.session import path_exists, remove_path, scratch_scope, settle, sized_session, stored_bytes, touch
from forgemeter.sources.tables import RAW_CONTRIBUTIONS, read_table

KNOWN = "_known"
STALE = "_stale_known"


def mark_stale(spark: SparkSession, raw_path: str) -> None:
    touch(spark, f"{raw_path}/{STALE}")


def mark_if_interrupted(spark: SparkSession, raw_path: str) -> None:
    """Rows of a load cut short are about to be swapped in."""
    if path_exists(spark, f"{raw_path}/{PENDING}"):
        mark_stale(spark, raw_path)


def known_days(spark: SparkSession, raw_path: str) -> DataFrame:
    """username, bits, year. Runs a job only if the bitmaps are missing or behind the rows."""
    place = f"{raw_path}/{KNOWN}"
    if not path_exists(spark, place) or path_exists(spark, f"{raw_path}/{STALE}"):
        sized, _ = sized_session(spark, stored_bytes(spark, raw_path))
        made = day_bitmaps(read_table(sized, RAW_CONTRIBUTIONS, raw_path).select("username", "date"))
        remove_path(spark, place)
        made.hint("rebalance", "year").write.partitionBy("year").parquet(place)
        remove_path(spark, f"{raw_path}/{STALE}")
    return spark.read.schema(SCHEMA).parquet(place)


def add_known(days: DataFrame, raw_path: str) -> None:
    """After ``days`` are stored: their bits join those of the years they are in; other years are not touched."""
    spark, place = days.sparkSession, f"{raw_path}/{KNOWN}"
    with scratch_scope(spark):
        fresh = settle(day_bitmaps(days), "fresh-bitmaps")
        years = [row[0] for row in fresh.select("year").distinct().collect()]
        before = spark.read.schema(SCHEMA).parquet(place).filter(F.col("year").isin(years))
        settle(merged(before, fresh), "bitmaps").hint("rebalance", "year").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("year").parquet(place)
    remove_path(spark, f"{raw_path}/{STALE}")
