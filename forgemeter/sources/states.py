"""The states of all months of a raw table, kept beside its rows.

A month's states are made again only if the files of its directory are others
than when they were made, which a marker per month records; all months behind
are read and written in one job. A build cut short leaves its months without a
marker, so they are made again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.operators.month_states import SCHEMA, month_states
from forgemeter.operators.staging import dedup_contributions
from forgemeter.session import file_sizes, list_names, remove_path, sized_session, touch
from forgemeter.sources.tables import RAW_CONTRIBUTIONS, read_table

STATES = "_month_states"
MARKERS = "_month_markers"


def _signature(spark: SparkSession, folder: str) -> str:
    listed = "\n".join(f"{name} {size}" for name, size in sorted(file_sizes(spark, folder).items()))
    return hashlib.sha256(listed.encode()).hexdigest()[:32]


def months_behind(spark: SparkSession, raw_path: str) -> dict[str, str]:
    """Month to signature of those whose states are missing or of other files."""
    prefix = f"{RAW_CONTRIBUTIONS.layout[0]}="
    months = [name.removeprefix(prefix) for name in list_names(spark, raw_path) if name.startswith(prefix)]
    made = set(list_names(spark, f"{raw_path}/{MARKERS}"))
    now = {month: _signature(spark, f"{raw_path}/{prefix}{month}") for month in months}
    return {month: signature for month, signature in now.items() if f"{month}~{signature}" not in made}


def current_states(spark: SparkSession, raw_path: str, shortest: int) -> DataFrame:
    """The states of all months; those behind are made first. Runs a job if there are any.

    ``shortest`` is the shortest streak, the same for all calls on one table.
    """
    place, behind = f"{raw_path}/{STATES}", months_behind(spark, raw_path)
    if behind:
        for marker in list_names(spark, f"{raw_path}/{MARKERS}"):
            if marker.split("~")[0] in behind:
                remove_path(spark, f"{raw_path}/{MARKERS}/{marker}")
        folders = [f"{raw_path}/{RAW_CONTRIBUTIONS.layout[0]}={month}" for month in behind]
        sized, _ = sized_session(spark, sum(sum(file_sizes(spark, folder).values()) for folder in folders))
        days = read_table(sized, RAW_CONTRIBUTIONS, raw_path).filter(F.col("month").cast("string").isin(list(behind)))
        staged = dedup_contributions(days.select("username", "date", "contribution_count").repartition("username"))
        month_states(staged, shortest).hint("rebalance", "month").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("month").parquet(place)
        for month, signature in behind.items():
            touch(spark, f"{raw_path}/{MARKERS}/{month}~{signature}")
    return spark.read.schema(SCHEMA).parquet(place) if list_names(spark, place) else spark.createDataFrame([], SCHEMA)
