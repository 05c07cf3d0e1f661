"""Incremental loading: each run picks up the files landed since the last one.

The checkpoint remembers which files were read; ``availableNow`` works through
the backlog and stops, which is the daily run. A batch that is repeated after a
failure loads the same rows under the same keys and so changes nothing. Failed
answers and rows that break the table's declaration are kept aside and stop
nobody else's; with ``strict`` they would also fail the batch, again at each
restart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from forgemeter.plans.runs import load_calendars, load_pulls
from forgemeter.sources.payloads import LANDED_CALENDARS, LANDED_PAGES


def _drain(stream: DataFrame, load, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(lambda batch, _: load(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain_pulls(
    spark: SparkSession, landing: str, raw_path: str, checkpoint: str, strict: bool = False
) -> StreamingQuery:
    stream = spark.readStream.schema(LANDED_PAGES).json(landing)
    return _drain(stream, lambda batch: load_pulls(batch, raw_path, strict), checkpoint)


def drain_calendars(
    spark: SparkSession, landing: str, raw_path: str, checkpoint: str, restate: bool = False, strict: bool = False
) -> StreamingQuery:
    stream = spark.readStream.schema(LANDED_CALENDARS).json(landing)
    return _drain(stream, lambda batch: load_calendars(batch, raw_path, restate, strict), checkpoint)
