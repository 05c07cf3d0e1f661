"""Exact grouped medians for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from forgemeter.session import settle

# Buckets a doubling of the value has in the first histogram of a group, and
# buckets of each later one: both bound what a group's window looks at.
PER_DOUBLING = 64
BUCKETS = 4_096


def grouped_median(df: DataFrame, key: str, value: str, out: str, buckets: int = BUCKETS) -> DataFrame:
    """``key, out``: the interpolated median of the non-NULL BIGINT ``value``.

    By selection: a round counts a group's values per bucket, a partial
    aggregate, and finds the bucket that holds the middle, or the two that hold
    the two middles; the next round cuts the values of that bucket alone into
    finer ones. The first buckets are logarithmic, so they need no look at the
    values' range; a bucket of no more than ``buckets`` values is cut into single
    values at once. Only one or two small rows per group are written between
    rounds, no copy of the values; no task holds a group. Groups without a value
    are absent. Runs jobs.
    """
    rows = df.filter(F.col(value).isNotNull()).select(
        F.col(key).alias("_key"), F.col(value).cast("bigint").alias("_value")
    )
    counted = rows.groupBy("_key", _logarithmic().alias("_bucket")).agg(*_measures())
    whole = F.sum("_n").over(Window.partitionBy("_key"))
    places = F.array_distinct(F.array(F.call_function("div", whole - 1, F.lit(2)), F.call_function("div", whole, F.lit(2))))
    targets = _holding(counted.withColumn("_places", places).withColumn("_of", F.lit(0).cast("bigint")))
    settled = False
    while not settled:
        seen = Observation()
        wide = F.count_if((F.col("_n") > buckets) & (F.col("_low") < F.col("_high")))
        targets = settle(targets.observe(seen, wide.alias("wide")), "middles")
        settled = not seen.get["wide"]
        targets = _holding(_refined(rows, targets, buckets))
    return targets.groupBy(F.col("_key").alias(key)).agg(
        ((F.min("_low") + F.max("_low")).cast("double") / F.lit(2.0)).alias(out)
    )


def _logarithmic() -> Column:
    """Never falls where the value rises, which is all that a bucket must do."""
    size = F.floor(F.log2(F.abs(F.col("_value").cast("double")) + F.lit(1.0)) * F.lit(float(PER_DOUBLING)))
    return F.when(F.col("_value") < 0, -size).otherwise(size).cast("bigint")


def _measures() -> list[Column]:
    return [F.count(F.lit(1)).alias("_n"), F.min("_value").alias("_low"), F.max("_value").alias("_high")]


def _holding(counted: DataFrame) -> DataFrame:
    """_key, _low, _high, _n, _places: the buckets that hold one of ``_places``, those counted from the bucket's start."""
    earlier = Window.partitionBy("_key", "_of").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    # One or two places a group: plain columns, so that the many buckets without one cost little.
    first, last = F.element_at("_places", 1) - F.col("_before"), F.element_at("_places", -1) - F.col("_before")
    holds = [F.when((place >= 0) & (place < F.col("_n")), place) for place in (first, last)]
    return (
        counted.withColumn("_before", before)
        .withColumn("_places", F.array_distinct(F.array_compact(F.array(*holds))))
        .filter(F.size("_places") > 0)
        .select("_key", "_low", "_high", "_n", "_places")
    )


def _refined(rows: DataFrame, targets: DataFrame, buckets: int) -> DataFrame:
    """Finer buckets of the target buckets' values; each value is in one target at the most.

    Few groups are broadcast, by their written size.
    """
    span = F.col("_high") - F.col("_low") + 1
    step = F.when(F.col("_n") <= buckets, F.lit(1)).otherwise(F.call_function("div", span + (buckets - 1), F.lit(buckets)))
    wide = targets.select(
        F.col("_key").alias("_group"), F.col("_low").alias("_of"), F.col("_high").alias("_to"), step.alias("_step"), "_places"
    )
    inside = (
        rows["_key"].eqNullSafe(wide["_group"])
        & (rows["_value"] >= wide["_of"])
        & (rows["_value"] <= wide["_to"])
    )
    bucket = F.call_function("div", F.col("_value") - F.col("_of"), F.col("_step"))
    return (
        rows.join(wide, inside)
        .groupBy("_key", "_of", "_places", bucket.alias("_bucket"))
        .agg(*_measures())
    )
