"""Which days of a user are stored, as one bitmap per user and year.

A year of a user is 46 bytes instead of up to 366 rows, so what is known is
told, counted and compared without a look at the rows themselves. Bit 0 is the
first of January; bits of a byte count from the lowest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YEAR_BYTES = 46
YEAR_DAYS = 366

SCHEMA = "username string, bits binary, year int"


def is_bitmaps(stored: DataFrame) -> bool:
    return "bits" in stored.columns


def _trimmed(bits: Column) -> Column:
    # Spark's bitmaps have 4,096 bytes; those behind a year's are zero.
    return F.substring(bits, 1, YEAR_BYTES).alias("bits")


def day_bitmaps(days: DataFrame) -> DataFrame:
    """username, bits, year from rows with a ``username`` and a ``date``; repeated days set a bit once.

    Copies collapse before the shuffle, and so do a user's days.
    """
    place = (F.dayofyear("date") - 1).cast("bigint")
    return days.groupBy("username", F.year("date").alias("year")).agg(
        _trimmed(F.bitmap_construct_agg(place))
    ).select("username", "bits", "year")


def merged(*bitmaps: DataFrame) -> DataFrame:
    """The days of any of the given bitmaps, one row per user and year."""
    together = bitmaps[0]
    for more in bitmaps[1:]:
        together = together.unionByName(more)
    return together.groupBy("username", "year").agg(_trimmed(F.bitmap_or_agg("bits"))).select("username", "bits", "year")


def has_day(bits: Column, place: Column) -> Column:
    """Whether the bit at ``place`` (from 0) is set."""
    byte = F.conv(F.hex(F.substring(bits, F.call_function("div", place, F.lit(8)).cast("int") + 1, F.lit(1))), 16, 10)
    return F.call_function("shiftright", byte.cast("int"), (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def dates(bitmaps: DataFrame) -> DataFrame:
    """username, date of every set bit."""
    places = F.filter(F.sequence(F.lit(0), F.lit(YEAR_DAYS - 1)), lambda place: has_day(F.col("bits"), place))
    return bitmaps.select("username", "year", F.explode(places).alias("place")).select(
        "username", F.date_add(F.make_date("year", F.lit(1), F.lit(1)), F.col("place")).alias("date")
    )


def counts(bitmaps: DataFrame) -> DataFrame:
    """username, known_days."""
    return bitmaps.groupBy("username").agg(F.sum(F.bitmap_count("bits")).alias("known_days"))


def without_known(days: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows whose day is not in their user's bitmap.

    The join is by user and year, so the bitmap side is a row where the stored
    table would be hundreds; Spark broadcasts the smaller side by its size.
    """
    known = bitmaps.select(F.col("username").alias("_user"), F.col("year").alias("_year"), F.col("bits").alias("_bits"))
    same = (F.col("username") == F.col("_user")) & (F.year("date") == F.col("_year"))
    met = F.coalesce(has_day(F.col("_bits"), F.dayofyear("date") - 1), F.lit(False))
    return days.join(known, same, "left").filter(~met).select(*days.columns)
