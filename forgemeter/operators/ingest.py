"""From landed answers to typed rows, and what to fetch next."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemeter.functions.calendar import as_date
from forgemeter.operators import day_bitmaps
from forgemeter.sources.payloads import CALENDAR, PULL_PAGE
from forgemeter.sources.tables import RAW_CONTRIBUTIONS

# Rows of one answer are numbered in the low bits of the arrival number.
ROW_BITS = 32

# Before any time; its negative is a BIGINT too.
FIRST_FETCH = -(2**63 - 1)


def _arrival(seq: str, row: str) -> Column:
    return (F.shiftleft(F.col(seq).cast("bigint"), ROW_BITS) + F.col(row)).alias("arrival")


def _fetch(landed: DataFrame) -> Column:
    """The fetch run as a number that grows with time; answers that do not tell come first."""
    known = F.unix_micros("fetched_at") if "fetched_at" in landed.columns else F.lit(None)
    return F.coalesce(known.cast("bigint"), F.lit(FIRST_FETCH).cast("bigint")).alias("fetch")


def _with_parsed(df: DataFrame, schema: str, out: str) -> DataFrame:
    """Adds ``body`` parsed, parsing each body once.

    As a plain column the expression would be copied into every later filter and
    projection that uses it, and every copy would parse again. Filters are not
    moved below an explode of what they look at.
    """
    return df.select("*", F.explode(F.array(F.from_json("body", schema))).alias(out))


# Pulls ----------------------------------------------------------------------


def _is_page() -> Column:
    return F.coalesce(F.ltrim("body").startswith("[") & F.col("pulls").isNotNull(), F.lit(False))


def triage_pages(pages: DataFrame) -> DataFrame:
    """The pages with their ``pulls`` parsed and a ``status``: ``ok``, or ``not_a_page`` for any other answer."""
    return _with_parsed(pages, PULL_PAGE, "pulls").withColumn(
        "status", F.when(_is_page(), "ok").otherwise("not_a_page")
    )


def parse_pull_pages(pages: DataFrame) -> DataFrame:
    """One row per review of the landed pages, as ``flatten_pages`` gives them."""
    return flatten_pages(triage_pages(pages))


def flatten_pages(triaged: DataFrame) -> DataFrame:
    """One row per review of the good pages, plus ``fetch`` and ``arrival`` within it.

    Missing fields become NULL, a missing author too. Timestamps stay text until
    ``check_batch`` casts them.
    """
    return (
        triaged.filter(F.col("status") == "ok")
        .select("repo_name", "seq", _fetch(triaged), F.posexplode("pulls").alias("row", "pull"))
        .select(
            "repo_name",
            F.col("pull.id").alias("pr_id"),
            F.col("pull.state").alias("state"),
            F.col("pull.created_at").alias("created_at"),
            F.col("pull.merged_at").alias("merged_at"),
            F.col("pull.user.login").alias("user_login"),
            "fetch",
            _arrival("seq", "row"),
        )
    )


def bad_pull_pages(pages: DataFrame) -> DataFrame:
    """Landed answers that are not a JSON array, such as an error object."""
    return triage_pages(pages).filter(F.col("status") != "ok").drop("pulls", "status")


# Calendars ------------------------------------------------------------------


def _user_missing() -> Column:
    """No user, or one without any field; a user without a calendar just has no days."""
    without = F.col("answer.data.user.contributionsCollection").isNull()
    bare = F.get_json_object("body", "$.data.user") == "{}"
    return F.col("answer.data.user").isNull() | (without & F.coalesce(bare, F.lit(True)))


def triage_calendars(calendars: DataFrame) -> DataFrame:
    """Adds ``answer`` (the parsed body) and ``status``.

    Status is ``ok`` or the first failure: fetch_failed, bad_json, api_errors,
    user_missing.
    """
    answer = F.col("answer")
    return _with_parsed(calendars, CALENDAR, "answer").withColumn(
        "status",
        F.when(F.col("http_status").isNull() | (F.col("http_status") >= 400) | F.col("body").isNull(), "fetch_failed")
        .when(answer.isNull() | answer["_corrupt_record"].isNotNull(), "bad_json")
        .when(F.size(answer["errors"]) > 0, "api_errors")
        .when(_user_missing(), "user_missing")
        .otherwise("ok"),
    )


def failed_users(triaged: DataFrame) -> DataFrame:
    """Users none of whose ranges could be read, with the number of ranges."""
    return (
        triaged.groupBy("username")
        .agg(
            F.count(F.lit(1)).alias("ranges"),
            F.count_if(F.col("status") != "ok").alias("failed_ranges"),
        )
        .filter(F.col("ranges") == F.col("failed_ranges"))
    )


def flatten_calendars(triaged: DataFrame) -> DataFrame:
    """One row per calendar day of the good answers: date and count as they came, ``fetch`` and ``arrival`` in it."""
    weeks = F.col("answer.data.user.contributionsCollection.contributionCalendar.weeks")
    # Weeks without days are taken out: one NULL would make the whole list NULL.
    days = F.flatten(F.filter(F.transform(weeks, lambda w: w["contributionDays"]), lambda d: d.isNotNull()))
    return (
        triaged.filter(F.col("status") == "ok")
        .select("username", "range_seq", _fetch(triaged), F.posexplode(days).alias("row", "day"))
        .select(
            "username",
            F.col("day.date").alias("date"),
            F.col("day.contributionCount").alias("contribution_count"),
            "fetch",
            _arrival("range_seq", "row"),
        )
        .filter(F.length("date") > 0)
    )


def cast_counts(days: DataFrame) -> DataFrame:
    """Whole-number counts; days without one, or with something else, are dropped.

    Text must spell an integer; a number loses its fraction. Counts stay BIGINT:
    whether one fits the table is for ``check_batch`` to say.
    """
    return days.withColumn(
        "contribution_count", F.try_variant_get("contribution_count", "$", "bigint")
    ).filter(F.col("contribution_count").isNotNull())


def new_days(days: DataFrame, stored: DataFrame, restate: bool = False) -> DataFrame:
    """Days not stored yet, once each; fetches loaded together give what one load after the other would.

    A day of several fetches is new only to the first. Within a fetch the last
    answer for a day wins. With ``restate`` stored days are let through as well,
    so that a reload can correct them, and the last fetch wins. Rows that arrived
    at the same place go by the larger count, whatever their order in the input.
    ``stored`` is what is known: bitmaps of days (see ``day_bitmaps``), or the
    rows themselves, which are only probed for the days at hand (first join),
    never shuffled for them while they are few enough to broadcast.
    """
    keys = ["username", "date"]
    turn = F.col("fetch") if restate else -F.col("fetch")
    wins = F.max(F.struct(turn, "arrival", "contribution_count")).alias("_wins")
    latest = days.groupBy(*keys).agg(wins).select(*keys, "_wins.contribution_count", "_wins.arrival")
    if restate:
        return latest
    if day_bitmaps.is_bitmaps(stored):
        return day_bitmaps.without_known(latest, stored)
    hits = stored.select(*keys).join(latest.select(*keys), keys, "left_semi")
    return latest.join(hits, keys, "left_anti")


# What to fetch --------------------------------------------------------------


def known_dates(stored: DataFrame) -> DataFrame:
    """Distinct stored days per user, as text; from rows or from bitmaps of days."""
    if day_bitmaps.is_bitmaps(stored):
        return day_bitmaps.dates(stored).withColumn("date", F.col("date").cast("string"))
    return stored.select("username", F.col("date").cast("string").alias("date")).distinct()


def plan_ranges(
    users: DataFrame,
    stored: DataFrame,
    as_of: dt.date | None = None,
    threshold: int = RAW_CONTRIBUTIONS.options["backfill_threshold"],
    window: int = RAW_CONTRIBUTIONS.options["restatement_window"],
    start_year: int = RAW_CONTRIBUTIONS.options["start_year"],
) -> DataFrame:
    """Date ranges to fetch per user: username, range_seq, mode, range_start, range_end.

    A user with fewer than ``threshold`` known days gets one range per calendar
    year since ``start_year``, the current one cut at ``as_of``; any other user
    gets the last ``window`` days. ``stored`` are bitmaps of days, or one row per
    user and day, counted as they are.
    """
    today = as_date(as_of)
    if day_bitmaps.is_bitmaps(stored):
        known = day_bitmaps.counts(stored)
    else:
        known = stored.groupBy("username").agg(F.count(F.lit(1)).alias("known_days"))
    backfill = F.coalesce(F.col("known_days"), F.lit(0)) < threshold
    # sequence() would count down if the first year were still to come.
    since_start = F.when(
        F.year(today) >= start_year, F.sequence(F.lit(start_year), F.greatest(F.year(today), F.lit(start_year)))
    ).otherwise(F.array().cast("array<int>"))
    years = F.when(backfill, since_start).otherwise(F.array(F.lit(None).cast("int")))
    return (
        users.select("username")
        .join(known, "username", "left")
        .select("username", F.posexplode(years).alias("range_seq", "year"))
        .select(
            "username",
            F.col("range_seq").cast("bigint").alias("range_seq"),
            F.when(F.col("year").isNull(), "incremental").otherwise("backfill").alias("mode"),
            F.coalesce(F.make_date("year", F.lit(1), F.lit(1)), F.date_sub(today, window)).alias("range_start"),
            F.least(F.make_date("year", F.lit(12), F.lit(31)), today).alias("range_end"),
        )
    )
