"""The registered queries: every operator on rows derived from the given tables."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.operators import checks, day_bitmaps, enforce, ingest, month_states, staging
from forgemeter.operators.upsert import upsert
from forgemeter.plans import contributions, pulls, runs
from forgemeter.plans.rules import CONTRIBUTION_RULES, PULL_RULES, REVIEW_STATES, SOURCE_RULES
from forgemeter.plans.suite import run_suite
from forgemeter.session import scratch_path, settle
from forgemeter.sources import samples
from forgemeter.sources.samples import (
    DENSE_AS_OF,
    LONG_AS_OF,
    ORDERS_AS_OF,
    dense_contributions,
    event_pulls,
    landed_calendars,
    landed_pages,
    long_contributions,
    order_pulls,
    troubled_calendars,
)
from forgemeter.sources.states import current_states
from forgemeter.sources.tables import RAW_CONTRIBUTIONS, RAW_PULLS, read_table
from forgemeter.streaming import landing

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# Ingest ---------------------------------------------------------------------


@query
def pull_pages_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = ingest.parse_pull_pages(landed_pages(event_pulls(spark, sf_dir)))
    return enforce.accepted(enforce.check_batch(parsed.drop("fetch", "arrival"), RAW_PULLS))


@query
def calendar_flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = ingest.flatten_calendars(
        ingest.triage_calendars(landed_calendars(long_contributions(spark, sf_dir)))
    )
    return days.select("username", "date", F.col("contribution_count").cast("string").alias("count_text"))


@query
def calendar_counts_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("contribution_count").cast("string")
    day = F.dayofmonth("date")
    as_sent = (
        F.when(day == 1, F.concat(F.lit('"'), text, F.lit('"')))
        .when(day == 2, F.lit('"n/a"'))
        .when(day == 3, F.lit("null"))
        .when(day == 4, F.concat(text, F.lit(".75")))
        .when(day == 5, F.concat(F.lit('"'), text, F.lit('.75"')))
        .otherwise(text)
    )
    answers = landed_calendars(long_contributions(spark, sf_dir), as_sent)
    days = ingest.cast_counts(ingest.flatten_calendars(ingest.triage_calendars(answers)))
    return days.select("username", "date", F.col("contribution_count").cast("int").alias("contribution_count"))


@query
def calendar_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = troubled_calendars(landed_calendars(long_contributions(spark, sf_dir)))
    return ingest.triage_calendars(answers).select("username", "range_seq", "status")


@query
def calendar_failed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = troubled_calendars(landed_calendars(long_contributions(spark, sf_dir)))
    return ingest.failed_users(ingest.triage_calendars(answers))


@query
def calendars_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = scratch_path(spark, "raw-troubled")
    answers = troubled_calendars(landed_calendars(long_contributions(spark, sf_dir)))
    runs.load_calendars(answers, raw, strict=False)
    return runs.quarantined(spark, raw).drop("body")


@query
def known_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = settle(day_bitmaps.day_bitmaps(samples.duplicated_contributions(spark, sf_dir)), "known")
    return ingest.known_dates(known)


@query
def fetch_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("username")
    )
    known = settle(day_bitmaps.day_bitmaps(long_contributions(spark, sf_dir)), "known")
    return ingest.plan_ranges(users, known, LONG_AS_OF, threshold=534, window=7, start_year=1995)


@query
def new_rows_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = dense_contributions(spark, sf_dir)
    of_month, n = F.dayofmonth("date"), F.col("contribution_count")
    stored = days.filter(of_month <= 20)
    first = days.filter(of_month.between(10, 25)).withColumn("arrival", F.lit(0).cast("bigint"))
    second = days.filter(of_month >= 18).select(
        "username", "date", (n + 1).alias("contribution_count"), F.lit(1).cast("bigint").alias("arrival")
    )
    one_fetch = first.unionByName(second).withColumn("fetch", F.lit(0).cast("bigint"))
    return ingest.new_days(one_fetch, settle(day_bitmaps.day_bitmaps(stored), "known"))


@query
def new_rows_restated(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = dense_contributions(spark, sf_dir)
    batch = days.withColumn("arrival", F.lit(0).cast("bigint")).unionByName(
        days.filter(F.dayofmonth("date") >= 18).select(
            "username",
            "date",
            (F.col("contribution_count") + 1).alias("contribution_count"),
            F.lit(1).cast("bigint").alias("arrival"),
        )
    )
    return ingest.new_days(batch.withColumn("fetch", F.lit(0).cast("bigint")), days, restate=True)


def _fetched(landed: DataFrame, at: dt.datetime) -> DataFrame:
    return landed.withColumn("fetched_at", F.lit(at).cast("timestamp"))


def _refetched(spark: SparkSession, sf_dir: str, restate: bool) -> DataFrame:
    """The raw table after one load of two overlapping fetches per user, the later one listed first."""
    days = dense_contributions(spark, sf_dir)
    n = F.col("contribution_count")
    early = _fetched(landed_calendars(days.filter(F.dayofmonth("date") <= 25)), dt.datetime(2024, 1, 26))
    late_days = days.filter(F.dayofmonth("date") >= 18).withColumn("contribution_count", n + 100)
    late = _fetched(landed_calendars(late_days), dt.datetime(2024, 2, 1))
    raw = scratch_path(spark, "raw-refetched")
    runs.load_calendars(late.unionByName(early), raw, restate)
    return read_table(spark, RAW_CONTRIBUTIONS, raw).select(*RAW_CONTRIBUTIONS.column_names)


@query
def calendars_refetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refetched(spark, sf_dir, restate=True)


@query
def calendars_refetched_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refetched(spark, sf_dir, restate=False)


@query
def pages_refetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fetches of the pages in one load; the first saw every review open."""
    reviews = order_pulls(spark, sf_dir)
    opened = reviews.withColumn("state", F.lit("open")).withColumn("merged_at", F.lit(None).cast("timestamp_ntz"))
    early = _fetched(landed_pages(opened), dt.datetime(2001, 8, 1))
    late = reviews.filter(F.col("created_at") >= F.lit(dt.date(2000, 1, 1)))
    raw = scratch_path(spark, "raw-pages")
    runs.load_pulls(_fetched(landed_pages(late), dt.datetime(2001, 8, 2)).unionByName(early), raw)
    return read_table(spark, RAW_PULLS, raw).select("pr_id", "state", "merged_at")


@query
def pages_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that were answered with an error object."""
    body = F.when(F.col("seq") % 7 == 3, F.lit('{"message": "Not Found"}')).otherwise(F.col("body"))
    raw = scratch_path(spark, "raw-pages")
    runs.load_pulls(landed_pages(order_pulls(spark, sf_dir)).withColumn("body", body), raw, strict=False)
    return runs.quarantined_pages(spark, raw)


def _troubled_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed calendars in which some users have a count beyond INT on one day, others a name too long."""
    days = long_contributions(spark, sf_dir)
    number = F.regexp_extract("username", r"(\d+)", 1).cast("bigint")
    text = F.when(
        (number % 10 == 4) & (F.dayofmonth("date") == 9), F.lit("3000000000")
    ).otherwise(F.col("contribution_count").cast("string"))
    renamed = F.when(number % 10 == 6, F.rpad("username", 300, "x")).otherwise(F.col("username"))
    return landed_calendars(days.withColumn("username", renamed), text)


@query
def calendars_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is stored after a load in which some users have invalid days: all of the others, none of theirs."""
    raw = scratch_path(spark, "raw-isolated")
    runs.load_calendars(_troubled_days(spark, sf_dir), raw, strict=False)
    return read_table(spark, RAW_CONTRIBUTIONS, raw).select(*RAW_CONTRIBUTIONS.column_names)


@query
def calendars_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the users kept out of that load."""
    raw = scratch_path(spark, "raw-refused")
    runs.load_calendars(_troubled_days(spark, sf_dir), raw, strict=False)
    given = F.from_json("given", "username string, date string, contribution_count bigint")
    return runs.refused(spark, raw).select(
        "unit", "violation", given["date"].alias("date"), given["contribution_count"].alias("given_count")
    )


def _troubled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages in which every repository of one segment has a few reviews by an author with too long a name."""
    reviews = order_pulls(spark, sf_dir)
    long_name = F.col("repo_name").startswith("MACHINERY/") & (F.col("pr_id") % 50 == 1)
    login = F.when(long_name, F.rpad("user_login", 256, "x")).otherwise(F.col("user_login"))
    return landed_pages(reviews.withColumn("user_login", login))


@query
def pulls_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews stored after a load in which some repositories have an invalid review."""
    raw = scratch_path(spark, "raw-isolated")
    runs.load_pulls(_troubled_pages(spark, sf_dir), raw, strict=False)
    return read_table(spark, RAW_PULLS, raw).select("repo_name", "pr_id", "state", "created_at", "merged_at")


@query
def pulls_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of the repositories kept out of that load, counted by violation."""
    raw = scratch_path(spark, "raw-refused")
    runs.load_pulls(_troubled_pages(spark, sf_dir), raw, strict=False)
    return runs.refused(spark, raw).groupBy("unit", "violation").agg(F.count(F.lit(1)).alias("reviews"))


@query
def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = long_contributions(spark, sf_dir)
    n = F.col("contribution_count")
    target = days.filter(F.col("date") <= F.lit(dt.date(2000, 6, 30)))
    late = days.filter(F.col("date") > F.lit(dt.date(2000, 3, 31)))
    batch = late.select("username", "date", (n + 1).alias("contribution_count"), F.lit(1).alias("seq")).unionByName(
        late.select("username", "date", (n * 2).alias("contribution_count"), F.lit(2).alias("seq"))
    )
    return upsert(target, batch, RAW_CONTRIBUTIONS, "seq")


def _old_and_new_pulls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    all_pulls = order_pulls(spark, sf_dir)
    target = (
        all_pulls.filter(F.col("created_at") < F.lit(dt.date(2001, 1, 1)))
        .withColumn("state", F.lit("open"))
        .withColumn("merged_at", F.lit(None).cast("timestamp_ntz"))
    )
    late = all_pulls.filter(F.col("created_at") >= F.lit(dt.date(2000, 7, 1)))
    batch = (
        late.withColumn("user_login", F.concat(F.lit("was "), F.col("user_login")))
        .withColumn("seq", F.lit(1))
        .unionByName(late.withColumn("seq", F.lit(2)))
    )
    return target, batch


@query
def upsert_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _old_and_new_pulls(spark, sf_dir)
    return upsert(target, batch, RAW_PULLS, "seq")


@query
def upsert_pull_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = dataclasses.replace(RAW_PULLS, load="merge_fields", update_fields=("state", "merged_at"))
    target, batch = _old_and_new_pulls(spark, sf_dir)
    return upsert(target, batch, spec, "seq")


@query
def schema_enforced(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, login = F.col("pr_id"), F.col("user_login")
    dirty = order_pulls(spark, sf_dir).select(
        F.when(key % 5 != 0, F.col("repo_name")).alias("repo_name"),
        F.when(key % 7 == 0, F.concat(F.lit("#"), key.cast("string"))).otherwise(key.cast("string")).alias("pr_id"),
        F.when(key % 11 == 0, F.repeat(F.col("state"), 20)).otherwise(F.col("state")).alias("state"),
        F.when(key % 13 == 0, F.lit("yesterday")).otherwise(F.col("created_at").cast("string")).alias("created_at"),
        F.col("merged_at").cast("string").alias("merged_at"),
        F.when(key % 17 == 0, F.repeat(login, 30)).otherwise(login).alias("user_login"),
        key.alias("order_key"),
    )
    return enforce.check_batch(dirty, RAW_PULLS).select("order_key", "pr_id", "created_at", "violation")


@query
def batch_key_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enforce.duplicated_keys(_dirty_pulls(spark, sf_dir), RAW_PULLS)


@query
def batch_day_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enforce.duplicated_keys(samples.duplicated_contributions(spark, sf_dir), RAW_CONTRIBUTIONS)


# Staging --------------------------------------------------------------------


@query
def contrib_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.dedup_contributions(samples.duplicated_contributions(spark, sf_dir), arrival="arrival")


@query
def contrib_dedup_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.dedup_contributions(samples.duplicated_contributions(spark, sf_dir))


@query
def pulls_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.key_pulls(order_pulls(spark, sf_dir))


# Daily activity -------------------------------------------------------------


@query
def contrib_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contributions.activity_patterns(long_contributions(spark, sf_dir))


@query
def contrib_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contributions.leaderboard(contributions.user_summary(long_contributions(spark, sf_dir)))


@query
def contrib_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contributions.monthly(long_contributions(spark, sf_dir))


@query
def contrib_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contributions.recent_activity(long_contributions(spark, sf_dir), LONG_AS_OF)


@query
def contrib_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contributions.streaks(dense_contributions(spark, sf_dir), DENSE_AS_OF)


@query
def contrib_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contributions.trends(contributions.monthly(long_contributions(spark, sf_dir)))


@query
def contrib_user_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The last digits of a floating-point deviation depend on the summation order.
    return contributions.user_summary(long_contributions(spark, sf_dir), LONG_AS_OF).withColumn(
        "stddev_daily_contributions", F.round("stddev_daily_contributions", 6)
    )


@query
def contrib_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contributions.weekly(long_contributions(spark, sf_dir))


def _states_after_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of all months, made once after the older days were loaded and brought up to date after the rest."""
    raw = scratch_path(spark, "raw-states")
    days = long_contributions(spark, sf_dir)
    for part in (F.col("date") < F.lit(dt.date(2000, 6, 15)), F.col("date") >= F.lit(dt.date(2000, 6, 15))):
        runs.load_calendars(landed_calendars(days.filter(part)), raw)
        states = current_states(spark, raw, contributions.MIN_STREAK_DAYS)
    return states


@query
def contrib_monthly_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_states.monthly(_states_after_two_loads(spark, sf_dir))


@query
def contrib_user_summary_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_states.user_summary(_states_after_two_loads(spark, sf_dir), LONG_AS_OF).withColumn(
        "stddev_daily_contributions", F.round("stddev_daily_contributions", 6)
    )


@query
def contrib_streaks_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_states.streaks(_states_after_two_loads(spark, sf_dir), contributions.MIN_STREAK_DAYS, LONG_AS_OF)


# Reviews --------------------------------------------------------------------


@query
def pulls_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.activity_patterns(pulls.review_facts(order_pulls(spark, sf_dir)))


@query
def pulls_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.leaderboard(pulls.user_summary(pulls.review_facts(order_pulls(spark, sf_dir))))


@query
def pulls_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.monthly(pulls.review_facts(order_pulls(spark, sf_dir)))


@query
def pulls_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.recent_activity(order_pulls(spark, sf_dir), ORDERS_AS_OF)


@query
def pulls_recent_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.recent_activity(event_pulls(spark, sf_dir), DENSE_AS_OF)


@query
def pulls_repo_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = settle(order_pulls(spark, sf_dir), "pulls")
    return pulls.repo_summary(pulls.review_facts(staged), staged)


@query
def pulls_repo_summary_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = settle(event_pulls(spark, sf_dir), "pulls")
    return pulls.repo_summary(pulls.review_facts(staged), staged)


@query
def pulls_time_to_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.time_to_merge(order_pulls(spark, sf_dir))


@query
def pulls_time_to_merge_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.time_to_merge(event_pulls(spark, sf_dir))


@query
def pulls_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.trends(pulls.monthly(pulls.review_facts(order_pulls(spark, sf_dir))))


@query
def pulls_user_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.user_summary(pulls.review_facts(order_pulls(spark, sf_dir)))


@query
def pulls_user_summary_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.user_summary(pulls.review_facts(event_pulls(spark, sf_dir)))


@query
def pulls_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.weekly(pulls.review_facts(order_pulls(spark, sf_dir)))


@query
def pulls_monthly_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulls.monthly(pulls.daily_rollup(pulls.review_facts(order_pulls(spark, sf_dir))))


# Data tests -----------------------------------------------------------------


def _dirty_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown users, and days without a count."""
    day, n = F.dayofmonth("date"), F.col("contribution_count")
    return long_contributions(spark, sf_dir).select(
        F.when(~F.col("username").endswith("7"), F.col("username")).alias("username"),
        "date",
        F.when(day != 13, n).alias("contribution_count"),
    )


def _dirty_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated ids, unknown states, missing authors and creation dates."""
    key = F.col("pr_id")
    return order_pulls(spark, sf_dir).select(
        F.when(key % 19 != 0, F.col("repo_name")).alias("repo_name"),
        F.when(key % 10 == 3, key + 1).otherwise(key).alias("pr_id"),
        F.when(key % 23 == 0, F.lit("draft"))
        .when(key % 29 == 0, F.lit("locked"))
        .when(key % 31 != 0, F.col("state"))
        .alias("state"),
        F.when(key % 37 != 0, F.col("created_at")).alias("created_at"),
        "merged_at",
        F.when(key % 41 != 0, F.col("user_login")).alias("user_login"),
    )


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [r for r in PULL_RULES if r.model == "pulls_staged" and r.test == "not_null"]
    return checks.check_model(_dirty_pulls(spark, sf_dir), rules)


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_model(_dirty_pulls(spark, sf_dir), [checks.Rule("raw_pulls", "pr_id", "unique")])


@query
def dq_duplicated_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicated_values(_dirty_pulls(spark, sf_dir), "pr_id")


@query
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = checks.Rule("pulls_staged", "state", "accepted_values", tuple(REVIEW_STATES))
    return checks.check_model(_dirty_pulls(spark, sf_dir), [rule])


@query
def dq_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules declared on the raw table."""
    return run_suite({"raw_pulls": settle(_dirty_pulls(spark, sf_dir), "dirty")}, SOURCE_RULES, sources=True)


@query
def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules on all tables, built from dirty rows."""
    staged = settle(staging.dedup_contributions(_dirty_contributions(spark, sf_dir)), "dirty")
    # NULL counts cannot be loaded; they only reach the staged table's own tests.
    counted = staged.filter(F.col("contribution_count").isNotNull())
    reviews = settle(_dirty_pulls(spark, sf_dir), "dirty")
    facts = pulls.review_facts(reviews)
    models = {
        "contrib_staged": lambda: staged,
        "contrib_patterns": lambda: contributions.activity_patterns(counted),
        "contrib_leaderboard": lambda: contributions.leaderboard(contributions.user_summary(counted)),
        "contrib_monthly": lambda: contributions.monthly(counted),
        "contrib_recent": lambda: contributions.recent_activity(counted, LONG_AS_OF),
        "contrib_streaks": lambda: contributions.streaks(counted, LONG_AS_OF),
        "contrib_trends": lambda: contributions.trends(contributions.monthly(counted)),
        "contrib_user_summary": lambda: contributions.user_summary(counted, LONG_AS_OF),
        "contrib_weekly": lambda: contributions.weekly(counted),
        "pulls_staged": lambda: reviews,
        "pulls_patterns": lambda: pulls.activity_patterns(facts),
        "pulls_leaderboard": lambda: pulls.leaderboard(pulls.user_summary(facts)),
        "pulls_monthly": lambda: pulls.monthly(facts),
        "pulls_recent": lambda: pulls.recent_activity(reviews, ORDERS_AS_OF),
        "pulls_repo_summary": lambda: pulls.repo_summary(facts, reviews),
        "pulls_time_to_merge": lambda: pulls.time_to_merge(reviews),
        "pulls_trends": lambda: pulls.trends(pulls.monthly(facts)),
        "pulls_user_summary": lambda: pulls.user_summary(facts),
        "pulls_weekly": lambda: pulls.weekly(facts),
    }
    made = runs.Tables(spark, scratch_path(spark, "dq-suite"), [*CONTRIBUTION_RULES, *PULL_RULES])
    made.build(models)
    return run_suite(made.models, made.rules, watched=made.watched)


# End to end -----------------------------------------------------------------


@query
def run_pulls_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages, loaded as a stream of files, to the stored user summary."""
    landed, raw, out, state = (scratch_path(spark, f"pulls-{n}") for n in ("landed", "raw", "out", "state"))
    landed_pages(event_pulls(spark, sf_dir)).write.json(landed)
    landing.drain_pulls(spark, landed, raw, state).awaitTermination()
    return runs.run_pulls(spark, raw, out, DENSE_AS_OF)["pulls_user_summary"]


@query
def run_contributions_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed calendars, loaded as a stream of files, to the stored monthly table."""
    landed, raw, out, state = (scratch_path(spark, f"contrib-{n}") for n in ("landed", "raw", "out", "state"))
    landed_calendars(long_contributions(spark, sf_dir)).write.json(landed)
    landing.drain_calendars(spark, landed, raw, state).awaitTermination()
    return runs.run_contributions(spark, raw, out, LONG_AS_OF)["contrib_monthly"]


@query
def raw_after_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after an old load and an overlapping new one."""
    raw = scratch_path(spark, "raw")
    days = dense_contributions(spark, sf_dir)
    old = days.filter(F.dayofmonth("date") <= 20)
    runs.load_calendars(landed_calendars(old), raw)
    grown = days.withColumn("contribution_count", F.col("contribution_count") + 5)
    runs.load_calendars(landed_calendars(grown), raw)
    return read_table(spark, RAW_CONTRIBUTIONS, raw).select(*RAW_CONTRIBUTIONS.column_names)
