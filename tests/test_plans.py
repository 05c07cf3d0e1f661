"""What the physical plans must and must not contain."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from forgemeter.operators import ingest
from forgemeter.operators.staging import dedup_contributions
from forgemeter.operators.upsert import upsert
from forgemeter.plans import contributions, pulls
from forgemeter.session import scratch_root, settle
from forgemeter.sources import samples
from forgemeter.sources.tables import RAW_CONTRIBUTIONS

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def days(spark):
    return settle(samples.long_contributions(spark, SF), "days")


@pytest.fixture(scope="module")
def reviews(spark):
    return settle(samples.order_pulls(spark, SF), "reviews")


@pytest.mark.parametrize(
    "build",
    [
        contributions.activity_patterns,
        contributions.monthly,
        contributions.weekly,
        contributions.user_summary,
        contributions.recent_activity,
        contributions.streaks,
    ],
)
def test_one_shuffle_per_activity_table(days, build):
    text = plan(build(days))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in text and "SortAggregate" not in text


def test_row_level_tables_do_not_shuffle(reviews):
    assert "Exchange" not in plan(pulls.time_to_merge(reviews))
    assert "Exchange" not in plan(pulls.review_facts(reviews))


def test_recent_activity_pushes_the_cut_down(days, reviews):
    as_of = dt.date(2000, 12, 31)
    assert "GreaterThanOrEqual(date,2000-10-02)" in plan(contributions.recent_activity(days, as_of))
    assert "GreaterThanOrEqual(created_at,2000-10-02T00:00)" in plan(pulls.recent_reviews(reviews, as_of))


def test_copies_collapse_before_the_shuffle(spark):
    raw = settle(samples.duplicated_contributions(spark, SF), "copies")
    text = plan(dedup_contributions(raw, "arrival"))
    assert text.count("HashAggregate") == 2 and "partial_min_by" in text and "Window" not in text


def test_a_small_batch_never_shuffles_the_target(spark, days):
    batch = days.limit(5).withColumn("seq", F.lit(1).cast("bigint"))
    text = plan(upsert(days, settle(batch, "batch"), RAW_CONTRIBUTIONS, "seq"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_new_days_probe_the_stored_table_unshuffled(spark, days):
    number = F.lit(1).cast("bigint")
    batch = settle(days.limit(5).withColumn("arrival", number).withColumn("fetch", number), "batch")
    text = plan(ingest.new_days(batch, days))
    assert "LeftSemi, BuildRight" in text and "SortMergeJoin" not in text


def test_each_answer_is_parsed_once(spark, days):
    answers = settle(samples.landed_calendars(days), "answers")
    counts = ingest.cast_counts(ingest.flatten_calendars(ingest.triage_calendars(answers)))
    assert plan(counts).count("from_json(") == 1
    pages = settle(samples.landed_pages(samples.event_pulls(spark, SF)), "pages")
    assert plan(ingest.parse_pull_pages(pages)).count("from_json(") == 1


def test_columns_are_pruned(reviews):
    text = plan(pulls.activity_patterns(pulls.review_facts(reviews)))
    assert "ReadSchema: struct<state:string,created_at:timestamp_ntz,merged_at:timestamp_ntz,user_login:string>" in text


def test_scratch_is_the_named_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
