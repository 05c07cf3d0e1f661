"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local
cores, ``BENCH_RUNS`` the timed runs per query (the median counts, after one
warm-up run).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from forgemeter.operators import checks, ingest, staging  # noqa: E402
from forgemeter.operators.upsert import upsert  # noqa: E402
from forgemeter.plans import contributions, pulls  # noqa: E402
from forgemeter.plans.rules import PULL_RULES  # noqa: E402
from forgemeter.session import local_session, settle  # noqa: E402
from forgemeter.sources import samples  # noqa: E402
from forgemeter.sources.tables import RAW_CONTRIBUTIONS, RAW_PULLS  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def cases(spark, sf_dir: str) -> dict:
    """Each operator on stored input, as in a run, where every table reads the stored staging."""
    days = settle(samples.long_contributions(spark, sf_dir), "bench")
    dense = settle(samples.dense_contributions(spark, sf_dir), "bench")
    copies = settle(samples.duplicated_contributions(spark, sf_dir), "bench")
    reviews = settle(samples.order_pulls(spark, sf_dir), "bench")
    events = settle(samples.event_pulls(spark, sf_dir), "bench")
    pages = settle(samples.landed_pages(events), "bench")
    calendars = settle(samples.landed_calendars(days), "bench")
    facts = pulls.review_facts(reviews)
    late_days = days.filter(F.col("date") >= "2000-10-01").withColumn("arrival", F.lit(1).cast("bigint"))
    fetched_days = late_days.withColumn("fetch", F.lit(1).cast("bigint"))
    late_reviews = reviews.filter(F.col("created_at") >= "2001-01-01").withColumn("arrival", F.col("pr_id"))
    staged_rules = [r for r in PULL_RULES if r.model == "pulls_staged"]
    return {
        "pull_pages_parsed": lambda: ingest.parse_pull_pages(pages),
        "calendar_counts_cast": lambda: ingest.cast_counts(
            ingest.flatten_calendars(ingest.triage_calendars(calendars))
        ),
        "new_rows_merged": lambda: ingest.new_days(fetched_days, days.filter(F.col("date") < "2000-12-01")),
        "upsert_counts": lambda: upsert(days, late_days, RAW_CONTRIBUTIONS, "arrival"),
        "upsert_pulls": lambda: upsert(reviews, late_reviews, RAW_PULLS, "arrival"),
        "contrib_dedup": lambda: staging.dedup_contributions(copies, "arrival"),
        "pulls_keyed": lambda: staging.key_pulls(reviews),
        "contrib_patterns": lambda: contributions.activity_patterns(days),
        "contrib_leaderboard": lambda: contributions.leaderboard(contributions.user_summary(days)),
        "contrib_monthly": lambda: contributions.monthly(days),
        "contrib_recent": lambda: contributions.recent_activity(days, samples.LONG_AS_OF),
        "contrib_streaks": lambda: contributions.streaks(dense, samples.DENSE_AS_OF),
        "contrib_trends": lambda: contributions.trends(contributions.monthly(days)),
        "contrib_user_summary": lambda: contributions.user_summary(days, samples.LONG_AS_OF),
        "contrib_weekly": lambda: contributions.weekly(days),
        "pulls_patterns": lambda: pulls.activity_patterns(facts),
        "pulls_leaderboard": lambda: pulls.leaderboard(pulls.user_summary(facts)),
        "pulls_monthly": lambda: pulls.monthly(facts),
        "pulls_recent": lambda: pulls.recent_activity(events, samples.DENSE_AS_OF),
        "pulls_repo_summary": lambda: pulls.repo_summary(pulls.review_facts(events), events),
        "pulls_time_to_merge": lambda: pulls.time_to_merge(events),
        "pulls_trends": lambda: pulls.trends(pulls.monthly(facts)),
        "pulls_user_summary": lambda: pulls.user_summary(facts),
        "pulls_weekly": lambda: pulls.weekly(facts),
        "dq_staged": lambda: checks.check_model(reviews, staged_rules),
        "dq_unique": lambda: checks.check_model(reviews, [checks.Rule("raw_pulls", "pr_id", "unique")]),
    }


def timed(build) -> float:
    start = time.perf_counter()
    # The noop sink computes every row and column without fetching them.
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"), **{"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, build in cases(spark, sf_dir).items():
        timed(build)
        seconds[name] = round(statistics.median(timed(build) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
