import datetime as dt

import pytest
from helpers import by_key, day, moment
from pyspark.sql import Window
from pyspark.sql import functions as F

from forgemeter.plans import pulls as p
from forgemeter.sources import samples

SCHEMA = (
    "repo_name string, pr_id bigint, state string, created_at timestamp_ntz, merged_at timestamp_ntz, user_login string"
)


@pytest.fixture(scope="module")
def six(spark):
    m = moment
    return spark.createDataFrame(
        [
            ("o/r1", 1, "closed", m("2024-01-01T00:00"), m("2024-01-02T12:00"), "u1"),
            ("o/r1", 2, "closed", m("2024-01-15T00:00"), None, "u1"),
            ("o/r2", 3, "open", m("2024-02-10T06:00"), None, "u1"),
            ("o/r2", 4, "closed", m("2024-03-01T00:00"), m("2024-03-01T06:00"), "u2"),
            ("o/r2", 5, "open", m("2024-03-05T00:00"), None, "u3"),
            ("o/r1", 6, "open", m("2024-03-05T00:00"), m("2024-03-07T00:00"), "u2"),
        ],
        SCHEMA,
    )


@pytest.fixture(scope="module", params=["facts", "rollup"])
def facts(request, six):
    single = p.review_facts(six)
    return single if request.param == "facts" else p.daily_rollup(single)


def test_user_summary(facts):
    found = by_key(p.user_summary(facts), "user_login")
    picked = {
        u: tuple(
            r[c]
            for c in (
                "total_pulls",
                "merged_pulls",
                "closed_not_merged_pulls",
                "open_pulls",
                "merge_rate_percent",
                "avg_days_to_merge",
                "repos_contributed_to",
            )
        )
        for u, r in found.items()
    }
    assert picked == {
        "u1": (3, 1, 1, 1, 50.0, 1.5, 2),
        "u2": (2, 1, 0, 1, 100.0, 1.13, 2),
        "u3": (1, 0, 0, 1, None, None, 1),
    }
    assert found["u1"]["first_pr_date"] == moment("2024-01-01T00:00")
    assert found["u1"]["last_pr_date"] == moment("2024-02-10T06:00")


def test_repo_summary(facts, six):
    found = by_key(p.repo_summary(facts, six), "repo_name")
    picked = {
        r: (v["merge_rate_percent"], v["avg_days_to_merge"], v["median_days_to_merge"]) for r, v in found.items()
    }
    assert picked == {"o/r1": (50.0, 1.75, 1.75), "o/r2": (100.0, 0.25, 0.25)}


def test_leaderboard(facts):
    found = by_key(p.leaderboard(p.user_summary(facts)), "user_login")
    ranks = {
        u: tuple(r[f"rank_by_{k}"] for k in ("total", "merged", "merge_rate", "repos")) for u, r in found.items()
    }
    assert ranks == {"u1": (1, 1, 2, 1), "u2": (2, 1, 1, 1), "u3": (3, 3, 3, 3)}
    assert {u: r["overall_score"] for u, r in found.items()} == {"u1": 1.2, "u2": 1.4, "u3": 3.0}


def test_trends(facts):
    rows = p.trends(p.monthly(facts)).orderBy("month_start").collect()
    assert [r["month_label"] for r in rows] == ["2024-01", "2024-02", "2024-03"]
    assert [(r["monthly_pulls"], r["monthly_merged"]) for r in rows] == [(2, 1), (1, 0), (3, 1)]
    assert [r["month_over_month_change"] for r in rows] == [2, -1, 2]
    assert [r["month_over_month_pct_change"] for r in rows] == [None, -50.0, 200.0]
    assert [r["three_month_avg_pulls"] for r in rows] == [2.0, 1.5, 2.0]
    assert [r["merged_month_over_month_change"] for r in rows] == [1, -1, 1]


def test_time_to_merge(six):
    found = by_key(p.time_to_merge(six), "pr_id")
    assert {i: r["pr_status"] for i, r in found.items()} == {
        1: "merged",
        2: "closed_not_merged",
        4: "merged",
        6: "merged",
    }
    assert (found[1]["days_to_merge"], found[1]["hours_to_merge"]) == (1.5, 36.0)
    assert found[2]["days_to_merge"] is None


def test_missing_values_form_their_own_groups(spark):
    rows = spark.createDataFrame(
        [("o/r", 1, None, None, moment("2024-01-01T00:00"), None), ("o/r", 2, "closed", moment("2024-01-01T00:00"), None, None)],
        SCHEMA,
    )
    facts = p.review_facts(rows)
    row = p.user_summary(facts).first()
    assert (row["user_login"], row["total_pulls"], row["closed_not_merged_pulls"], row["open_pulls"]) == (None, 2, 1, 0)
    assert row["avg_days_to_merge"] is None
    months = by_key(p.monthly(facts), "month_start")
    assert set(months) == {None, day("2024-01-01")}
    assert months[None]["unique_contributors"] == 0


def test_states_add_up(spark):
    facts = p.review_facts(samples.order_pulls(spark, "/root/testdata/sf0.001"))
    for table in (p.user_summary(facts), p.monthly(facts), p.weekly(facts)):
        off = table.filter(
            F.col("merged_pulls") + F.col("closed_not_merged_pulls") + F.col("open_pulls") != F.col("total_pulls")
        )
        assert off.count() == 0


def _same(one, other):
    return one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


def test_rollup_gives_the_same_tables(spark):
    staged = samples.event_pulls(spark, "/root/testdata/sf0.01")
    single = p.review_facts(staged)
    rolled = p.daily_rollup(single)
    for table in (p.activity_patterns, p.monthly, p.user_summary, p.weekly):
        assert _same(table(single), table(rolled)), table.__name__


def test_ranks_and_medians_equal_the_built_in_ones(spark):
    staged = samples.event_pulls(spark, "/root/testdata/sf0.01")
    facts = p.review_facts(staged)
    users = p.user_summary(facts)
    ranks = F.rank().over(Window.orderBy(F.col("total_pulls").desc())).cast("bigint").alias("rank_by_total")
    assert _same(p.leaderboard(users).select("user_login", "rank_by_total"), users.select("user_login", ranks))
    micros = F.unix_micros(F.col("merged_at").cast("timestamp")) - F.unix_micros(F.col("created_at").cast("timestamp"))
    median = F.percentile(micros, 0.5).alias("median")
    plain = by_key(staged.filter("merged_at is not null").groupBy("repo_name").agg(median), "repo_name")
    found = by_key(p.repo_summary(facts, staged).filter("median_days_to_merge is not null"), "repo_name")
    assert set(found) == set(plain)
    for repo, row in found.items():
        assert row["median_days_to_merge"] == pytest.approx(plain[repo]["median"] / 86_400e6)


def test_hot_authors_are_split_without_changing_counts(spark):
    staged = samples.event_pulls(spark, "/root/testdata/sf0.01")
    # A third of all reviews by one author, another large group with none.
    number = F.col("pr_id") % 10
    hot = staged.withColumn(
        "user_login", F.when(number < 3, F.lit("bot")).when(number > 4, F.col("user_login"))
    )
    plain = p.recent_activity(hot, samples.DENSE_AS_OF)
    split = p.recent_activity(hot, samples.DENSE_AS_OF, block_rows=100)
    assert _same(plain, split)
    window = Window.partitionBy("user_login").orderBy("created_at", "pr_id").rowsBetween(-29, 0)
    expected = hot.select("pr_id", F.count(F.lit(1)).over(window).alias("pulls_last_30_days"))
    assert _same(split.select("pr_id", "pulls_last_30_days"), expected)


def test_next_event_of_hot_users(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert _same(samples.event_pulls(spark, sf_dir), samples.event_pulls(spark, sf_dir, block_rows=50))


def test_tied_creation_times_go_by_id(spark):
    at = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([("o/r", i, "closed", at, at, "u") for i in (3, 1, 2)], SCHEMA)
    found = by_key(p.recent_activity(rows, dt.date(2024, 1, 2)), "pr_id")
    assert {i: r["pulls_last_30_days"] for i, r in found.items()} == {1: 1, 2: 2, 3: 3}
