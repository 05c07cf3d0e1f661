import pytest
from helpers import by_key, day
from pyspark.sql import Window
from pyspark.sql import functions as F

from forgemeter.plans import contributions as c
from forgemeter.sources import samples

SCHEMA = "username string, date date, contribution_count int"
AS_OF = day("2024-03-07")


@pytest.fixture(scope="module")
def one_user(spark):
    counts = {
        "2024-02-26": 1, "2024-02-27": 2, "2024-02-28": 3, "2024-02-29": 4, "2024-03-01": 0,
        "2024-03-02": 5, "2024-03-03": 5, "2024-03-04": 5, "2024-03-06": 1,
    }
    return spark.createDataFrame([("a", day(d), n) for d, n in counts.items()], SCHEMA)


def test_streaks(one_user):
    found = by_key(c.streaks(one_user, AS_OF), "streak_start")
    assert set(found) == {day("2024-02-26"), day("2024-03-02")}
    first, second = found[day("2024-02-26")], found[day("2024-03-02")]
    assert (first["streak_end"], first["streak_length_days"]) == (day("2024-02-29"), 4)
    assert (first["streak_total_contributions"], first["streak_avg_contributions"]) == (10, 2.5)
    assert (second["streak_end"], second["streak_length_days"]) == (day("2024-03-04"), 3)
    assert (second["streak_total_contributions"], second["streak_avg_contributions"]) == (15, 5.0)
    assert {first["streak_status"], second["streak_status"]} == {"ended"}


def test_a_streak_up_to_yesterday_is_active(one_user):
    found = by_key(c.streaks(one_user, day("2024-03-05")), "streak_start")
    assert found[day("2024-03-02")]["streak_status"] == "active"
    assert found[day("2024-02-26")]["streak_status"] == "ended"


def test_monthly_with_leap_february(one_user):
    found = by_key(c.monthly(one_user), "month_label")
    feb, mar = found["2024-02"], found["2024-03"]
    assert (feb["days_with_contributions"], feb["total_contributions"]) == (4, 10)
    assert (feb["avg_daily_contributions"], feb["max_daily_contributions"], feb["min_daily_contributions"]) == (2.5, 4, 1)
    assert feb["contribution_rate_percent"] == 13.79
    assert (mar["days_with_contributions"], mar["total_contributions"]) == (5, 16)
    assert (mar["avg_daily_contributions"], mar["max_daily_contributions"], mar["min_daily_contributions"]) == (3.2, 5, 0)
    assert mar["contribution_rate_percent"] == 16.13


def test_weekly(one_user):
    found = by_key(c.weekly(one_user), "week_start")
    assert {d: (r["days_with_contributions"], r["total_contributions"]) for d, r in found.items()} == {
        day("2024-02-26"): (7, 20),
        day("2024-03-04"): (2, 6),
    }


def test_user_summary(one_user):
    row = by_key(c.user_summary(one_user, AS_OF), "username")["a"]
    assert (row["total_days_with_contributions"], row["total_contributions"]) == (9, 26)
    assert row["avg_daily_contributions"] == pytest.approx(26 / 9)
    assert row["max_daily_contributions"] == 5
    assert row["stddev_daily_contributions"] == pytest.approx(1.964971, abs=1e-6)
    assert (row["total_days_in_range"], row["overall_activity_rate_percent"]) == (10, 90.0)
    assert row["days_since_last_contribution"] == 1


def test_recent_windows_are_rows_not_days(one_user):
    rows = c.recent_activity(one_user, AS_OF).orderBy("date").collect()
    assert [r["contributions_last_7_days"] for r in rows] == [1, 3, 6, 10, 10, 15, 20, 24, 23]


def test_the_cut_comes_before_the_windows(spark):
    days = spark.createDataFrame([("a", day("2024-01-01"), 100), ("a", day("2024-04-01"), 1)], SCHEMA)
    rows = c.recent_activity(days, day("2024-04-01")).collect()
    # 2024-01-02 is the 90th day back, so the first row is out.
    assert [(r["date"], r["contributions_last_30_days"]) for r in rows] == [(day("2024-04-01"), 1)]
    assert c.recent_activity(days, day("2024-03-31")).count() == 2


def test_names_are_padded_and_sunday_is_zero(spark):
    days = spark.createDataFrame([("a", day("2024-05-05"), 1), ("a", day("2024-05-06"), 0)], SCHEMA)
    rows = c.activity_patterns(days).collect()
    assert [(r["day_of_week"], r["day_of_week_num"], r["month_name"], r["month_num"]) for r in rows] == [
        ("Sunday   ", 0, "May      ", 5)
    ]


def test_trends_skip_missing_months_and_zero_divisors(spark):
    days = spark.createDataFrame(
        [("a", day("2024-01-05"), 4), ("a", day("2024-03-05"), 0), ("a", day("2024-04-05"), 3), ("a", day("2024-05-05"), 1)],
        SCHEMA,
    )
    rows = c.trends(c.monthly(days)).orderBy("month_start").collect()
    assert [r["prev_month_contributions"] for r in rows] == [None, 4, 0, 3]
    assert [r["month_over_month_change"] for r in rows] == [4, -4, 3, -2]
    assert [r["month_over_month_pct_change"] for r in rows] == [None, -100.0, None, -66.67]
    assert [r["three_month_avg"] for r in rows] == [4.0, 2.0, 2.33, 1.33]


def test_single_day_user_has_no_deviation(spark):
    row = c.user_summary(spark.createDataFrame([("a", day("2024-01-05"), 4)], SCHEMA), AS_OF).first()
    assert row["stddev_daily_contributions"] is None
    assert row["overall_activity_rate_percent"] == 100.0


def test_leaderboard_ranks_tie_and_score(spark):
    days = spark.createDataFrame(
        [
            ("a", day("2024-01-01"), 6),
            ("b", day("2024-01-01"), 3),
            ("b", day("2024-01-02"), 3),
            ("c", day("2024-01-01"), 1),
        ],
        SCHEMA,
    )
    found = by_key(c.leaderboard(c.user_summary(days)), "username")
    ranks = {u: (r["rank_by_total"], r["rank_by_avg"], r["rank_by_consistency"]) for u, r in found.items()}
    assert ranks == {"a": (1, 1, 2), "b": (1, 2, 1), "c": (3, 3, 2)}
    assert {u: r["overall_score"] for u, r in found.items()} == {"a": 1.2, "b": 1.3, "c": 2.8}


def test_leaderboard_of_many_values_equals_plain_ranks(spark):
    days = samples.long_contributions(spark, "/root/testdata/sf0.01")
    users = c.user_summary(days)
    found = c.leaderboard(users).select("username", "rank_by_total")
    rank = F.rank().over(Window.orderBy(F.col("total_contributions").desc())).cast("bigint")
    plain = users.select("username", rank.alias("rank_by_total"))
    assert plain.exceptAll(found).count() == 0 and found.exceptAll(plain).count() == 0


def test_every_order_line_is_in_the_samples(spark):
    sf_dir = "/root/testdata/sf0.01"
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    copies = samples.duplicated_contributions(spark, sf_dir)
    assert copies.agg(F.sum("contribution_count")).first()[0] == lines.count()
    kept = samples.long_contributions(spark, sf_dir).agg(F.sum("contribution_count")).first()[0]
    assert kept == lines.filter("l_returnflag <> 'N'").count()


def test_totals_agree_across_grains(spark):
    days = samples.long_contributions(spark, "/root/testdata/sf0.001")

    def total(df, column="total_contributions"):
        return df.agg(F.sum(column)).first()[0]

    expected = total(days, "contribution_count")
    assert total(c.monthly(days)) == total(c.weekly(days)) == total(c.user_summary(days, AS_OF)) == expected
    assert total(c.activity_patterns(days)) == expected
    assert total(c.trends(c.monthly(days)), "monthly_contributions") == expected


def test_streaks_are_disjoint(spark):
    days = samples.dense_contributions(spark, "/root/testdata/sf0.01")
    found = c.streaks(days, samples.DENSE_AS_OF).orderBy("username", "streak_start").collect()
    for row in found:
        assert (row["streak_end"] - row["streak_start"]).days + 1 == row["streak_length_days"]
    for one, other in zip(found, found[1:]):
        if one["username"] == other["username"]:
            assert (other["streak_start"] - one["streak_end"]).days > 1
