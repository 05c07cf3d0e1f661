import random

import pytest
from helpers import by_key
from pyspark.sql import Window
from pyspark.sql import functions as F

from forgemeter.functions.rounding import rounded_ratio
from forgemeter.operators.ordering import with_ranks, with_row_number, with_running_total
from forgemeter.operators.quantiles import grouped_median
from forgemeter.operators.staging import dedup_contributions, key_pulls
from forgemeter.sources import samples

SF = "/root/testdata/sf0.01"


def test_row_number_with_ties_and_nulls(spark):
    pulls = samples.order_pulls(spark, SF).withColumn(
        "created_at", F.when(F.col("pr_id") % 7 != 0, F.col("created_at"))
    )
    numbered = key_pulls(pulls).select("pr_id", "primary_key")
    plain = pulls.select(
        "pr_id",
        F.row_number().over(Window.orderBy(F.col("created_at").asc_nulls_last(), "pr_id")).cast("bigint"),
    )
    assert numbered.exceptAll(plain).count() == 0 and numbered.count() == 15000


def test_one_value_for_a_third_of_the_rows(spark):
    rows = spark.range(3000).withColumn("k", F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id") % 17))
    numbered = with_row_number(rows, [F.col("k"), F.col("id")], "n")
    ranges = numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(ranges) == (1, 3000, 3000)
    assert numbered.filter((F.col("k") == 0) & (F.col("n") > 2000)).count() == 0


def test_running_total_of_weights(spark):
    rows = spark.range(1, 101).withColumn("w", F.col("id") * 2)
    found = by_key(with_running_total(rows, [F.col("id").desc()], "before", weight="w"), "id")
    assert found[100]["before"] == 0
    assert found[1]["before"] == sum(2 * i for i in range(2, 101))


def test_ranks_with_nulls_and_ties(spark):
    rows = spark.createDataFrame([("a", 5, 1.5), ("b", 5, None), ("c", None, 1.5), ("d", 7, 0.0)], "k string, x int, y double")
    found = by_key(with_ranks(rows, {"rx": "x", "ry": "y"}), "k")
    assert {k: (r["rx"], r["ry"]) for k, r in found.items()} == {"a": (2, 1), "b": (2, 4), "c": (4, 1), "d": (1, 3)}


def test_ranks_keep_numbers_apart_that_doubles_cannot(spark):
    rows = spark.createDataFrame([(1, 2**53, 0.5), (2, 2**53 + 1, 0.5), (3, 7, 0.25)], "k int, n bigint, d double")
    found = by_key(with_ranks(rows, {"rn": "n", "rd": "d"}), "k")
    assert {k: (r["rn"], r["rd"]) for k, r in found.items()} == {1: (2, 1), 2: (1, 1), 3: (3, 3)}


def test_median_agrees_with_percentile(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, (F.col("id") % 50).cast("string")).alias("g"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.hash("id"), F.lit(997)).cast("bigint")).alias("v"),
    )
    expected = by_key(rows.groupBy("g").agg(F.percentile("v", 0.5).alias("m")), "g")
    assert by_key(grouped_median(rows, "g", "v", "m"), "g") == expected


def test_empty_input(spark):
    none = spark.createDataFrame([], "k string, v bigint")
    assert with_row_number(none, [F.col("k")], "n").count() == 0
    assert with_ranks(none, {"r": "v"}).count() == 0
    assert grouped_median(none, "k", "v", "m").count() == 0


def test_dedup_keeps_the_first_arrival(spark):
    raw = spark.createDataFrame(
        [("a", 1, 5, 2), ("a", 1, 3, 1), ("b", 1, 7, 1)], "username string, date int, contribution_count int, at int"
    )
    first = by_key(dedup_contributions(raw, "at"), "username")
    assert {u: (r["contribution_count"], r["row_num"]) for u, r in first.items()} == {"a": (3, 1), "b": (7, 1)}
    assert by_key(dedup_contributions(raw), "username")["a"]["contribution_count"] == 5


def test_rounding_is_half_away_from_zero(spark):
    pairs = [(1125, 1000), (-1125, 1000), (1005, 1000), (2, 3), (-2, 3), (0, 5), (5, 0), (None, 5)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a bigint, b bigint")
    found = rows.select("i", rounded_ratio(F.col("a"), F.col("b")).alias("r")).orderBy("i").collect()
    assert [r["r"] for r in found] == [1.13, -1.13, 1.01, 0.67, -0.67, 0.0, None, None]


@pytest.mark.parametrize("buckets", [2, 3, 4_096])
def test_median_by_rounds_of_any_width(spark, buckets):
    rng = random.Random(buckets)
    groups = {
        None: [0],
        "two": [-(2**63), 2**63 - 1],
        "wide": [rng.randrange(-(2**62), 2**62) for _ in range(300)],
        "close": [10**15 + rng.randrange(5) for _ in range(301)],
        "ties": [7] * 200 + [9] * 200,
        "small": [rng.randrange(-40, 40) for _ in range(100)],
        "log": [2**i for i in range(63)] + [-(2**i) for i in range(60)],
    }
    rows = [(g, v) for g, values in groups.items() for v in [*values, None]] + [("none", None)]
    rng.shuffle(rows)
    found = by_key(grouped_median(spark.createDataFrame(rows, "g string, v bigint"), "g", "v", "m", buckets), "g")
    expected = {}
    for g, values in groups.items():
        ordered = sorted(values)
        low, high = ordered[(len(ordered) - 1) // 2], ordered[len(ordered) // 2]
        expected[g] = float(low + high) / 2
    assert {g: r["m"] for g, r in found.items()} == expected
