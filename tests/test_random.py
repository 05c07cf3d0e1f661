"""Random rows against plain Python, many groups per job."""

import datetime as dt
import random
from itertools import groupby

from helpers import by_key

from forgemeter.operators.blocks import neighbour_window
from forgemeter.operators.upsert import upsert
from forgemeter.plans import contributions as c
from forgemeter.sources.tables import RAW_CONTRIBUTIONS, RAW_PULLS
from pyspark.sql import functions as F

START = dt.date(2024, 1, 1)
DAYS = "username string, date date, contribution_count int"


def random_days(seed, users=60, span=80):
    rng = random.Random(seed)
    rows = []
    for u in range(users):
        density = rng.random()
        for d in range(span):
            if rng.random() < density:
                rows.append((f"u{u}", START + dt.timedelta(days=d), rng.choice([0, 0, 1, 2, 5])))
    rng.shuffle(rows)
    return rows


def python_streaks(rows):
    found = []
    for user, group in groupby(sorted(r for r in rows if r[2] > 0), key=lambda r: r[0]):
        run = []
        for row in [*group, None]:
            if run and (row is None or (row[1] - run[-1][1]).days > 1):
                if len(run) >= 3:
                    found.append((user, run[0][1], run[-1][1], len(run), sum(r[2] for r in run)))
                run = []
            if row:
                run.append(row)
    return sorted(found)


def test_streaks(spark):
    rows = random_days(1)
    found = c.streaks(spark.createDataFrame(rows, DAYS), START)
    picked = found.select("username", "streak_start", "streak_end", "streak_length_days", "streak_total_contributions")
    assert sorted(tuple(r) for r in picked.collect()) == python_streaks(rows) != []


def test_rolling_sums(spark):
    rows = random_days(2)
    as_of = START + dt.timedelta(days=79)
    found = by_key(c.recent_activity(spark.createDataFrame(rows, DAYS), as_of), "username", "date")
    assert len(found) == len(rows)
    for user, group in groupby(sorted(rows), key=lambda r: r[0]):
        days = list(group)
        for i, (_, date, _) in enumerate(days):
            row = found[(user, date)]
            week, month = [r[2] for r in days[max(0, i - 6) : i + 1]], [r[2] for r in days[max(0, i - 29) : i + 1]]
            assert (row["contributions_last_7_days"], row["contributions_last_30_days"]) == (sum(week), sum(month))
            assert row["avg_contributions_last_30_days"] == sum(month) / len(month)


def test_loads_in_sequence(spark):
    rng = random.Random(3)
    expected, target = {}, spark.createDataFrame([], RAW_CONTRIBUTIONS.schema())
    for _ in range(3):
        batch = [
            (f"u{rng.randrange(8)}", START + dt.timedelta(days=rng.randrange(10)), rng.randrange(100), i)
            for i in range(60)
        ]
        expected |= {(u, d): n for u, d, n, _ in batch}
        rng.shuffle(batch)
        target = upsert(target, spark.createDataFrame(batch, DAYS + ", seq bigint"), RAW_CONTRIBUTIONS, "seq")
    assert {k: r["contribution_count"] for k, r in by_key(target, "username", "date").items()} == expected


def test_neighbour_frames_of_any_block_size(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), i, rng.randrange(50)) for i in range(400)]
    frame = spark.createDataFrame(rows, "k string, id int, v int")

    def build(window):
        return {
            "around": F.sum("v").over(window.rowsBetween(-3, 2)),
            "following": F.lead("v", 2).over(window),
        }

    expected = {}
    for key in {r[0] for r in rows}:
        group = [r for r in rows if r[0] == key]
        for i, (_, number, _) in enumerate(group):
            ahead = group[i + 2][2] if i + 2 < len(group) else None
            expected[number] = (sum(r[2] for r in group[max(0, i - 3) : i + 3]), ahead)
    for block_rows in (3, 7, 64, 1000):
        split = neighbour_window(frame, ["k"], [F.col("id")], build, before=3, after=2, block_rows=block_rows)
        found = {i: (r["around"], r["following"]) for i, r in by_key(split, "id").items()}
        assert found == expected, block_rows


def test_a_later_row_replaces_a_whole_earlier_one(spark):
    columns = ", ".join(f"{x.name} {x.type}" for x in RAW_PULLS.columns)
    rng = random.Random(5)
    batch = [
        (f"r{rng.randrange(3)}", rng.randrange(20), rng.choice(["open", "closed", None]), None, None, rng.choice(["u", None]), i)
        for i in range(200)
    ]
    expected = {row[1]: row[:6] for row in batch}
    empty = spark.createDataFrame([], columns)
    found = upsert(empty, spark.createDataFrame(batch, columns + ", seq int"), RAW_PULLS, "seq")
    assert {r["pr_id"]: tuple(r) for r in found.collect()} == expected
