"""States of months against the tables made from all days."""

import datetime as dt
import random

import pytest

from forgemeter.operators import month_states
from forgemeter.plans import contributions, runs
from forgemeter.sources import states
from forgemeter.sources.tables import RAW_CONTRIBUTIONS, read_table
from test_ingest import calendar, entry

ROWS = "username string, date date, contribution_count int"
ANSWERS = "username string, range_seq bigint, http_status int, body string"
AS_OF = dt.date(2024, 5, 1)
SHORTEST = contributions.MIN_STREAK_DAYS


def random_days(seed):
    """Long runs over ends of months, gaps, zero days, a whole month, single days, one user with one day."""
    rng = random.Random(seed)
    rows = {}
    for user in ("u", "v", "w"):
        at = dt.date(2023, 11, rng.randrange(1, 28))
        while at < AS_OF:
            for _ in range(rng.choice([1, 2, 3, 5, 40, 70])):
                rows[user, at] = rng.choice([0, 1, 5, 5, 5, 5, 5, 5, 1_000_000_000])
                at += dt.timedelta(1)
            at += dt.timedelta(rng.choice([1, 2, 10]))
    rows["x", dt.date(2024, 1, 31)] = 7
    for i in range(60):
        rows["y", dt.date(2024, 1, 31) + dt.timedelta(i)] = 1
    return [(user, at, n) for (user, at), n in sorted(rows.items())]


def rounded(df):
    return sorted(
        tuple(round(v, 6) if isinstance(v, float) else v for v in row.asDict().values()) for row in df.collect()
    )


def check(states_, staged):
    assert rounded(month_states.monthly(states_)) == rounded(contributions.monthly(staged))
    assert rounded(month_states.streaks(states_, SHORTEST, AS_OF)) == rounded(contributions.streaks(staged, AS_OF))
    merged, whole = month_states.user_summary(states_, AS_OF), contributions.user_summary(staged, AS_OF)
    assert merged.columns == whole.columns
    for found, expected in zip(rounded(merged), rounded(whole), strict=True):
        for a, b in zip(found, expected, strict=True):
            # The deviation of all days is the one in floating point.
            assert a == (pytest.approx(b, rel=1e-9) if isinstance(b, float) else b)


@pytest.mark.parametrize("seed", range(3))
def test_merged_states_equal_the_tables_of_all_days(spark, seed):
    staged = spark.createDataFrame(random_days(seed), ROWS)
    made = month_states.month_states(staged, SHORTEST)
    assert made.schema.simpleString() == spark.createDataFrame([], month_states.SCHEMA).schema.simpleString()
    check(made, staged)
    check(month_states.month_states(staged.limit(0), SHORTEST), staged.limit(0))


def test_deviations_are_exact_where_doubles_cancel(spark):
    counts = [2_000_000_000, 2_000_000_001, 2_000_000_002] * 20
    rows = [("u", dt.date(2024, 1, 1) + dt.timedelta(i), n) for i, n in enumerate(counts)]
    made = month_states.month_states(spark.createDataFrame(rows, ROWS), SHORTEST)
    row = month_states.user_summary(made, AS_OF).first()
    assert abs(row["stddev_daily_contributions"] - (40 / 59) ** 0.5) < 1e-15


def load(spark, raw, rows, restate=False):
    by_user = {}
    for user, at, n in rows:
        by_user.setdefault(user, []).append(entry(str(at), n))
    answers = [(user, 0, 200, calendar(entries)) for user, entries in by_user.items()]
    runs.load_calendars(spark.createDataFrame(answers, ANSWERS), raw, restate)


def test_a_load_of_one_month_remakes_that_month(spark, tmp_path):
    raw, rows = str(tmp_path / "raw"), random_days(7)
    february = [r for r in rows if (r[1].year, r[1].month) == (2024, 2)]
    load(spark, raw, [r for r in rows if r not in february])

    def made():
        current = states.current_states(spark, raw, SHORTEST)
        check(current, read_table(spark, RAW_CONTRIBUTIONS, raw).select("username", "date", "contribution_count"))
        folder = tmp_path / "raw" / states.STATES
        return {m.name: sorted((f.name, f.stat().st_mtime_ns) for f in m.iterdir()) for m in folder.glob("month=*")}

    first = made()
    assert states.months_behind(spark, raw) == {} and made() == first
    load(spark, raw, february)
    assert list(states.months_behind(spark, raw)) == ["2024-02-01"]
    second = made()
    assert {m: f for m, f in second.items() if m != "month=2024-02-01"} == first
    # A count that was restated changes its month.
    load(spark, raw, [("u", dt.date(2024, 1, 1), 12)], restate=True)
    third = made()
    assert {m for m in third if third[m] != second[m]} == {"month=2024-01-01"}


def test_no_states_of_an_empty_table(spark, tmp_path):
    raw = str(tmp_path / "raw")
    runs.load_calendars(spark.createDataFrame([], ANSWERS), raw)
    assert states.current_states(spark, raw, SHORTEST).count() == 0
