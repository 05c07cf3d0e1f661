"""Bitmaps of stored days."""

import datetime as dt
import random

import pytest
from helpers import day

from forgemeter.operators import day_bitmaps, ingest
from forgemeter.plans import runs
from forgemeter.session import path_exists, settle, touch
from forgemeter.sources import known
from forgemeter.sources.tables import RAW_CONTRIBUTIONS, read_table
from test_ingest import calendar, entry

ROWS = "username string, date date"
ANSWERS = "username string, range_seq bigint, http_status int, body string"


def random_days(seed, n=400):
    rng = random.Random(seed)
    edges = [day("2023-12-31"), day("2024-01-01"), day("2024-02-29"), day("2024-12-31"), day("2025-01-01")]
    picks = [dt.date(2023, 11, 1) + dt.timedelta(rng.randrange(500)) for _ in range(n)]
    return [(rng.choice(["u", "v", "é"]), d) for d in picks + edges + edges]


def test_bitmaps_hold_just_the_days(spark):
    rows = random_days(1)
    made = day_bitmaps.day_bitmaps(spark.createDataFrame(rows, ROWS))
    assert {len(r["bits"]) for r in made.collect()} == {day_bitmaps.YEAR_BYTES}
    assert sorted(map(tuple, day_bitmaps.dates(made).collect())) == sorted(set(rows))
    expected = {u: len({d for v, d in rows if v == u}) for u, _ in rows}
    assert {r["username"]: r["known_days"] for r in day_bitmaps.counts(made).collect()} == expected


def test_merging_and_membership(spark):
    first, second = random_days(2, 60), random_days(3, 60)
    a, b = (day_bitmaps.day_bitmaps(spark.createDataFrame(rows, ROWS)) for rows in (first, second))
    both = day_bitmaps.merged(a, b)
    assert sorted(map(tuple, day_bitmaps.dates(both).collect())) == sorted({*first, *second})
    probe = [*random_days(4, 200), ("nobody", day("2024-01-01"))]
    left = day_bitmaps.without_known(spark.createDataFrame(probe, ROWS), both)
    assert sorted(map(tuple, left.collect())) == sorted(r for r in probe if r not in {*first, *second})
    none = spark.createDataFrame([], ROWS)
    assert day_bitmaps.dates(day_bitmaps.day_bitmaps(none)).count() == 0


def load(spark, raw, user, *days, restate=False):
    body = calendar([entry(d, n) for d, n in days])
    runs.load_calendars(spark.createDataFrame([(user, 0, 200, body)], ANSWERS), raw, restate)


def stored(spark, raw):
    return sorted(tuple(r)[:3] for r in read_table(spark, RAW_CONTRIBUTIONS, raw).collect())


def check_known(spark, raw):
    rows = {(u, d) for u, d, _ in stored(spark, raw)}
    assert sorted(map(tuple, day_bitmaps.dates(known.known_days(spark, raw)).collect())) == sorted(rows)


def test_loads_keep_the_bitmaps_in_step(spark, tmp_path):
    raw = str(tmp_path / "raw")
    load(spark, raw, "u", ("2023-12-31", 1), ("2024-01-01", 2))
    check_known(spark, raw)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "raw" / "_known" / "year=2023").iterdir()}
    load(spark, raw, "v", ("2024-01-01", 3), ("2024-06-01", 4))
    load(spark, raw, "u", ("2024-01-01", 9), ("2024-01-02", 5))
    check_known(spark, raw)
    # Another year's bitmaps are as they were; the day known before kept its count.
    assert files == {p: p.stat().st_mtime_ns for p in (tmp_path / "raw" / "_known" / "year=2023").iterdir()}
    assert ("u", day("2024-01-01"), 2) in stored(spark, raw)
    load(spark, raw, "u", ("2024-01-01", 9), restate=True)
    assert ("u", day("2024-01-01"), 9) in stored(spark, raw)
    check_known(spark, raw)


@pytest.mark.parametrize("trouble", ["missing", "stale", "pending"])
def test_bitmaps_behind_the_rows_are_made_again(spark, tmp_path, trouble):
    raw = str(tmp_path / "raw")
    load(spark, raw, "u", ("2024-01-01", 1))
    more = spark.createDataFrame([("u", day("2024-02-02"), 7)], "username string, date date, contribution_count int")
    if trouble == "pending":
        # A load that wrote its rows and got no further.
        more.write.parquet(f"{raw}/_pending")
    else:
        more.write.mode("append").parquet(f"{raw}/month=2024-02-01")
        if trouble == "missing":
            (tmp_path / "raw" / "_known").rename(tmp_path / "aside")
        else:
            touch(spark, f"{raw}/{known.STALE}")
    # The day stored by the load cut short is known, so it keeps its count.
    load(spark, raw, "u", ("2024-02-02", 8), ("2024-02-03", 1))
    assert stored(spark, raw) == [("u", day("2024-01-01"), 1), ("u", day("2024-02-02"), 7), ("u", day("2024-02-03"), 1)]
    assert not path_exists(spark, f"{raw}/{known.STALE}")
    check_known(spark, raw)


def test_what_is_known_is_told_without_the_rows(spark, tmp_path):
    raw = str(tmp_path / "raw")
    load(spark, raw, "u", *[(f"2024-01-{d:02}", d) for d in range(1, 32)])
    users = spark.createDataFrame([("u",), ("w",)], "username string")
    ranges = runs.ranges_to_fetch(users, raw, day("2024-03-01"))
    batch = spark.createDataFrame([("u", day("2024-01-05"), 1, 1, 1)], f"{ROWS}, contribution_count int, arrival bigint, fetch bigint")
    fresh = ingest.new_days(settle(batch, "batch"), known.known_days(spark, raw))
    for df in (ranges, fresh, ingest.known_dates(known.known_days(spark, raw))):
        assert "month=" not in df._jdf.queryExecution().executedPlan().toString()
        assert all("/_known/" in f or "/batch" in f for f in df.inputFiles())
    assert sorted((r["username"], r["mode"]) for r in ranges.collect()) == [("u", "incremental"), ("w", "backfill"), ("w", "backfill")]
    assert fresh.count() == 0


def test_a_repeated_load_leaves_days_and_bitmaps(spark, tmp_path):
    raw = str(tmp_path / "raw")
    days = [("2023-12-31", 1), ("2024-01-01", 2)]

    def files():
        return {f: f.stat().st_mtime_ns for f in (tmp_path / "raw").rglob("*") if f.is_file()}

    load(spark, raw, "u", *days)
    before = files()
    load(spark, raw, "u", *days)
    load(spark, raw, "u", *days, restate=True)
    assert files() == before
    load(spark, raw, "u", ("2023-12-31", 5), restate=True)
    assert {f.parent.name for f in before if f not in files()} == {"month=2023-12-01"}
    check_known(spark, raw)
