import json

import pytest
from helpers import by_key, day, moment
from pyspark.sql import functions as F

from forgemeter.operators import enforce, ingest
from forgemeter.sources.payloads import LANDED_CALENDARS, LANDED_PAGES
from forgemeter.sources.tables import RAW_CONTRIBUTIONS, RAW_PULLS


def calendar(*weeks):
    found = {"contributionCalendar": {"weeks": [{"contributionDays": w} for w in weeks]}}
    return json.dumps({"data": {"user": {"contributionsCollection": found}}})


def entry(date, count):
    return {"date": date, "contributionCount": count}


def answers(spark, *rows):
    return spark.createDataFrame([(*r, None) for r in rows], LANDED_CALENDARS)


def test_pull_page(spark):
    body = json.dumps(
        [
            {"id": 1, "state": "closed", "created_at": "2024-01-01T02:03:04Z", "merged_at": None, "user": {"login": "u"}},
            {"id": 2, "user": None, "extra": [1]},
            {"id": 3, "state": "closed", "merged_at": "2024-01-02T00:00:00Z"},
        ]
    )
    pages = spark.createDataFrame(
        [
            (repo, 1, text, None)
            for repo, text in [
                ("o/r", body), ("o/s", '{"message": "Not Found"}'), ("o/t", "<html>"), ("o/u", "[]"), ("o/v", None)
            ]
        ],
        LANDED_PAGES,
    )
    checked = enforce.check_batch(ingest.parse_pull_pages(pages), RAW_PULLS)
    found = by_key(enforce.accepted(checked), "pr_id")
    assert set(found) == {1, 2, 3}
    assert found[1]["created_at"] == moment("2024-01-01T02:03:04") and found[1]["user_login"] == "u"
    assert found[2]["user_login"] is None and found[2]["state"] is None
    assert found[3]["merged_at"] == moment("2024-01-02T00:00:00")
    bad = {r["repo_name"] for r in ingest.bad_pull_pages(pages).collect()}
    assert bad == {"o/s", "o/t", "o/v"}


def test_triage(spark):
    good = calendar([entry("2024-01-01", 1)])
    rows = [
        ("u1", 0, 200, good),
        ("u2", 0, 500, good),
        ("u3", 0, None, None),
        ("u4", 0, 200, good[:-4]),
        ("u5", 0, 200, '{"errors": [{"message": "no"}], "data": {"user": null}}'),
        ("u6", 0, 200, '{"data": {"user": null}}'),
        ("u7", 0, 200, '{"data": null}'),
        ("u8", 0, 200, "[]"),
        ("u9", 0, 200, '{"errors": [], "data": {"user": {"contributionsCollection": {"contributionCalendar": {"weeks": []}}}}}'),
        ("u1", 1, 500, None),
        ("u10", 0, 200, '{"data": {"user": {}}}'),
        ("u11", 0, 200, '{"data": {"user": {"login": "u11"}}}'),
    ]
    triaged = ingest.triage_calendars(answers(spark, *rows))
    found = {(r["username"], r["range_seq"]): r["status"] for r in triaged.collect()}
    assert found[("u1", 0)] == "ok" and found[("u1", 1)] == "fetch_failed"
    assert found[("u2", 0)] == found[("u3", 0)] == "fetch_failed"
    assert found[("u4", 0)] == "bad_json"
    assert found[("u5", 0)] == "api_errors"
    assert found[("u6", 0)] == found[("u7", 0)] == "user_missing"
    assert found[("u8", 0)] != "ok"
    assert found[("u9", 0)] == "ok"
    assert found[("u10", 0)] == "user_missing" and found[("u11", 0)] == "ok"
    failed = {r["username"] for r in ingest.failed_users(triaged).collect()}
    assert failed == {"u2", "u3", "u4", "u5", "u6", "u7", "u8", "u10"}


def test_flatten_and_cast(spark):
    body = calendar(
        [entry("2024-01-01", 3), entry("2024-01-02", "4"), entry("2024-01-03", "x"), entry("2024-01-04", "3.7")],
        [entry("2024-01-05", 3.7), entry("2024-01-06", None), {"date": "2024-01-07"}, entry("", 1), entry(None, 1)],
        [entry("2024-01-08", True), entry("2024-01-09", 0)],
    )
    days = ingest.flatten_calendars(ingest.triage_calendars(answers(spark, ("u", 0, 200, body))))
    assert days.count() == 9
    found = by_key(ingest.cast_counts(days), "date")
    assert {d: r["contribution_count"] for d, r in found.items()} == {
        "2024-01-01": 3,
        "2024-01-02": 4,
        "2024-01-05": 3,
        "2024-01-08": 1,
        "2024-01-09": 0,
    }


def test_a_week_without_days_hides_no_other(spark):
    body = calendar([entry("2024-01-01", 3)]).replace('"weeks": [', '"weeks": [{"contributionDays": null}, {}, ')
    days = ingest.flatten_calendars(ingest.triage_calendars(answers(spark, ("u", 0, 200, body))))
    assert [r["date"] for r in days.collect()] == ["2024-01-01"]


def test_new_days(spark):
    stored = spark.createDataFrame([("u", day("2024-01-01"), 9)], RAW_CONTRIBUTIONS.schema())
    batch = spark.createDataFrame(
        [
            ("u", day("2024-01-01"), 1, 0, 0),
            ("u", day("2024-01-02"), 2, 1, 0),
            ("u", day("2024-01-02"), 3, 2, 0),
            ("v", day("2024-01-01"), 4, 0, 0),
        ],
        "username string, date date, contribution_count int, arrival bigint, fetch bigint",
    )
    kept = by_key(ingest.new_days(batch, stored), "username", "date")
    assert {k: r["contribution_count"] for k, r in kept.items()} == {("u", day("2024-01-02")): 3, ("v", day("2024-01-01")): 4}
    assert ingest.new_days(batch, stored, restate=True).count() == 3


def test_known_dates_are_text(spark):
    rows = [("u", day("2024-01-01"), 9), ("u", day("2024-01-01"), 8)]
    stored = spark.createDataFrame(rows, "username string, date date, n int")
    assert [tuple(r) for r in ingest.known_dates(stored).collect()] == [("u", "2024-01-01")]


def test_ranges(spark):
    users = spark.createDataFrame([("new",), ("old",)], "username string")
    stored = spark.range(40).select(
        F.lit("old").alias("username"), F.date_add(F.lit(day("2024-01-01")), F.col("id").cast("int")).alias("date")
    )
    rows = ingest.plan_ranges(users, stored, day("2025-03-07")).orderBy("username", "range_seq").collect()
    assert [(r["username"], r["mode"], str(r["range_start"]), str(r["range_end"])) for r in rows] == [
        ("new", "backfill", "2023-01-01", "2023-12-31"),
        ("new", "backfill", "2024-01-01", "2024-12-31"),
        ("new", "backfill", "2025-01-01", "2025-03-07"),
        ("old", "incremental", "2025-02-28", "2025-03-07"),
    ]
    early = ingest.plan_ranges(users, stored, day("2022-06-01")).collect()
    assert [r["username"] for r in early] == ["old"]


@pytest.fixture(scope="module")
def checked(spark):
    rows = [
        ("o/r", "1", "closed", "2024-01-01T00:00:00Z", None, "u"),
        (None, "2", "closed", None, None, "u"),
        ("o/r", "x", "closed", None, None, "u"),
        ("o/r", None, "closed", None, None, "u"),
        ("o/r", "5", "s" * 51, None, None, "u"),
        ("o/r", "6", None, "soon", None, "u"),
        ("r" * 256, "7", None, None, None, "u"),
        ("r" * 255, "8", None, None, None, None),
    ]
    names = RAW_PULLS.column_names
    return enforce.check_batch(
        spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)), RAW_PULLS
    )


def test_violations(checked):
    assert sorted(r["violation"] for r in enforce.rejected(checked).collect()) == [
        "created_at: not a timestamp_ntz",
        "pr_id: missing",
        "pr_id: not a bigint",
        "repo_name: longer than 255",
        "repo_name: missing",
        "state: longer than 50",
    ]
    valid = enforce.accepted(checked)
    assert {r["pr_id"] for r in valid.collect()} == {1, 8}
    assert [f.dataType for f in valid.schema] == [f.dataType for f in RAW_PULLS.schema()]


def test_require_valid_fails_the_job(checked):
    with pytest.raises(Exception, match="missing|longer|not a"):
        enforce.require_valid(checked).collect()
