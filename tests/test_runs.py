import json
import os

import pytest
from helpers import by_key, day, moment

from forgemeter.operators import staging
from forgemeter.plans import contributions, runs
from forgemeter.session import in_parallel, scratch_path, scratch_scope, settle, sized_session, stored_bytes
from forgemeter.sources import samples
from forgemeter.sources.tables import RAW_CONTRIBUTIONS, RAW_PULLS, read_table
from forgemeter.streaming.landing import drain_calendars, drain_pulls
from test_ingest import calendar, entry

SF = "/root/testdata/sf0.001"


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def answer(user, body, seq=0, status=200):
    return {"username": user, "range_seq": seq, "http_status": status, "body": body}


def test_each_run_loads_what_landed_since(spark, tmp_path):
    landing, raw, state = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "state")

    def drain(**options):
        drain_calendars(spark, str(landing), raw, state, **options).awaitTermination()
        stored = by_key(read_table(spark, RAW_CONTRIBUTIONS, raw), "username", "date")
        return {(u, str(d)): r["contribution_count"] for (u, d), r in stored.items()}

    land(landing, "1.json", [answer("u", calendar([entry("2024-01-30", 1), entry("2024-01-31", 2)]))])
    assert drain() == {("u", "2024-01-30"): 1, ("u", "2024-01-31"): 2}
    # A stored day keeps its count, a new one is added.
    land(landing, "2.json", [answer("u", calendar([entry("2024-01-31", 7), entry("2024-02-01", 3)]))])
    first = drain()
    assert first == {("u", "2024-01-30"): 1, ("u", "2024-01-31"): 2, ("u", "2024-02-01"): 3}
    assert drain() == first
    # Restating lets the new count through.
    land(landing, "3.json", [answer("u", calendar([entry("2024-01-31", 7)])), answer("u", None, 1, 500)])
    assert drain(restate=True)[("u", "2024-01-31")] == 7


def test_ranges_follow_what_is_stored(spark, tmp_path):
    raw = str(tmp_path / "raw")
    users = spark.createDataFrame([("u",), ("v",)], "username string")
    assert runs.ranges_to_fetch(users, raw, day("2024-03-01")).count() == 4
    january = calendar([entry(f"2024-01-{d:02}", d) for d in range(1, 32)])
    answers = spark.createDataFrame(
        [("u", 0, 200, january)], "username string, range_seq bigint, http_status int, body string"
    )
    runs.load_calendars(answers, raw)
    planned = runs.ranges_to_fetch(users, raw, day("2024-03-01")).collect()
    assert sorted((r["username"], r["mode"]) for r in planned) == [
        ("u", "incremental"),
        ("v", "backfill"),
        ("v", "backfill"),
    ]


def test_a_user_without_any_answer_is_reported_and_kept_aside(spark, tmp_path):
    rows = [("u", 0, 200, calendar([entry("2024-01-01", 1)])), ("gone", 0, 200, '{"data": {"user": null}}')]
    answers = spark.createDataFrame(rows, "username string, range_seq bigint, http_status int, body string")
    with pytest.raises(runs.FetchFailed, match="1 users"):
        runs.load_calendars(answers, str(tmp_path / "strict"))
    runs.load_calendars(answers, str(tmp_path / "lenient"), strict=False)
    for place in ("strict", "lenient"):
        assert read_table(spark, RAW_CONTRIBUTIONS, str(tmp_path / place)).count() == 1
        aside = runs.quarantined(spark, str(tmp_path / place)).collect()
        assert [(r["username"], r["status"], r["body"]) for r in aside] == [("gone", "user_missing", rows[1][3])]
    runs.load_calendars(answers, str(tmp_path / "lenient"), strict=False)
    assert runs.quarantined(spark, str(tmp_path / "lenient")).count() == 1


ANSWERS = "username string, range_seq bigint, http_status int, body string"


@pytest.mark.parametrize("strict", [True, False])
def test_a_bad_day_keeps_out_its_user_only(spark, tmp_path, strict):
    raw = str(tmp_path / "raw")
    rows = [
        ("u", 0, 200, calendar([entry("2024-01-01", 2**31), entry("2024-01-02", 5)])),
        ("v", 0, 200, calendar([entry("2024-01-01", 3)])),
        (None, 0, 200, calendar([entry("2024-01-01", 4)])),
        ("w" * 256, 0, 200, calendar([entry("2024-01-01", 6)])),
    ]
    answers = spark.createDataFrame(rows, ANSWERS)
    for _ in range(2):
        if strict:
            with pytest.raises(runs.RowsRefused, match="3 username batches were refused, such as contribution_count: not a int"):
                runs.load_calendars(answers, raw)
        else:
            runs.load_calendars(answers, raw, strict=False)
    stored = [tuple(r)[:3] for r in read_table(spark, RAW_CONTRIBUTIONS, raw).collect()]
    assert stored == [("v", day("2024-01-01"), 3)]
    aside = {(r["unit"], json.loads(r["given"])["date"]): r["violation"] for r in runs.refused(spark, raw).collect()}
    assert aside == {
        ("u", "2024-01-01"): "contribution_count: not a int",
        ("u", "2024-01-02"): None,
        (None, "2024-01-01"): "username: missing",
        ("w" * 256, "2024-01-01"): "username: longer than 255",
    }
    assert runs.refused(spark, raw).count() == 4
    assert runs.refused(spark, str(tmp_path / "none")).count() == 0


def test_a_bad_fetch_leaves_the_users_other_fetches(spark, tmp_path):
    raw = str(tmp_path / "raw")
    rows = [
        ("u", 0, 200, calendar([entry("2024-01-01", 1)]), moment("2024-01-05")),
        ("u", 0, 200, calendar([entry("2024-01-02", 2), entry("2024-01-03", 2**31)]), moment("2024-01-06")),
        ("u", 0, 200, calendar([entry("2024-01-04", 4)]), moment("2024-01-07")),
    ]
    answers = spark.createDataFrame(rows, f"{ANSWERS}, fetched_at timestamp")
    runs.load_calendars(answers, raw, strict=False)
    stored = sorted(tuple(r)[1:3] for r in read_table(spark, RAW_CONTRIBUTIONS, raw).collect())
    assert stored == [(day("2024-01-01"), 1), (day("2024-01-04"), 4)]


def test_a_bad_review_keeps_out_its_repository_only(spark, tmp_path):
    raw = str(tmp_path / "raw")
    bad = json.dumps([{"id": 1, "state": "closed"}, {"state": "closed"}])
    rows = [("o/r", 0, bad), ("o/r", 1, '[{"id": 2}]'), ("o/s", 0, '[{"id": 3}]'), (None, 0, '[{"id": 4}]')]
    pages = spark.createDataFrame(rows, "repo_name string, seq bigint, body string")
    with pytest.raises(runs.RowsRefused, match="2 repo_name batches were refused, such as pr_id: missing"):
        runs.load_pulls(pages, raw)
    assert [r["pr_id"] for r in read_table(spark, RAW_PULLS, raw).collect()] == [3]
    aside = sorted((r["unit"] or "", r["violation"] or "") for r in runs.refused(spark, raw).collect())
    assert aside == [("", "repo_name: missing"), ("o/r", ""), ("o/r", ""), ("o/r", "pr_id: missing")]


def test_a_stream_goes_on_after_a_bad_row(spark, tmp_path):
    landing, raw, state = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "state")

    def stored():
        drain_calendars(spark, str(landing), raw, state).awaitTermination()
        return sorted(tuple(r)[:3] for r in read_table(spark, RAW_CONTRIBUTIONS, raw).collect())

    bad = calendar([entry("2024-01-01", 2**40)])
    land(landing, "1.json", [answer("u", bad), answer("v", calendar([entry("2024-01-01", 1)]))])
    assert stored() == [("v", day("2024-01-01"), 1)]
    land(landing, "2.json", [answer("u", calendar([entry("2024-01-02", 2)]))])
    assert stored() == [("u", day("2024-01-02"), 2), ("v", day("2024-01-01"), 1)]
    assert runs.refused(spark, raw).count() == 1


def test_an_answer_that_is_no_page_is_reported_and_kept_aside(spark, tmp_path):
    rows = [("o/r", 0, '[{"id": 1}]'), ("o/s", 0, '{"message": "Not Found"}')]
    pages = spark.createDataFrame(rows, "repo_name string, seq bigint, body string")
    with pytest.raises(runs.FetchFailed, match="1 answers are not a page"):
        runs.load_pulls(pages, str(tmp_path / "strict"))
    for _ in range(2):
        runs.load_pulls(pages, str(tmp_path / "lenient"), strict=False)
    for place in ("strict", "lenient"):
        assert read_table(spark, RAW_PULLS, str(tmp_path / place)).count() == 1
        aside = runs.quarantined_pages(spark, str(tmp_path / place)).collect()
        assert [tuple(r) for r in aside] == [("o/s", 0, "not_a_page", rows[1][2])]
    runs.load_pulls(pages.limit(0), str(tmp_path / "empty"))
    assert runs.quarantined_pages(spark, str(tmp_path / "empty")).count() == 0


def _fetches():
    """Three fetches of overlapping days for two users, oldest first; one has no answer in the second."""
    for number in range(3):
        days = [entry(f"2024-03-{d:02}", 100 * number + d) for d in range(1 + 2 * number, 7 + 2 * number)]
        at = f"2024-03-{10 + number}T00:00:00Z"
        rows = [answer("u", calendar(days)), answer("v", calendar(days[::-1]), status=500 if number == 1 else 200)]
        yield [{**r, "fetched_at": at} for r in rows]


@pytest.mark.parametrize("restate", [True, False])
def test_a_backlog_equals_load_after_load(spark, tmp_path, restate):
    fetches = list(_fetches())

    def load(batches, place):
        for rows in batches:
            land(tmp_path / place, f"{id(rows)}.json", rows)
            drain_calendars(
                spark, str(tmp_path / place), str(tmp_path / f"raw-{place}"), str(tmp_path / f"state-{place}"), restate
            ).awaitTermination()
        return sorted(map(tuple, read_table(spark, RAW_CONTRIBUTIONS, str(tmp_path / f"raw-{place}")).collect()))

    one_by_one = load(fetches, "steps")
    assert len(one_by_one) == 20
    assert load([sum(fetches, [])], "once") == one_by_one
    assert load([sum(fetches[::-1], [])], "backwards") == one_by_one


def test_pages_of_a_backlog_in_any_order(spark, tmp_path):
    def page(state, at):
        return ("o/r", 1, json.dumps([{"id": 1, "state": state}]), at)

    columns = "repo_name string, seq bigint, body string, fetched_at timestamp"
    old, new = moment("2024-01-01"), moment("2024-01-02")
    batches = [
        [page("open", old), page("closed", new)],
        [page("closed", new), page("open", old)],
        # Nothing tells which is newer: the same one wins either way.
        [page("open", new), page("closed", new)],
        [page("closed", new), page("open", new)],
    ]
    found = []
    for i, rows in enumerate(batches):
        raw = str(tmp_path / str(i))
        runs.load_pulls(spark.createDataFrame(rows, columns).repartition(2), raw)
        found.append(read_table(spark, RAW_PULLS, raw).first()["state"])
    assert found[:2] == ["closed", "closed"] and found[2] == found[3]


def test_pulls_from_landing_to_tests(spark, tmp_path):
    landing, raw, out = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "out")
    pulls = samples.event_pulls(spark, SF)
    samples.landed_pages(pulls).write.json(landing)
    drain_pulls(spark, landing, raw, str(tmp_path / "state")).awaitTermination()
    assert read_table(spark, RAW_PULLS, raw).count() == pulls.count()
    models = runs.run_pulls(spark, raw, out, samples.DENSE_AS_OF, sources=True)
    assert len(models) == 11
    tests = by_key(models["pulls_tests"], "model", "column", "test")
    failing = {k for k, r in tests.items() if r["status"] == "fail"}
    # The deleted accounts have no author.
    assert len(tests) == len(runs.PULL_RULES) + 2
    assert failing and all(column == "user_login" and test == "not_null" for _, column, test in failing)


def test_scratch_is_removed_on_success_and_kept_on_failure(spark):
    rows = spark.range(5)
    with scratch_scope(spark):
        settled = settle(rows, "rows")
        inside = in_parallel({"a": lambda: settle(rows, "more"), "b": lambda: settle(rows, "rest")})
        folder = os.path.dirname(scratch_path(spark, "x"))
        assert settled.count() == inside["a"].count() == 5
        assert len(os.listdir(folder)) == 3
    assert not os.path.exists(folder)
    with pytest.raises(ValueError), scratch_scope(spark):
        settle(rows, "rows")
        folder = os.path.dirname(scratch_path(spark, "x"))
        raise ValueError
    assert len(os.listdir(folder)) == 1
    assert "scope-" not in scratch_path(spark, "x")


def test_shuffles_follow_the_bytes(spark, tmp_path, monkeypatch):
    path, key = str(tmp_path / "rows"), "spark.sql.shuffle.partitions"
    spark.range(1000).write.parquet(path)
    before = spark.conf.get(key)
    sized, partitions = sized_session(spark, stored_bytes(spark, path))
    assert partitions == int(before) and sized.conf.get(key) == before
    monkeypatch.setattr("forgemeter.session.PARTITION_BYTES", 100)
    sized, partitions = sized_session(spark, stored_bytes(spark, path))
    assert partitions > int(before) and sized.conf.get(key) == str(partitions)
    assert sized.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert spark.conf.get(key) == before
    plan = sized.read.parquet(path).groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert f", {partitions})" in plan


def test_a_failed_run_leaves_the_tables_before_it(spark, tmp_path):
    out = str(tmp_path / "out")
    assert runs.latest_tables(spark, out) == {}

    def build(n):
        with runs.new_run(spark, out) as folder:
            runs.store(spark, spark.range(n), folder, "numbers")
            if n == 3:
                raise ValueError
        return folder

    build(1), build(2)
    with pytest.raises(ValueError):
        build(3)
    assert runs.latest_tables(spark, out)["numbers"].count() == 2
    assert len(os.listdir(out)) == 2
    build(4)
    assert runs.latest_tables(spark, out)["numbers"].count() == 4
    assert len(os.listdir(out)) == 2


def test_a_run_after_an_interrupted_load_has_every_month(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    days = samples.dense_contributions(spark, SF)
    runs.load_calendars(samples.landed_calendars(days), raw)
    # A load that got as far as its pending rows.
    later = days.selectExpr("username", "add_months(date, 1) AS date", "contribution_count")
    later.distinct().dropDuplicates(["username", "date"]).write.parquet(f"{raw}/_pending")
    models = runs.run_contributions(spark, raw, out, samples.DENSE_AS_OF, staged_table="staged_for_swap")
    assert models["contrib_monthly"].select("month_start").distinct().count() == 2
    assert runs.latest_tables(spark, out)["contrib_monthly"].count() == models["contrib_monthly"].count()


def test_recent_days_open_only_their_months(spark, tmp_path):
    raw = tmp_path / "raw"
    body = calendar([entry(f"2023-{m:02}-15", m) for m in range(1, 13)])
    rows = [("u", 0, 200, body)]
    answers = spark.createDataFrame(rows, "username string, range_seq bigint, http_status int, body string")
    runs.load_calendars(answers, str(raw))
    before = contributions.recent_activity(read_table(spark, RAW_CONTRIBUTIONS, str(raw)), day("2023-12-20")).collect()
    # Older months cannot even be opened.
    for month in raw.glob("month=2023-0[1-8]-01"):
        for file in month.glob("*.parquet"):
            (month / f".{file.name}.crc").unlink(missing_ok=True)
            file.write_text("no parquet")
    found = contributions.recent_activity(runs.recent_days(spark, str(raw), day("2023-12-20")), day("2023-12-20"))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(found.collect()) == sorted(before) and len(before) == 3


def test_staging_by_user_takes_one_shuffle(spark):
    raw = samples.duplicated_contributions(spark, SF)
    plan = settle(raw, "raw").repartition(4, "username").transform(staging.dedup_contributions)
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_contributions_from_raw_to_tests(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    days = samples.dense_contributions(spark, SF)
    runs.load_calendars(samples.landed_calendars(days), raw)
    models = runs.run_contributions(spark, raw, out, samples.DENSE_AS_OF, staged_table="staged_for_test")
    assert {r["status"] for r in models["contrib_tests"].collect()} == {"pass"}
    expected = contributions.streaks(days, samples.DENSE_AS_OF)
    assert models["contrib_streaks"].exceptAll(expected).count() == 0
    assert models["contrib_streaks"].count() == expected.count() == 52
    # Staging is bucketed by user: what groups by user moves no row.
    for table in (contributions.monthly, contributions.user_summary, contributions.weekly):
        plan = table(models["contrib_staged"])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, table.__name__
    streaks = contributions.streaks(models["contrib_staged"], day("2024-01-31"))
    assert "Exchange" not in streaks._jdf.queryExecution().executedPlan().toString()
