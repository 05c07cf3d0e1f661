"""The two end-to-end runs: landed answers to raw table, staging, tables, tests."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.functions.calendar import as_date
from forgemeter.operators import enforce, ingest, month_states, staging
from forgemeter.operators.checks import Rule, Watch
from forgemeter.operators.upsert import finish_swap, upsert_into
from forgemeter.plans import contributions, pulls
from forgemeter.plans.rules import CONTRIBUTION_RULES, PULL_RULES, SOURCE_RULES
from forgemeter.plans.suite import rules_of, run_suite
from forgemeter.session import (
    in_parallel,
    list_names,
    path_exists,
    remove_path,
    scratch_scope,
    settle,
    settled_files,
    sized_session,
    stored_bytes,
    touch,
)
from forgemeter.sources.known import add_known, known_days, mark_if_interrupted, mark_stale
from forgemeter.sources.states import current_states
from forgemeter.sources.tables import (
    RAW_CONTRIBUTIONS,
    RAW_PULLS,
    TableSpec,
    contributions_since,
    ensure_table,
    read_table,
)


# Failed answers and refused rows, in folders of the raw table that readers skip.
QUARANTINE = "_quarantine"
REFUSED = "_refused"
QUARANTINED = "username string, range_seq bigint, http_status int, status string, body string"
QUARANTINED_PAGES = "repo_name string, seq bigint, status string, body string"
REFUSED_ROWS = "unit string, fetch bigint, arrival bigint, violation string, given string"

# A run writes its tables into a folder of its own, named by time; this file in
# it says that all of them are complete.
RUN = "run-"
COMPLETE = "_COMPLETE"


class FetchFailed(RuntimeError):
    """Answers that could not be loaded; all others were."""


class RowsRefused(RuntimeError):
    """Rows that break the table's declaration; all other users or repositories were loaded."""


# Loading --------------------------------------------------------------------


def load_pulls(pages: DataFrame, raw_path: str, strict: bool = True) -> None:
    """Parse landed pages and load their reviews, each repository's of a fetch all or none.

    A repository with an invalid review is left as it is and its reviews are kept
    aside (see ``refused``); answers that are no page are kept in the raw table's
    quarantine (see ``quarantined_pages``). Nobody else is held up. With
    ``strict`` either is reported as an error once all the rest is loaded.
    """
    spark = pages.sparkSession
    ensure_table(spark, RAW_PULLS, raw_path)
    finish_swap(spark, RAW_PULLS, raw_path)
    with scratch_scope(spark):
        # Written out parsed; the text is kept of the failed ones only.
        text = F.when(F.col("status") != "ok", F.col("body"))
        triaged = settle(ingest.triage_pages(pages).withColumn("body", text), "pages")
        failed = _set_aside(triaged, QUARANTINED_PAGES, raw_path)
        good, trouble = _whole_units(ingest.flatten_pages(triaged), RAW_PULLS, "repo_name", raw_path)
        upsert_into(good.withColumn("arrival", F.struct("fetch", "arrival")), RAW_PULLS, raw_path, "arrival")
    if strict and trouble:
        raise RowsRefused(f"{trouble}: see {raw_path}/{REFUSED}")
    if strict and failed:
        raise FetchFailed(f"{failed} answers are not a page of reviews: see {raw_path}/{QUARANTINE}")


def _whole_units(rows: DataFrame, spec: TableSpec, name: str, raw_path: str) -> tuple[DataFrame, str]:
    """Checked rows of the units without a violation, and what to report of the others.

    A unit is a user or a repository within one fetch: as one load after the
    other would, a good fetch is loaded though another one of the same unit is
    refused. All rows of a refused unit are kept aside as they came.
    """
    spark, unit = rows.sparkSession, [name, "fetch"]
    parsed = settle(rows, "parsed")
    checked = enforce.check_batch(parsed, spec)
    bad = settle(enforce.bad_units(checked, unit), "bad-units")
    units = bad.count()
    if not units:
        return enforce.accepted(checked), ""
    given = F.to_json(F.struct(*spec.column_names))
    asides = enforce.only_units(
        enforce.check_batch(parsed.withColumn("given", given), spec).withColumn("unit", F.col(name)), bad, unit
    ).select("unit", "fetch", "arrival", "violation", "given")
    asides.write.mode("append").parquet(f"{raw_path}/{REFUSED}")
    first = enforce.rejected(checked).agg(F.min("violation")).first()[0]
    good = enforce.without_units(checked, bad, unit).drop("violation")
    return good, f"rows of {units} {name} batches were refused, such as {first}"


def refused(spark: SparkSession, raw_path: str) -> DataFrame:
    """All rows of refused users or repositories met so far, as JSON of what came; ``violation`` where a row has one."""
    return _aside(spark, raw_path, REFUSED_ROWS, REFUSED)


def _set_aside(triaged: DataFrame, schema: str, raw_path: str) -> int:
    """Keep the failed answers in the quarantine; returns how many there are."""
    bad = triaged.filter("status <> 'ok'")
    found = bad.count()
    if found:
        columns = [part.split()[0] for part in schema.split(", ")]
        bad.select(*columns).write.mode("append").parquet(f"{raw_path}/{QUARANTINE}")
    return found


def load_calendars(calendars: DataFrame, raw_path: str, restate: bool = False, strict: bool = True) -> None:
    """Triage landed calendars and load the days that are new, each user's of a fetch all or none.

    Failed answers are kept with their status in the raw table's quarantine (see
    ``quarantined``), days of a user with an invalid one beside it (see
    ``refused``). With ``strict`` such a user, or one all of whose ranges failed,
    is reported as an error once everybody else's days are loaded. Days stored
    already are left as they are unless ``restate`` is set.
    """
    spark = calendars.sparkSession
    ensure_table(spark, RAW_CONTRIBUTIONS, raw_path)
    mark_if_interrupted(spark, raw_path)
    finish_swap(spark, RAW_CONTRIBUTIONS, raw_path)
    with scratch_scope(spark):
        # Written out: the steps below read the answers and days several times,
        # the JSON is parsed once.
        triaged = settle(ingest.triage_calendars(calendars), "answers")
        failed = ingest.failed_users(triaged).count() if _set_aside(triaged, QUARANTINED, raw_path) else 0
        trouble = _load_days(spark, triaged.drop("body"), raw_path, restate)
    if strict and trouble:
        raise RowsRefused(f"{trouble}: see {raw_path}/{REFUSED}")
    if strict and failed:
        raise FetchFailed(f"every range failed for {failed} users: see {raw_path}/{QUARANTINE}")


def quarantined(spark: SparkSession, raw_path: str) -> DataFrame:
    """Every failed calendar answer met so far, as landed, with its status; a repeated batch adds nothing."""
    return _aside(spark, raw_path, QUARANTINED)


def quarantined_pages(spark: SparkSession, raw_path: str) -> DataFrame:
    """The same for answers that are no page of reviews."""
    return _aside(spark, raw_path, QUARANTINED_PAGES)


def _aside(spark: SparkSession, raw_path: str, schema: str, folder: str = QUARANTINE) -> DataFrame:
    place = f"{raw_path}/{folder}"
    if not path_exists(spark, place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(place).distinct()


def _load_days(spark: SparkSession, triaged: DataFrame, raw_path: str, restate: bool) -> str:
    """Returns what to report of refused users."""
    with scratch_scope(spark):
        parsed = ingest.cast_counts(ingest.flatten_calendars(triaged))
        valid, trouble = _whole_units(parsed, RAW_CONTRIBUTIONS, "username", raw_path)
        files = settled_files(valid, "days")
        sized, _ = sized_session(spark, stored_bytes(spark, files))
        days = sized.read.schema(valid.schema).parquet(files)
        if not days.isEmpty():
            known = known_days(sized, raw_path)
            new = settle(ingest.new_days(days, known), "new-days")
            grows = not new.isEmpty()
            if grows:
                mark_stale(spark, raw_path)
            if restate:
                upsert_into(ingest.new_days(days, known, restate), RAW_CONTRIBUTIONS, raw_path, "arrival")
            elif grows:
                upsert_into(new, RAW_CONTRIBUTIONS, raw_path, "arrival")
            if grows:
                add_known(new, raw_path)
    return trouble


def ranges_to_fetch(users: DataFrame, raw_path: str, as_of: dt.date | None = None) -> DataFrame:
    """What to ask for next, for whatever lands the answers; ``users`` has ``username``."""
    spark = users.sparkSession
    ensure_table(spark, RAW_CONTRIBUTIONS, raw_path)
    mark_if_interrupted(spark, raw_path)
    finish_swap(spark, RAW_CONTRIBUTIONS, raw_path)
    return ingest.plan_ranges(users, known_days(spark, raw_path), as_of)


# Building -------------------------------------------------------------------


@contextmanager
def new_run(spark: SparkSession, out: str, *catalog_tables: str) -> Iterator[str]:
    """A folder for the tables of one run, complete all at once when the block ends.

    Until then ``latest_tables`` gives the run before, and so it does for good if
    the block fails. The last two complete runs are kept, so that whoever still
    reads the older one can finish; earlier ones go, with their entries
    ``<catalog table>_<run>``. Start times order the runs.
    """
    started = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    run = f"{RUN}{started}-{uuid.uuid4().hex[:8]}"
    try:
        yield f"{out}/{run}"
    except BaseException:
        _drop_run(spark, out, run, catalog_tables)
        raise
    touch(spark, f"{out}/{run}/{COMPLETE}")
    for old in _complete_runs(spark, out)[:-2]:
        _drop_run(spark, out, old, catalog_tables)


def in_catalog(table: str, folder: str) -> str:
    """The name of a run's own catalog table."""
    return f"{table}_{folder.rsplit('/', 1)[-1].replace('-', '_').lower()}"


def _complete_runs(spark: SparkSession, out: str) -> list[str]:
    runs = [n for n in list_names(spark, out) if n.startswith(RUN)]
    return sorted(n for n in runs if path_exists(spark, f"{out}/{n}/{COMPLETE}"))


def _drop_run(spark: SparkSession, out: str, run: str, catalog_tables: tuple[str, ...]) -> None:
    for table in catalog_tables:
        spark.sql(f"DROP TABLE IF EXISTS {in_catalog(table, run)}")
    remove_path(spark, f"{out}/{run}")


def latest_tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables of the last complete run; none before the first."""
    runs = _complete_runs(spark, out)
    if not runs:
        return {}
    folder = f"{out}/{runs[-1]}"
    return {n: spark.read.parquet(f"{folder}/{n}") for n in list_names(spark, folder) if n != COMPLETE}


def store(spark: SparkSession, df: DataFrame, out: str, name: str) -> DataFrame:
    """Write one table of a run and read it back."""
    df.write.parquet(f"{out}/{name}")
    return spark.read.schema(df.schema).parquet(f"{out}/{name}")


def store_bucketed(
    spark: SparkSession, df: DataFrame, place: str, name: str, key: str, sort: list[str], buckets: int
) -> DataFrame:
    """Write ``df`` to ``place``, hash-bucketed by ``key`` and registered in the catalog as ``name``.

    Groupings and windows by ``key`` on the returned table need no shuffle. Pass
    rows partitioned by ``key`` into ``buckets``, so that a task writes one file.
    """
    (
        df.write.bucketBy(buckets, key)
        .sortBy(*sort)
        .format("parquet")
        .option("path", place)
        .saveAsTable(name)
    )
    return spark.table(name)


class Tables:
    """The tables of one run: written, watched on the way for the row tests declared on them, and read back."""

    def __init__(self, spark: SparkSession, out: str, rules: Sequence[Rule]):
        self.spark, self.out, self.rules = spark, out, rules
        self.models: dict[str, DataFrame] = {}
        self.watched: dict[str, Watch] = {}

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` as it should be written."""
        self.watched[name] = Watch(df, rules_of(name, self.rules))
        return self.watched[name].rows

    def add(self, name: str, df: DataFrame) -> DataFrame:
        self.models[name] = store(self.spark, self.watch(name, df), self.out, name)
        return self.models[name]

    def build(self, tables: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        """Several at a time."""
        return in_parallel({name: partial(self._built, name, make) for name, make in tables.items()})

    def _built(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return self.add(name, make())

    def check(self, name: str, sources: Mapping[str, DataFrame] | None = None) -> None:
        """Store the results of all tests, those on ``sources`` too if given."""
        checked = {**self.models, **(sources or {})}
        store(self.spark, run_suite(checked, self.rules, bool(sources), self.watched), self.out, name)


def run_contributions(
    spark: SparkSession,
    raw_path: str,
    out: str,
    as_of: dt.date | None = None,
    buckets: int | None = None,
    staged_table: str = "contrib_staged",
) -> Mapping[str, DataFrame]:
    """Build staging and the eight daily-activity tables, then test them.

    Staging is bucketed by user once, as a catalog table named ``staged_table``
    and the run; the tables after it group by user. Three of them come from the
    states of the months instead, of which only those of changed months are made
    again, and the recent activity reads its few months from the raw table.
    """
    # A load cut short may have left months half swapped.
    mark_if_interrupted(spark, raw_path)
    finish_swap(spark, RAW_CONTRIBUTIONS, raw_path)
    outer = spark
    spark, partitions = sized_session(outer, stored_bytes(outer, raw_path))
    raw = read_table(spark, RAW_CONTRIBUTIONS, raw_path).drop(RAW_CONTRIBUTIONS.layout[0])
    with scratch_scope(spark), new_run(spark, out, staged_table) as out:
        # The load leaves one row per user and day, so no key has copies to
        # collapse before the shuffle, and a user has at most one row per
        # calendar day: one shuffle by user serves the dedup and the buckets.
        buckets = buckets or partitions
        by_user = raw.repartition(buckets, "username")
        made = Tables(spark, out, CONTRIBUTION_RULES)
        staged = made.models["contrib_staged"] = store_bucketed(
            spark,
            made.watch("contrib_staged", staging.dedup_contributions(by_user)),
            f"{out}/contrib_staged",
            in_catalog(staged_table, out),
            "username",
            ["username", "date"],
            buckets,
        )
        states = current_states(spark, raw_path, contributions.MIN_STREAK_DAYS)
        built = made.build(
            {
                "contrib_patterns": lambda: contributions.activity_patterns(staged),
                "contrib_monthly": lambda: month_states.monthly(states),
                "contrib_recent": lambda: contributions.recent_activity(
                    recent_days(spark, raw_path, as_of), as_of
                ),
                "contrib_streaks": lambda: month_states.streaks(states, contributions.MIN_STREAK_DAYS, as_of),
                "contrib_user_summary": lambda: month_states.user_summary(states, as_of),
                "contrib_weekly": lambda: contributions.weekly(staged),
            }
        )
        made.build(
            {
                "contrib_leaderboard": lambda: contributions.leaderboard(built["contrib_user_summary"]),
                "contrib_trends": lambda: contributions.trends(built["contrib_monthly"]),
            }
        )
        made.check("contrib_tests")
        tables = _tables_of(outer, out, [*made.models, "contrib_tests"])
    return {**tables, "contrib_staged": outer.table(in_catalog(staged_table, out))}


def recent_days(spark: SparkSession, raw_path: str, as_of: dt.date | None = None) -> DataFrame:
    """The staged rows the recent activity looks at; older month directories are not read."""
    first = F.date_sub(as_date(as_of), contributions.RECENT_DAYS)
    rows = contributions_since(read_table(spark, RAW_CONTRIBUTIONS, raw_path), first)
    # The windows by user then need no second shuffle.
    return staging.dedup_contributions(rows.drop(RAW_CONTRIBUTIONS.layout[0]).repartition("username"))


def _tables_of(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """A run's tables as tables of the caller's session."""
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def run_pulls(
    spark: SparkSession, raw_path: str, out: str, as_of: dt.date | None = None, sources: bool = False
) -> Mapping[str, DataFrame]:
    """Build staging, the rollup and the nine code-review tables, then test them.

    Numbering the reviews by creation time also stores them in that order, so
    the 90-day cut of ``pulls_recent`` skips most of the stored table by its
    row-group statistics.
    """
    finish_swap(spark, RAW_PULLS, raw_path)
    outer = spark
    spark, _ = sized_session(outer, stored_bytes(outer, raw_path))
    raw = read_table(spark, RAW_PULLS, raw_path).drop(RAW_PULLS.layout[0])
    with scratch_scope(spark), new_run(spark, out) as out:
        made = Tables(spark, out, [*PULL_RULES, *SOURCE_RULES])
        staged = made.add("pulls_staged", staging.key_pulls(raw))
        facts = store(spark, pulls.daily_rollup(pulls.review_facts(staged)), out, "pulls_rollup")
        built = made.build(
            {
                "pulls_patterns": lambda: pulls.activity_patterns(facts),
                "pulls_monthly": lambda: pulls.monthly(facts),
                "pulls_recent": lambda: pulls.recent_activity(staged, as_of),
                "pulls_repo_summary": lambda: pulls.repo_summary(facts, staged),
                "pulls_time_to_merge": lambda: pulls.time_to_merge(staged),
                "pulls_user_summary": lambda: pulls.user_summary(facts),
                "pulls_weekly": lambda: pulls.weekly(facts),
            }
        )
        made.build(
            {
                "pulls_leaderboard": lambda: pulls.leaderboard(built["pulls_user_summary"]),
                "pulls_trends": lambda: pulls.trends(built["pulls_monthly"]),
            }
        )
        made.check("pulls_tests", {"raw_pulls": raw} if sources else None)
        return _tables_of(outer, out, [*made.models, "pulls_tests"])
