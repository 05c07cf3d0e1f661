import pytest
from helpers import by_key

from forgemeter.operators import checks
from forgemeter.operators.checks import Rule, check_model, duplicated_values
from forgemeter.plans import presentation
from forgemeter.plans.rules import ALL_RULES, CONTRIBUTION_RULES, PULL_RULES, SOURCE_RULES
from forgemeter.plans.suite import run_suite


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [("a", "open"), ("a", "closed"), (None, "draft"), (None, "draft"), ("b", "locked"), ("c", None)],
        "k string, state string",
    )


RULES = [
    Rule("m", "k", "not_null"),
    Rule("m", "k", "unique"),
    Rule("m", "state", "not_null"),
    Rule("m", "state", "accepted_values", ("open", "closed")),
]


def test_counts_per_rule(rows):
    found = by_key(check_model(rows, RULES), "column", "test")
    assert {k: (r["failures"], r["status"]) for k, r in found.items()} == {
        ("k", "not_null"): (2, "fail"),
        ("k", "unique"): (1, "fail"),
        ("state", "not_null"): (1, "fail"),
        ("state", "accepted_values"): (2, "fail"),
    }
    assert [tuple(r) for r in duplicated_values(rows, "k").collect()] == [("a", 2)]


def test_an_empty_table_passes(rows):
    assert {r["status"] for r in check_model(rows.limit(0), RULES).collect()} == {"pass"}


def test_bad_rules():
    for bad in (("k", "positive", ()), ("k", "accepted_values", ()), ("k", "unique", ("a",))):
        with pytest.raises(ValueError):
            Rule("m", *bad)


def test_declared_rules():
    tests = [r.test for r in ALL_RULES]
    assert (len(tests), tests.count("not_null"), tests.count("unique"), tests.count("accepted_values")) == (62, 52, 6, 4)
    assert len(CONTRIBUTION_RULES) + len(PULL_RULES) == 60 and len(SOURCE_RULES) == 2


def test_every_table_has_a_rule():
    assert {r.model for r in CONTRIBUTION_RULES + PULL_RULES} == {*presentation.SHOW_ORDER, "contrib_staged", "pulls_staged"}


def test_source_rules_run_on_request(spark):
    raw = spark.createDataFrame([(1,), (1,)], "pr_id bigint")
    staged = spark.createDataFrame([("u",)], "user_login string")
    models = {"raw_pulls": raw, "pulls_patterns": staged}
    assert run_suite(models, ALL_RULES).count() == 1
    found = by_key(run_suite(models, ALL_RULES, sources=True), "model", "test")
    assert found[("raw_pulls", "unique")]["failures"] == 1
    with pytest.raises(ValueError):
        run_suite({"other": raw}, ALL_RULES)


def test_show_order_puts_nulls_as_largest(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "username string, days int")
    rows = rows.selectExpr("username", "date_add(date'2024-01-01', days) AS month_start")
    shown = presentation.show_order("contrib_monthly", rows)
    assert [r["username"] for r in shown.collect()] == ["a", "b", None]


def test_rows_are_tested_while_they_are_written(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "open"), (1, None), (2, "draft"), (3, "draft"), (4, "locked"), (None, "closed")], "id bigint, state string"
    )
    rules = [
        checks.Rule("t", "id", "not_null"),
        checks.Rule("t", "id", "unique"),
        checks.Rule("t", "state", "not_null"),
        checks.Rule("t", "state", "accepted_values", ("open", "closed")),
    ]
    for df, part in ((rows, "all"), (rows.limit(1), "one"), (rows.limit(0), "none"), (rows.repartition(7), "many")):
        path = str(tmp_path / part)
        watch = checks.Watch(df, rules)
        watch.rows.write.parquet(path)
        stored = spark.read.schema(df.schema).parquet(path)
        expected = checks.check_model(stored, rules)
        found = watch.check(stored)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
        assert found.schema.simpleString() == expected.schema.simpleString()


def test_a_watched_table_is_read_for_uniqueness_only(spark, tmp_path):
    rows = spark.range(50).selectExpr("id", "'open' AS state")
    rules = [checks.Rule("t", "id", "not_null"), checks.Rule("t", "state", "accepted_values", ("open",))]
    scans = []
    for own in (rules, [*rules, checks.Rule("t", "id", "unique")]):
        path = str(tmp_path / str(len(own)))
        watch = checks.Watch(rows, own)
        watch.rows.write.parquet(path)
        plan = watch.check(spark.read.schema(rows.schema).parquet(path))._jdf.queryExecution().executedPlan().toString()
        scans.append(plan.count("FileScan"))
    assert scans == [0, 1]
