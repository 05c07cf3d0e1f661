import dataclasses
import shutil

import pytest
from helpers import by_key, day
from pyspark.sql import functions as F

from forgemeter.operators.upsert import changed_rows, finish_swap, upsert, upsert_into
from forgemeter.sources import samples
from forgemeter.sources.tables import (
    RAW_CONTRIBUTIONS,
    RAW_PULLS,
    contributions_since,
    ensure_table,
    read_table,
    table_spec,
)

BATCH = "username string, date date, contribution_count int, seq bigint"


def test_declared_tables():
    spec = table_spec("raw_contributions")
    assert spec.column_names == ["username", "date", "contribution_count"]
    assert spec.options["restatement_window"] == 7 and spec.options["backfill_threshold"] == 30
    assert table_spec("raw_pulls").replaced_fields == ["repo_name", "state", "created_at", "merged_at", "user_login"]


def test_unknown_table():
    with pytest.raises(KeyError, match="not found"):
        table_spec("nothing_like_it")


def test_ddl():
    ddl = RAW_CONTRIBUTIONS.ddl()
    assert "username VARCHAR(255) NOT NULL" in ddl and "PRIMARY KEY (username, date)" in ddl
    assert "PRIMARY KEY (pr_id)" in RAW_PULLS.ddl()
    assert "user_login VARCHAR(255) NOT NULL" not in RAW_PULLS.ddl()


@pytest.mark.parametrize(
    "change",
    [
        {"load": "append"},
        {"update_fields": ()},
        {"update_fields": ("username",)},
        {"primary_key": ("nobody",)},
        {"primary_key": ()},
        {"columns": ()},
    ],
)
def test_bad_declarations(change):
    with pytest.raises(ValueError):
        dataclasses.replace(RAW_CONTRIBUTIONS, **change)


def _counts(df):
    return {k: r["contribution_count"] for k, r in by_key(df, "username", "date").items()}


def test_last_row_of_a_batch_wins(spark):
    target = spark.createDataFrame([("a", day("2024-01-01"), 1), ("b", day("2024-01-01"), 2)], RAW_CONTRIBUTIONS.schema())
    batch = spark.createDataFrame(
        [("a", day("2024-01-01"), 8, 2), ("a", day("2024-01-01"), 7, 1), ("c", day("2024-02-01"), 3, 3)], BATCH
    )
    merged = upsert(target, batch, RAW_CONTRIBUTIONS, "seq")
    expected = {("a", day("2024-01-01")): 8, ("b", day("2024-01-01")): 2, ("c", day("2024-02-01")): 3}
    assert _counts(merged) == expected
    assert _counts(upsert(merged, batch, RAW_CONTRIBUTIONS, "seq")) == expected
    assert _counts(upsert(target, batch.limit(0), RAW_CONTRIBUTIONS, "seq")) == _counts(target)


def test_only_listed_fields_are_taken_over(spark):
    spec = dataclasses.replace(RAW_PULLS, load="merge_fields", update_fields=("state",))
    columns = ", ".join(f"{c.name} {c.type}" for c in spec.columns)
    target = spark.createDataFrame([("o/r", 1, "open", None, None, "u")], columns)
    batch = spark.createDataFrame(
        [("o/x", 1, None, None, None, "v", 1), ("o/y", 2, "open", None, None, "w", 2), ("o/z", 2, "closed", None, None, "x", 3)],
        columns + ", seq bigint",
    )
    found = by_key(upsert(target, batch, spec, "seq"), "pr_id")
    assert (found[1]["repo_name"], found[1]["state"], found[1]["user_login"]) == ("o/r", None, "u")
    assert (found[2]["repo_name"], found[2]["state"], found[2]["user_login"]) == ("o/y", "closed", "w")


def test_a_load_rewrites_only_the_months_it_touches(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [("a", day("2024-01-05"), 1, 1), ("a", day("2024-02-05"), 2, 1), ("b", day("2024-02-06"), 3, 1)]
    upsert_into(spark.createDataFrame(rows, BATCH), RAW_CONTRIBUTIONS, path, "seq")
    january = sorted(f.name for f in (tmp_path / "raw" / "month=2024-01-01").iterdir())
    again = spark.createDataFrame([("a", day("2024-02-05"), 9, 1), ("c", day("2024-03-01"), 4, 1)], BATCH)
    for _ in range(2):
        upsert_into(again, RAW_CONTRIBUTIONS, path, "seq")
        stored = read_table(spark, RAW_CONTRIBUTIONS, path)
        assert _counts(stored) == {
            ("a", day("2024-01-05")): 1,
            ("a", day("2024-02-05")): 9,
            ("b", day("2024-02-06")): 3,
            ("c", day("2024-03-01")): 4,
        }
    assert sorted(f.name for f in (tmp_path / "raw" / "month=2024-01-01").iterdir()) == january
    recent = contributions_since(read_table(spark, RAW_CONTRIBUTIONS, path), F.lit(day("2024-02-06")))
    assert recent.count() == 2
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and ">= 2024-02-01" in plan


def test_a_swap_cut_short_is_finished_by_the_next_load(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")
    rows = [("a", day("2024-01-05"), 1, 1), ("a", day("2024-02-05"), 2, 1)]
    upsert_into(spark.createDataFrame(rows, BATCH), RAW_CONTRIBUTIONS, path, "seq")

    def die(spark, spec, path):
        """The swap took one directory away and got no further."""
        if (tmp_path / "raw" / "_pending" / "_SUCCESS").exists():
            shutil.rmtree(tmp_path / "raw" / "month=2024-02-01")
            raise RuntimeError("driver lost")

    late = spark.createDataFrame([("b", day("2024-02-06"), 3, 1)], BATCH)
    with monkeypatch.context() as patched:
        patched.setattr("forgemeter.operators.upsert.finish_swap", die)
        with pytest.raises(RuntimeError):
            upsert_into(late, RAW_CONTRIBUTIONS, path, "seq")
    assert len(_counts(read_table(spark, RAW_CONTRIBUTIONS, path))) == 1
    upsert_into(late.limit(0), RAW_CONTRIBUTIONS, path, "seq")
    assert _counts(read_table(spark, RAW_CONTRIBUTIONS, path)) == {
        ("a", day("2024-01-05")): 1,
        ("a", day("2024-02-05")): 2,
        ("b", day("2024-02-06")): 3,
    }
    assert not (tmp_path / "raw" / "_pending").exists()


def test_half_written_pending_rows_are_dropped(spark, tmp_path):
    path = str(tmp_path / "raw")
    upsert_into(spark.createDataFrame([("a", day("2024-01-05"), 1, 1)], BATCH), RAW_CONTRIBUTIONS, path, "seq")
    half = tmp_path / "raw" / "_pending"
    spark.createDataFrame([("a", day("2024-01-05"), 9)], RAW_CONTRIBUTIONS.schema()).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert _counts(read_table(spark, RAW_CONTRIBUTIONS, path)) == {("a", day("2024-01-05")): 1}
    finish_swap(spark, RAW_CONTRIBUTIONS, path)
    assert _counts(read_table(spark, RAW_CONTRIBUTIONS, path)) == {("a", day("2024-01-05")): 1}
    assert not half.exists()


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "raw")
    upsert_into(spark.createDataFrame([], BATCH), RAW_CONTRIBUTIONS, path, "seq")
    assert read_table(spark, RAW_CONTRIBUTIONS, path).count() == 0
    ensure_table(spark, RAW_CONTRIBUTIONS, path)


def test_a_batch_over_several_directories_loads_twice_alike(spark, tmp_path):
    path = str(tmp_path / "raw")
    days = samples.dense_contributions(spark, "/root/testdata/sf0.001").withColumn("seq", F.lit(1))
    more = days.withColumn("date", F.add_months("date", 1))
    both = days.unionByName(more)
    for _ in range(2):
        upsert_into(both, RAW_CONTRIBUTIONS, path, "seq")
    assert read_table(spark, RAW_CONTRIBUTIONS, path).count() == both.select("username", "date").distinct().count()


PULLS = ", ".join(f"{c.name} {c.type}" for c in RAW_PULLS.columns)


def _files(folder):
    return {str(f.relative_to(folder)): f.stat().st_mtime_ns for f in folder.rglob("*") if f.is_file()}


def test_rows_that_change_nothing_leave_the_batch(spark):
    stored = [("o/r", 1, "open", None, None, "u"), ("o/r", 2, None, None, None, None), ("o/r", 3, "open", None, None, "v")]
    given = [("o/r", 1, "open", None, None, "u"), ("o/r", 2, None, None, None, None), ("o/r", 3, None, None, None, "v")]
    given.append(("o/r", 4, None, None, None, None))
    target, latest = spark.createDataFrame(stored, PULLS), spark.createDataFrame(given, PULLS)
    assert set(by_key(changed_rows(target, latest, RAW_PULLS), "pr_id")) == {3, 4}
    assert changed_rows(target.limit(0), latest, RAW_PULLS).count() == 4
    assert changed_rows(target, latest.limit(0), RAW_PULLS).count() == 0
    # Fields that a load leaves alone do not make a row a changed one.
    spec = dataclasses.replace(RAW_PULLS, load="merge_fields", update_fields=("state",))
    other = spark.createDataFrame([("x/y", 1, "open", None, None, "w"), ("x/y", 2, "open", None, None, "w")], PULLS)
    assert set(by_key(changed_rows(target, other, spec), "pr_id")) == {2}


def test_a_repeated_load_writes_nothing(spark, tmp_path):
    folder = tmp_path / "raw"
    block = 100_000_000
    rows = [("o/r", k * block + i, "open", None, None, f"u{i}", i) for k in range(3) for i in range(5)]
    batch = spark.createDataFrame(rows, PULLS + ", seq bigint")
    upsert_into(batch, RAW_PULLS, str(folder), "seq")
    before = _files(folder)
    upsert_into(batch.union(batch), RAW_PULLS, str(folder), "seq")
    assert _files(folder) == before
    # One row of one block differs: the other blocks keep their files although the batch has all their keys.
    late = batch.withColumn("state", F.when(F.col("pr_id") == block + 2, "closed").otherwise(F.col("state")))
    upsert_into(late, RAW_PULLS, str(folder), "seq")
    after = _files(folder)
    same = {name for name in before if after.get(name) == before[name]}
    assert {name.split("/")[0] for name in before if name not in same and "/" in name} == {"id_block=1"}
    stored = read_table(spark, RAW_PULLS, str(folder))
    assert stored.count() == 15 and stored.filter("state = 'closed'").select("pr_id").collect() == [(block + 2,)]


def test_a_row_changed_and_changed_back_in_one_batch_is_no_change(spark, tmp_path):
    folder = tmp_path / "raw"
    first = spark.createDataFrame([("a", day("2024-01-05"), 1, 1)], BATCH)
    upsert_into(first, RAW_CONTRIBUTIONS, str(folder), "seq")
    before = _files(folder)
    upsert_into(
        spark.createDataFrame([("a", day("2024-01-05"), 7, 1), ("a", day("2024-01-05"), 1, 2)], BATCH),
        RAW_CONTRIBUTIONS,
        str(folder),
        "seq",
    )
    assert _files(folder) == before
