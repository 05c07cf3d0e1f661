"""Keyed loads: insert new keys, take over the fields of known ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.session import (
    path_exists,
    remove_path,
    scratch_scope,
    settle,
    settled_files,
    sized_session,
    stored_bytes,
)
from forgemeter.sources.tables import TableSpec, ensure_table, read_table

# Merged rows on their way into a dataset.
PENDING = "_pending"


def _fields(names: list[str], picked: str) -> dict[str, Column]:
    return {c: F.col(f"{picked}.{c}") for c in names}


def last_per_key(batch: DataFrame, spec: TableSpec, seq: str) -> DataFrame:
    """The batch with one row per key: what applying its rows in ``seq`` order leaves.

    ``seq`` may be of any type that has an order, a struct too. Rows that tie in
    it go by their fields, so that the result does not depend on the order of the
    input. Copies of a key collapse before the shuffle; that takes a sort on
    either side of it, where a row number would bring a hot key into one task.
    """
    # A field outside replaced_fields keeps what the first row inserted.
    kept = [c for c in spec.payload_names if c not in spec.replaced_fields]
    picks = [F.max(F.struct(F.col(seq).alias("_at"), *spec.replaced_fields)).alias("_last")]
    if kept:
        picks.append(F.min(F.struct(F.col(seq).alias("_at"), *kept)).alias("_first"))
    found = batch.groupBy(*spec.primary_key).agg(*picks)
    source = {**_fields(spec.replaced_fields, "_last"), **_fields(kept, "_first")}
    return found.select(*[source.get(c, F.col(c)).alias(c) for c in spec.column_names])


def upsert(target: DataFrame, batch: DataFrame, spec: TableSpec, seq: str) -> DataFrame:
    """``target`` after loading ``batch``; target rows are unique by key.

    When a new row replaces all there is to replace, the target only has to lose
    the keys of the batch: an anti-join that never shuffles the target as long
    as the batch's keys are small enough to broadcast (Spark decides by size).
    Otherwise both sides go through one aggregate in which target rows come first.
    """
    if _replaces_rows(spec):
        return _with_latest(target, last_per_key(batch, spec, seq), spec)
    # NULL comes before any value.
    first = F.lit(None).cast(batch.schema[seq].dataType)
    columns = spec.column_names
    both = target.select(*columns, first.alias("_seq")).unionByName(batch.select(*columns, F.col(seq).alias("_seq")))
    return last_per_key(both, spec, "_seq")


def changed_rows(target: DataFrame, latest: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows of ``latest`` that are new in ``target`` or change a field there; both are unique by key.

    Fields are compared themselves, not digests of them, so that no change is
    ever taken for none. The target is only joined on keys: it is not shuffled
    while ``latest`` is small enough for Spark to broadcast.
    """
    keys = list(spec.primary_key)
    given = latest.select(*keys, F.struct(*spec.replaced_fields).alias("_given"))
    stored = target.select(*keys, F.struct(*spec.replaced_fields).alias("_stored"))
    same = stored.join(given, keys).filter(F.col("_given").eqNullSafe(F.col("_stored"))).select(*keys)
    return latest.join(same, keys, "left_anti").select(*spec.column_names)


def _replaces_rows(spec: TableSpec) -> bool:
    return set(spec.replaced_fields) == set(spec.payload_names)


def _with_latest(target: DataFrame, latest: DataFrame, spec: TableSpec) -> DataFrame:
    """``target`` after loading rows that are unique by key."""
    if not _replaces_rows(spec):
        return upsert(target, latest.withColumn("_seq", F.lit(1)), spec, "_seq")
    columns, keys = spec.column_names, list(spec.primary_key)
    untouched = target.select(*columns).join(latest.select(*keys), keys, "left_anti")
    return untouched.select(*columns).unionByName(latest.select(*columns))


def upsert_into(batch: DataFrame, spec: TableSpec, path: str, seq: str) -> None:
    """Load ``batch`` into the dataset at ``path``, rewriting only what it touches.

    Rows that are stored already just as they come leave the batch first; months
    or id blocks without any other row keep their files, and a batch without any
    writes nothing. So a failed load is repeated at the price of reading.
    The merged rows are written to ``_pending`` inside the dataset (readers skip
    such folders) before any directory is replaced: the job never reads what it
    overwrites, and a swap cut short is finished by the next load. One load at a
    time; a reader during the swap may see some directories old and some new.
    """
    spark = batch.sparkSession
    ensure_table(spark, spec, path)
    finish_swap(spark, spec, path)
    with scratch_scope(spark):
        merged = _merge(batch, spec, path, seq)
        if merged is None:
            return
        merged.write.mode("overwrite").parquet(f"{path}/{PENDING}")
    finish_swap(spark, spec, path)


def _merge(batch: DataFrame, spec: TableSpec, path: str, seq: str) -> DataFrame | None:
    """The full new content of the directories the batch changes; None if it changes nothing.

    Shuffles are sized by the bytes of the batch and of the directories it has keys in.
    """
    spark, place = batch.sparkSession, spec.layout[0]
    batch = batch.select(*spec.column_names, seq)
    files = settled_files(batch, "batch")
    met = _places(spark.read.schema(batch.schema).parquet(files), spec)
    stored = [d for d in (f"{path}/{place}={t}" for t in met) if path_exists(spark, d)]
    sized, _ = sized_session(spark, sum(stored_bytes(spark, d) for d in [files, *stored]))
    latest = last_per_key(sized.read.schema(batch.schema).parquet(files), spec, seq)
    target = read_table(sized, spec, path)
    if stored:
        latest = settle(latest, "latest")
        latest = changed_rows(target.filter(F.col(place).isin(met)), latest, spec)
    latest = settle(latest, "changed")
    touched = _places(latest, spec)
    return _with_latest(target.filter(F.col(place).isin(touched)), latest, spec) if touched else None


def _places(rows: DataFrame, spec: TableSpec) -> list:
    """Names of directories of the dataset, all of which the driver lists anyway."""
    return [r[0] for r in rows.select(spec.layout_column()).distinct().collect()]


def finish_swap(spark: SparkSession, spec: TableSpec, path: str) -> None:
    """Swap in the directories that completely written pending rows hold; others stay.

    Rebalancing by directory gives few files each, and splits a large one.
    """
    pending, place = f"{path}/{PENDING}", spec.layout[0]
    if path_exists(spark, f"{pending}/_SUCCESS"):
        sized, _ = sized_session(spark, stored_bytes(spark, pending))
        (
            sized.read.schema(spec.schema())
            .parquet(pending)
            .withColumn(place, spec.layout_column())
            .hint("rebalance", place)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(place)
            .parquet(path)
        )
    remove_path(spark, pending)
