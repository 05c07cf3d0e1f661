"""Checks a batch against a table's declared columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemeter.sources.tables import ColumnSpec, TableSpec

CASTS = {
    "int": lambda c: c.try_cast("int"),
    "bigint": lambda c: c.try_cast("bigint"),
    "string": lambda c: c.cast("string"),
    "date": lambda c: c.try_cast("date"),
    "timestamp_ntz": lambda c: c.try_cast("timestamp_ntz"),
}


def _violation(column: ColumnSpec) -> Column:
    """The first broken rule of one column, else NULL."""
    given, value = F.col(f"_in.{column.name}"), F.col(column.name)
    rule = F.when(given.isNotNull() & value.isNull(), F.lit(f"{column.name}: not a {column.type}"))
    if column.required:
        rule = rule.when(value.isNull(), F.lit(f"{column.name}: missing"))
    if column.max_length:
        rule = rule.when(
            F.char_length(value) > column.max_length, F.lit(f"{column.name}: longer than {column.max_length}")
        )
    return rule


def check_batch(batch: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns cast to their declared types, plus ``violation`` (NULL if none).

    Columns the table does not declare are passed through, so an arrival number
    survives. No shuffle: every rule looks at one row. Repeated keys are told by
    ``duplicated_keys``; a load lets the last row of a key win.
    """
    declared = spec.column_names
    extra = [c for c in batch.columns if c not in declared]
    given = batch.select(*extra, F.struct(*[F.col(c) for c in declared]).alias("_in"))
    cast = given.select(
        "*", *[CASTS[c.type](F.col(f"_in.{c.name}")).alias(c.name) for c in spec.columns]
    )
    found = F.coalesce(*[_violation(c) for c in spec.columns])
    return cast.select(*declared, *extra, found.alias("violation"))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("violation").isNull()).drop("violation")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("violation").isNotNull())


def _same(a: DataFrame, b: DataFrame, names: Sequence[str]) -> Column:
    """Equal in these columns, NULLs too."""
    condition = F.lit(True)
    for name in names:
        condition = condition & a[name].eqNullSafe(b[f"_bad_{name}"])
    return condition


def bad_units(checked: DataFrame, unit: Sequence[str]) -> DataFrame:
    """The units (a user, a repository) with at least one violation: their columns as ``_bad_...``.

    Collapsed before the shuffle, so a unit full of violations is one row a task there.
    """
    return rejected(checked).select(*[F.col(c).alias(f"_bad_{c}") for c in unit]).distinct()


def without_units(rows: DataFrame, bad: DataFrame, unit: Sequence[str]) -> DataFrame:
    """The rows of all other units. NULL is a unit of its own; few bad ones are broadcast, by their size."""
    return rows.join(bad, _same(rows, bad, unit), "left_anti")


def only_units(rows: DataFrame, bad: DataFrame, unit: Sequence[str]) -> DataFrame:
    return rows.join(bad, _same(rows, bad, unit), "left_semi")


def duplicated_keys(batch: DataFrame, spec: TableSpec) -> DataFrame:
    """The table's key columns and ``occurrences`` for every key that repeats; keys with a NULL are no keys.

    Counted before the shuffle, so a key that fills a third of the batch is one
    row per task there.
    """
    keys = list(spec.primary_key)
    return (
        batch.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def require_valid(checked: DataFrame) -> DataFrame:
    """All or nothing: the job fails on the first violation, as a transaction would."""
    guard = F.when(F.col("violation").isNotNull(), F.raise_error(F.col("violation")).cast("boolean")).otherwise(True)
    return checked.filter(guard).drop("violation")
