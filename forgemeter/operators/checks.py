"""Data tests on a table's columns: not_null, unique, accepted_values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    model: str
    column: str
    test: str
    values: tuple[str, ...] = ()
    # A rule on a raw table is declared, but belongs to no model's run.
    on_source: bool = False

    def __post_init__(self) -> None:
        if self.test not in ("not_null", "unique", "accepted_values"):
            raise ValueError(f"unknown data test {self.test!r}")
        if (self.test == "accepted_values") != bool(self.values):
            raise ValueError("accepted_values, and only it, takes values")


def _row_measure(rule: Rule) -> Column:
    column = F.col(rule.column)
    if rule.test == "not_null":
        return F.count_if(column.isNull())
    return F.count_distinct(F.when(~column.isin(*rule.values), column))


def _labelled(failures: DataFrame, rule: Rule) -> DataFrame:
    return failures.select(
        F.lit(rule.model).alias("model"),
        F.lit(rule.column).alias("column"),
        F.lit(rule.test).alias("test"),
        F.col("failures").cast("bigint").alias("failures"),
    )


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once; counted before the shuffle."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def check_model(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """model, column, test, failures, status for all rules of one model.

    not_null and accepted_values share one scan; unique takes a grouping each.
    """
    fused = [r for r in rules if r.test != "unique"]
    parts = []
    if fused:
        measured = df.agg(*[_row_measure(r).alias(f"m{i}") for i, r in enumerate(fused)])
        entries = F.array(
            *[
                F.struct(
                    F.lit(r.model).alias("model"),
                    F.lit(r.column).alias("column"),
                    F.lit(r.test).alias("test"),
                    F.col(f"m{i}").cast("bigint").alias("failures"),
                )
                for i, r in enumerate(fused)
            ]
        )
        parts.append(measured.select(F.inline(entries)))
    for rule in rules:
        if rule.test == "unique":
            counted = duplicated_values(df, rule.column).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(_labelled(counted, rule))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


# Measured while a table is written -----------------------------------------


class Watch:
    """Row measures of a model's rules, taken from the rows as they pass on their way into a table.

    ``rows`` is what to write instead of the model. The measures stand right
    below the write, so a task repeated after a lost executor counts once.
    """

    def __init__(self, df: DataFrame, rules: Sequence[Rule]):
        self.rules = list(rules)
        self._fused = [r for r in rules if r.test != "unique"]
        self._seen = Observation() if self._fused else None
        measures = [_failing_rows(r).alias(f"m{i}") for i, r in enumerate(self._fused)]
        self.rows = df.observe(self._seen, *measures) if measures else df

    def check(self, stored: DataFrame) -> DataFrame:
        """As ``check_model``, once ``rows`` are written to ``stored``.

        That table is read for uniqueness, and for the different values that are
        not accepted if there are any; else for nothing.
        """
        seen = self._seen.get if self._fused else {}
        known, scans = [], [r for r in self.rules if r.test == "unique"]
        for i, rule in enumerate(self._fused):
            failing = seen[f"m{i}"] or 0
            if rule.test == "accepted_values" and failing:
                scans.append(rule)
            else:
                known.append((rule.model, rule.column, rule.test, failing, "fail" if failing else "pass"))
        parts = [stored.sparkSession.createDataFrame(known, RESULT)] if known else []
        if scans:
            parts.append(check_model(stored, scans))
        return reduce(DataFrame.unionByName, parts)


RESULT = "model string, column string, test string, failures bigint, status string"


def _failing_rows(rule: Rule) -> Column:
    column = F.col(rule.column)
    return F.count_if(column.isNull() if rule.test == "not_null" else ~column.isin(*rule.values))
