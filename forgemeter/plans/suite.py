"""Runs the data tests of a set of tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame

from forgemeter.operators.checks import Rule, Watch, check_model


def rules_of(model: str, rules: Iterable[Rule], sources: bool = False) -> list[Rule]:
    """Rules on raw tables only with ``sources``."""
    return [r for r in rules if r.model == model and (sources or not r.on_source)]


def run_suite(
    models: Mapping[str, DataFrame],
    rules: Iterable[Rule],
    sources: bool = False,
    watched: Mapping[str, Watch] | None = None,
) -> DataFrame:
    """model, column, test, failures, status for every rule on a given model.

    Pass stored tables. One that was ``watched`` while it was written is read
    for its unique rules only; any other is scanned once for its not_null and
    accepted_values rules besides.
    """
    rules, watched = list(rules), watched or {}
    parts = []
    for model, df in models.items():
        own = rules_of(model, rules, sources)
        if own:
            parts.append(watched[model].check(df) if model in watched else check_model(df, own))
    if not parts:
        raise ValueError("no rule applies to the given models")
    return reduce(DataFrame.unionByName, parts)
