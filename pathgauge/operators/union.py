"""Appending tables by column name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame


def stack_same(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Append tables with the same columns; a different column set is an error."""
    return reduce(DataFrame.unionByName, others, first)


def stack_named(datasets: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    """Append the named datasets; a column one of them lacks is NULL there."""
    missing = [name for name in names if name not in datasets]
    if missing:
        raise KeyError(f"unknown datasets: {missing}")
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [datasets[name] for name in names],
    )
