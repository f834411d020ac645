"""Joins of large facts to smaller tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fixed_lookup(facts: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join to a table whose size the model bounds: a literal table, or one row per listed place."""
    return facts.join(F.broadcast(table), list(on), how)


def salted_join(
    facts: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str,
    *,
    spread_by: Sequence[str],
    salts: int,
) -> DataFrame:
    """Shuffle join on a few, hot keys.

    Both sides are shuffled on the key plus a salt, so that one hot key spreads
    over ``salts`` tasks; every table row is repeated once per salt, which keeps
    the result whole. A plain join splits a hot key too where adaptive execution
    can; this is for stages after which it can't.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join type {how}")
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
