"""Wide to long and back, with fixed value lists and a uniqueness check."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YEAR_COLUMN = re.compile(r"^X?_(\d{4})$")


def prefixed_years(df: DataFrame, years: Iterable[int] | None = None) -> dict[str, int]:
    """Year columns of a wide table (``_2022`` or ``X_2022``), optionally only some years."""
    found = {c: int(m.group(1)) for c in df.columns if (m := YEAR_COLUMN.match(c))}
    if years is None:
        return found
    wanted = set(years)
    return {c: y for c, y in found.items() if y in wanted}


def unpivot_years(
    df: DataFrame,
    value: str,
    *,
    years: Iterable[int] | None = None,
    year: str = "year",
) -> DataFrame:
    """One row per input row and year; years without a value stay as NULL rows.

    Asking for some years only leaves the other year columns out of the scan,
    which a filter on the long table could not do.
    """
    columns = prefixed_years(df, years)
    ids = [c for c in df.columns if not YEAR_COLUMN.match(c)]
    long = df.unpivot(ids, list(columns), year, value)
    return long.withColumn(year, F.regexp_extract(year, YEAR_COLUMN.pattern, 1).cast("int"))


def strict_pivot(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    value: str,
    names: Sequence[str],
    *,
    columns: Sequence[str] | None = None,
    distinct_rows: bool = False,
    reject_other: bool = False,
) -> DataFrame:
    """Pivot that fails on a key holding more than one row for the same name.

    ``distinct_rows`` lets equal rows pass, as if the input were made distinct
    first, without the extra shuffle that would take. The value column must not
    be NULL in that mode. ``reject_other`` fails on a name outside ``names``
    instead of leaving its rows out.

    One hash aggregate with a map-side step: cells are numbers, so no sort is
    needed, and the fixed list saves the pass that finds the names.
    """
    columns = list(columns or names)

    def hit(wanted: str) -> Column:
        return F.col(name) == F.lit(wanted)

    parts: list[Column] = []
    for i, wanted in enumerate(names):
        cell = F.when(hit(wanted), F.col(value))
        parts.append(F.max(cell).alias(f"_hi{i}"))
        parts.append((F.min(cell) if distinct_rows else F.count_if(hit(wanted))).alias(f"_check{i}"))
    if reject_other:
        listed = F.col(name).isin(*names)
        parts.append(F.count_if(listed.isNull() | ~listed).alias("_other"))

    grouped = df.groupBy(*keys).agg(*parts)

    def checked(i: int) -> Column:
        clash = F.col(f"_check{i}") != F.col(f"_hi{i}") if distinct_rows else F.col(f"_check{i}") > 1
        if reject_other:
            clash = (F.col("_other") > 0) | clash
        message = F.lit(f"pivot on {name}: more than one row, or an unlisted name, at {names[i]}")
        return F.when(clash, F.raise_error(message)).otherwise(F.col(f"_hi{i}"))

    return grouped.select(*keys, *[checked(i).alias(columns[i]) for i in range(len(names))])
