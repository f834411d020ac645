"""Linear interpolation of yearly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def interpolate_yearly(
    df: DataFrame,
    keys: Sequence[str],
    *,
    year: str = "year",
    value: str = "value",
) -> DataFrame:
    """One row per year between the first and last row of each series.

    Years between two known values lie on the straight line between them; years
    before the first or after the last known value stay NULL. A year given twice
    in one series is an error.

    Each row looks up the known points around it and then emits the years up to
    the next row, so the whole operator is one shuffle and one sort on the
    series keys; no year table is joined. A series holds at most one row per
    year, so no window grows with the data.
    """
    by_year = Window.partitionBy(*keys).orderBy(year)
    point = F.when(F.col(value).isNotNull(), F.struct(F.col(year).alias("y"), F.col(value).alias("v")))
    before = by_year.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = by_year.rowsBetween(1, Window.unboundedFollowing)

    around = df.select(
        *keys,
        F.col(year).alias("_from"),
        F.lead(year).over(by_year).alias("_next"),
        F.last(point, ignorenulls=True).over(before).alias("_a"),
        F.first(point, ignorenulls=True).over(after).alias("_b"),
    )
    last_year = F.when(
        F.col("_next") == F.col("_from"), F.raise_error(F.lit(f"{year} given twice in one series"))
    ).otherwise(F.coalesce(F.col("_next") - 1, F.col("_from")))
    yearly = around.withColumn(year, F.explode(F.sequence("_from", last_year)))
    return yearly.select(*keys, year, _on_line(F.col(year)).alias(value))


def _on_line(at: Column) -> Column:
    y0, v0, y1, v1 = (F.col(c) for c in ("_a.y", "_a.v", "_b.y", "_b.v"))
    return F.when(at == y0, v0).otherwise(v0 + (v1 - v0) * (at - y0) / (y1 - y0))
