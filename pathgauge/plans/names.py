"""Company names as results show them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathgauge.operators.lookup import fixed_lookup


def display_name(df: DataFrame, names: Mapping[str, str], column: str = "company_name") -> DataFrame:
    """Replace listed names; a name that is not listed stays."""
    table = df.sparkSession.createDataFrame(list(names.items()), f"`{column}` string, _shown string")
    shown = fixed_lookup(df, table, [column], "left")
    return shown.withColumn(column, F.coalesce("_shown", column)).select(*df.columns)


def sector_display_name(df: DataFrame, names: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """``display_name`` with a list of its own for each sector, in one pass."""
    rows = [(sector, old, new) for sector, listed in names.items() for old, new in listed.items()]
    table = df.sparkSession.createDataFrame(rows, "ald_sector string, company_name string, _shown string")
    shown = fixed_lookup(df, table, ["ald_sector", "company_name"], "left")
    return shown.withColumn("company_name", F.coalesce("_shown", "company_name")).select(*df.columns)
