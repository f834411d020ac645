"""Asset production: wide input to one clean row per company, place, technology and year.

The sums run on wide rows, years side by side, and turn long only at the end,
where that costs no shuffle. A shuffled row then carries its keys once instead
of once per year.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathgauge import refdata
from pathgauge.functions.semantics import floor_at_zero, if_else, recode, total
from pathgauge.operators.reshape import prefixed_years

_ASSET_KEYS = ("company_name", "company_id", "sector", "asset_country", "technology", "unit")


def _is_zero_tech(techs: Sequence[str]) -> Column:
    return F.coalesce(F.col("technology").isin(*techs), F.lit(False))


def zero_factor(long: DataFrame, techs: Sequence[str] = refdata.ZERO_FACTOR_TECHS) -> DataFrame:
    """Emission factor 0 for producing zero-emission assets.

    When the production of such an asset is missing, so is its factor.
    """
    produces = _is_zero_tech(techs) & (F.col("ald_production") > 0)
    return long.withColumn("emissions_factor", if_else(produces, F.lit(0.0), F.col("emissions_factor")))


_PRODUCING, _IDLE, _UNKNOWN, _ANY = range(4)


def _with_factor_versions(wide: DataFrame, years: dict[str, int], techs: Sequence[str]) -> DataFrame:
    """``zero_factor`` on wide rows; ``v_<year>`` is NULL where a row has no such year.

    The factor of a zero-emission asset differs from year to year, so its row is
    repeated for each factor it takes: 0 in the years it produces, its own in
    those it does not, missing where the production is missing.
    """
    versions = F.when(
        _is_zero_tech(techs), F.array(F.lit(_PRODUCING), F.lit(_IDLE), F.lit(_UNKNOWN))
    ).otherwise(F.array(F.lit(_ANY)))
    version = F.col("_version")
    factor = F.when(version == _PRODUCING, F.lit(0.0)).when(version != _UNKNOWN, F.col("emissions_factor"))

    def cell(value: Column) -> Column:
        holds = (
            (version == _ANY)
            | ((version == _PRODUCING) & (value > 0))
            | ((version == _IDLE) & (value <= 0))
            | ((version == _UNKNOWN) & value.isNull())
        )
        return F.when(holds, F.coalesce(value, F.lit(0.0)))

    copies = wide.select(*_ASSET_KEYS, "emissions_factor", *years, F.explode(versions).alias("_version"))
    cells = copies.select(
        *_ASSET_KEYS,
        factor.alias("emissions_factor"),
        *[cell(F.col(c)).alias(f"v_{y}") for c, y in years.items()],
    )
    # A version that holds in no year would only be shuffled.
    return cells.where(F.coalesce(*[F.col(f"v_{y}") for y in years.values()]).isNotNull()) if years else cells


def sum_years(rows: DataFrame, keys: Sequence[str], years: Iterable[int], exact: bool = False) -> DataFrame:
    """Sums per year; a year no row has stays NULL."""
    return rows.groupBy(*keys).agg(*[total(f"v_{y}", exact).alias(f"v_{y}") for y in years])


def year_rows(
    rows: DataFrame, columns: Sequence[str], years: Iterable[int], value: str = "ald_production"
) -> DataFrame:
    """Years side by side to one row per year that has rows.

    A generator keeps the placement of its input rows; ``unpivot`` would lose
    it, and the next join or sum by the same key would shuffle again.
    """
    numbers = list(years)
    cells = [cell for y in numbers for cell in (F.lit(y), F.col(f"v_{y}"))]
    long = rows.select(*columns, F.stack(F.lit(len(numbers)), *cells).alias("year", value))
    return long.where(F.col(value).isNotNull())


def asset_sums(
    wide: DataFrame,
    *,
    years: Iterable[int] | None = None,
    zero_techs: Sequence[str] = refdata.ZERO_FACTOR_TECHS,
    exact: bool = False,
) -> DataFrame:
    """Assets summed per key, floored at 0 and under their clean names; years side by side.

    ``v_<year>`` is the production, NULL when the key has no row in that year.
    Technology names that became equal are not summed yet: that is left to
    ``normalise``, or to a reader that sums by technology anyway.
    """
    columns = prefixed_years(wide, years)
    numbers = list(columns.values())
    summed = sum_years(
        _with_factor_versions(wide, columns, zero_techs), [*_ASSET_KEYS, "emissions_factor"], numbers, exact
    )
    cleaned = (
        F.when(F.col("technology") == "Oil and Condensate", F.lit("Oil"))
        .when(F.col("sector") == "Coal", F.lit("Coal"))
        .otherwise(F.col("technology"))
    )
    return summed.select(
        F.col("company_id").alias("id"),
        F.lit("company_id").alias("id_name"),
        F.col("sector").alias("ald_sector"),
        F.col("asset_country").alias("ald_location"),
        F.regexp_replace(cleaned, "Grade$", "").alias("technology"),
        F.col("unit").alias("ald_production_unit"),
        F.col("emissions_factor").alias("ald_emissions_factor"),
        F.lit("-").alias("ald_emissions_factor_unit"),
        "company_name",
        *[floor_at_zero(f"v_{y}").alias(f"v_{y}") for y in numbers],
    )


def _years(rows: DataFrame) -> list[int]:
    return [int(c.removeprefix("v_")) for c in rows.columns if c.startswith("v_")]


def side_by_side(long: DataFrame, years: Iterable[int]) -> DataFrame:
    """A stored long table in the shape of ``asset_sums``, one row per input row, without a shuffle."""
    numbers = list(years)
    keys = [c for c in long.columns if c not in ("year", "ald_production")]
    known = F.coalesce("ald_production", F.lit(0.0))
    return long.where(F.col("year").isin(*numbers)).select(
        *keys, *[F.when(F.col("year") == y, known).alias(f"v_{y}") for y in numbers]
    )


def _key_columns(rows: DataFrame, without: Sequence[str] = ()) -> list[str]:
    return [c for c in rows.columns if not c.startswith("v_") and c not in without]


def normalise(
    wide: DataFrame,
    *,
    years: Iterable[int] | None = None,
    zero_techs: Sequence[str] = refdata.ZERO_FACTOR_TECHS,
    without: Sequence[str] = (),
    exact: bool = False,
    ordered_by: str | None = None,
) -> DataFrame:
    """The full clean long table: one row per value of all its other columns.

    With ``ordered_by`` it comes in order of that column. The sums are then placed
    by ranges of it and the other keys in the place of their hash, so this costs a
    sort but no further shuffle, and a value that many rows hold is split by the
    other keys.
    """
    rows = asset_sums(wide, years=years, zero_techs=zero_techs, exact=exact)
    keys, numbers = _key_columns(rows, without), _years(rows)
    if ordered_by:
        # A factor is evened out (-0.0, NaN) as a grouping key and a constant is none, so they'd spoil the placement.
        others = ("ald_location", "technology", "ald_sector", "ald_production_unit")
        rows = rows.repartitionByRange(ordered_by, *[c for c in others if c != ordered_by])
    summed = sum_years(rows, keys, numbers, exact)
    if ordered_by:
        summed = summed.sortWithinPartitions(ordered_by)
    return year_rows(summed, keys, numbers)


def masterdata(
    wide: DataFrame,
    zero_techs: Sequence[str],
    *,
    years: Iterable[int] | None = None,
    exact: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """The clean long table as later stages read it: keyed by company id, without its name; in order of the id on request."""
    return normalise(
        wide,
        years=years,
        zero_techs=zero_techs,
        without=("company_name", "id_name"),
        exact=exact,
        ordered_by="id" if ordered else None,
    )


def recode_hdv(facts: DataFrame) -> DataFrame:
    """Fold truck sub-technologies into their group; sums are left to the connect stage."""
    return facts.withColumn("technology", recode("technology", refdata.HDV_TECH_RECODE, keep_other=True))
