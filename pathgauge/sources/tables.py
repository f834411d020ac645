"""Readers for input files and writers for result files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathgauge import schemas
from pathgauge.operators.reshape import prefixed_years


# Quotes inside a cell are doubled and blanks at its ends are kept: names hold both.
_CSV = {
    "header": True,
    "nullValue": "",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as text; only a blank cell is missing."""
    return spark.read.csv(path, **_CSV)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, headings: Mapping[str, str] | None = None
) -> DataFrame:
    """CSV by header name, as ``schema``; ``headings`` maps a column to its name in the file.

    Columns are read as text and converted by name, so the column order in the
    file does not matter and no pass over the data is spent on guessing types.
    A column the file lacks is left out.
    """
    raw = read_text(spark, path)
    names = {f.name: (headings or {}).get(f.name, f.name) for f in schema.fields}
    return raw.select(
        *[_typed(f.name, f.dataType, names[f.name]) for f in schema.fields if names[f.name] in raw.columns]
    )


def read_production(spark: SparkSession, path: str) -> DataFrame:
    """Wide production table, CSV or Parquet, one column per year.

    The text "NA" stays text (it is a country code); only blank cells are
    missing. Cells that are not numbers become missing.
    """
    is_csv = path.rstrip("/").endswith(".csv")
    return as_production(read_text(spark, path) if is_csv else spark.read.parquet(path))


def as_production(raw: DataFrame) -> DataFrame:
    keys = [_typed(f.name, f.dataType) for f in schemas.PRODUCTION_KEYS.fields]
    years = [_typed(c, T.DoubleType()) for c in prefixed_years(raw)]
    return raw.select(*keys, *years)


#: Column of cells that could not be converted, beside the converted ones.
REJECTS = "_rejects"


def with_rejects(raw: DataFrame) -> DataFrame:
    """Wide production table with the cells that became missing though they hold something.

    They stand in a column of (field, text), so that one pass over the file gives
    the table and what is wrong with it; see ``rejects`` and ``count_rejects``.
    """
    numbers = [f for f in schemas.PRODUCTION_KEYS.fields if not isinstance(f.dataType, T.StringType)]
    numbers += [T.StructField(c, T.DoubleType()) for c in prefixed_years(raw)]
    lost = [
        F.when(
            F.col(f"`{f.name}`").isNotNull() & (F.trim(F.col(f"`{f.name}`").cast("string")) != "") & _typed(f.name, f.dataType).isNull(),
            F.struct(F.lit(f.name).alias("field"), F.col(f"`{f.name}`").cast("string").alias("text")),
        )
        for f in numbers
    ]
    names = [*schemas.PRODUCTION_KEYS.fieldNames(), *prefixed_years(raw)]
    kinds = {f.name: f.dataType for f in [*schemas.PRODUCTION_KEYS.fields, *numbers]}
    return raw.select(*[_typed(c, kinds[c]) for c in names], F.array_compact(F.array(*lost)).alias(REJECTS))


def rejects(checked: DataFrame) -> DataFrame:
    """One row per lost cell: the asset's texts, the column, and what stood there."""
    texts = [f.name for f in schemas.PRODUCTION_KEYS.fields if isinstance(f.dataType, T.StringType)]
    return checked.where(F.size(REJECTS) > 0).select(*texts, F.inline(REJECTS))


def count_rejects(checked: DataFrame, counts: Observation) -> DataFrame:
    """``checked``, which counts its rows and its lost cells by column while it is being written."""
    fields = [c for c in checked.columns if c != REJECTS]
    lost = lambda c: F.count_if(F.exists(REJECTS, lambda r: r["field"] == c))
    numbers = [f.name for f in checked.schema.fields if f.name in fields and not isinstance(f.dataType, T.StringType)]
    return checked.observe(counts, F.count(F.lit(1)).alias("rows"), *[lost(c).alias(c) for c in numbers])


def _typed(name: str, kind: T.DataType, heading: str | None = None) -> Column:
    source = F.col(f"`{heading or name}`")
    if isinstance(kind, T.StringType):
        return source.cast(kind).alias(name)
    if isinstance(kind, T.DoubleType):
        number = source.try_cast(kind)
        return F.when(~F.isnan(number), number).alias(name)
    # Whole numbers may be written as 7, 7.0 or 7e5.
    text = source.cast("string")
    return F.coalesce(text.try_cast(kind), text.try_cast("double").try_cast(kind)).alias(name)


def write_csv(df: DataFrame, path: str, headings: Mapping[str, str] | None = None) -> None:
    """CSV with a header; missing cells are blank. Headings replace column names."""
    renamed = df.select(*[F.col(f"`{c}`").alias((headings or {}).get(c, c)) for c in df.columns])
    renamed.write.mode("overwrite").csv(path, emptyValue="", **_CSV)
