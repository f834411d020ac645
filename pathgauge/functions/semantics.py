"""Missing-value and division rules of the model, as Spark columns.

Missing is always NULL here. A value that would be "not a number" (0/0, an
empty weighted mean) is NULL as well, because Spark sorts and compares NaN as
the largest number and would push it into the best class.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pathgauge.functions.exact import exact_sum

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def total(value: ColumnLike, exact: bool = False, over=None) -> Column:
    """Sum as an aggregate, or as a window value; ``exact`` makes it the same in any order of rows."""
    if exact:
        return exact_sum(value, over)
    summed = F.sum(_col(value))
    return summed if over is None else summed.over(over)


def sum0(value: ColumnLike) -> Column:
    """Sum that is 0, not NULL, when no value is present."""
    return F.coalesce(F.sum(_col(value)), F.lit(0.0))


def if_else(condition: Column, yes, no) -> Column:
    """Two-way choice that is NULL when the condition is unknown."""
    return F.when(condition, yes).when(~condition, no)


def first_match(rules: Iterable[tuple[Column | str, object]], default=None) -> Column:
    """Value of the first rule that holds; an unknown rule counts as not met."""
    chain = F
    for condition, value in rules:
        holds = F.expr(condition) if isinstance(condition, str) else condition
        chain = chain.when(holds, value)
    return chain if default is None else chain.otherwise(default)


def recode(value: ColumnLike, mapping: dict[str, str], *, keep_other: bool) -> Column:
    """Replace listed values; others stay as they are or become NULL."""
    source = _col(value)
    return first_match(
        [(source == old, F.lit(new)) for old, new in mapping.items()],
        source if keep_other else None,
    )


def ratio(top: ColumnLike, bottom: ColumnLike) -> Column:
    """Quotient that is NULL when the divisor is 0."""
    return F.try_divide(_col(top), _col(bottom))


def floor_at_zero(value: ColumnLike) -> Column:
    source = _col(value)
    return F.when(source <= 0, F.lit(0.0)).otherwise(source)


def text_or(value: ColumnLike, fallback: str, also: Iterable[str] = ()) -> Column:
    """Text, or the fallback when it is missing or one of ``also``."""
    source = _col(value)
    missing = source.isNull()
    for marker in also:
        missing = missing | (source == marker)
    return F.when(missing, F.lit(fallback)).otherwise(source)


# --- weighted mean -----------------------------------------------------------
#
# A row with weight 0 never counts. One row with an unknown weight, or with a
# weight other than 0 and an unknown value, makes the whole mean unknown.
# The three terms below add up, so they can be summed in two steps: once per
# fine key before a shuffle and once per final key after it.


def weighted_terms(value: ColumnLike, weight: ColumnLike, prefix: str = "wm", exact: bool = False) -> list[Column]:
    x, w = _col(value), _col(weight)
    unknown = w.isNull() | ((w != 0) & x.isNull())
    return [
        F.count_if(unknown).alias(f"{prefix}_unknown"),
        total(F.when(w != 0, x * w), exact).alias(f"{prefix}_top"),
        total(w, exact).alias(f"{prefix}_weight"),
    ]


def merge_weighted_terms(prefix: str = "wm", exact: bool = False) -> list[Column]:
    unknown = F.sum(f"{prefix}_unknown").alias(f"{prefix}_unknown")
    return [unknown, *[total(f"{prefix}_{part}", exact).alias(f"{prefix}_{part}") for part in ("top", "weight")]]


def weighted_mean_from_terms(prefix: str = "wm") -> Column:
    return F.when(F.col(f"{prefix}_unknown") == 0, ratio(f"{prefix}_top", f"{prefix}_weight"))


def weighted_mean(value: ColumnLike, weight: ColumnLike, over=None, exact: bool = False) -> Column:
    """Weighted mean as an aggregate, or as a window value when ``over`` is given."""
    x, w = _col(value), _col(weight)
    unknown = F.count_if(w.isNull() | ((w != 0) & x.isNull()))
    if over is not None:
        unknown = unknown.over(over)
    return F.when(unknown == 0, ratio(total(F.when(w != 0, x * w), exact, over), total(w, exact, over)))
