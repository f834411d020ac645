"""Sums of doubles that don't depend on the order in which rows are added.

A double sum differs in its last bits with the partitions its rows come from, and
a ladder or the sign of a score that compares two sums may then differ as well.
Here every value is cut into fixed-point limbs. The limbs are whole numbers, so
they add up alike in any order; the total is rounded to a double once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

ColumnLike = Column | str

#: Bits of a limb. A limb is at most 2 ** 23 on either side, so a long holds the sum of 2 ** 39 of them.
LIMB_BITS = 24
#: Limbs of a value; the lowest counts units of 2 ** LOWEST. Finer bits are rounded away value by value.
LIMBS, LOWEST = 10, -120
#: Values must stay below this; with 10 limbs from 2 ** -120 on, 2 ** 119.
LIMIT = 2.0 ** (LIMBS * LIMB_BITS + LOWEST - 1)


def _limbs(value: Column) -> list[Column]:
    """Whole numbers l with value = sum of l[k] * 2 ** (LOWEST + k * LIMB_BITS), lowest first.

    Rounded at each limb's unit, the value is a whole number that a double holds;
    a limb is what two neighbouring roundings differ by, which no step rounds.
    """
    known = F.when(
        value.isNotNull() & ~(F.abs(value) < LIMIT),
        F.raise_error(F.concat(F.lit("outside the range of an exact sum: "), value.cast("string"))).cast("double"),
    ).otherwise(value)
    at = [F.rint(known * F.lit(2.0 ** -(LOWEST + k * LIMB_BITS))) for k in range(LIMBS)]
    carried = [*at[1:], F.lit(0.0)]
    return [(own - upper * F.lit(2.0**LIMB_BITS)).cast("long") for own, upper in zip(at, carried)]


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _carried(limbs: Column) -> Column:
    """Every limb from 0 up to its unit, and on top what is left, with the number's sign."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("limbs"))
    unit = F.lit(1 << LIMB_BITS).cast("long")

    def step(done: Column, limb: Column) -> Column:
        total = limb + done["carry"]
        own = F.pmod(total, unit)
        return F.struct(F.call_function("div", total - own, unit).alias("carry"), F.concat(done["limbs"], F.array(own)).alias("limbs"))

    return F.aggregate(limbs, start, step, lambda done: F.concat(done["limbs"], F.array(done["carry"])))


def _magnitude(limbs: Column) -> Column:
    """The double nearest to carried limbs that are not negative."""
    wide = lambda x: x.cast("decimal(38,0)")

    def from_top(top: Column) -> Column:
        def limb(down: int) -> Column:
            return wide(F.coalesce(F.get(limbs, top - down), F.lit(0).cast("long")))

        # Four limbs from the top one that isn't 0 hold 73 bits or more; the rest counts as one bit below them.
        unit = F.lit(1 << LIMB_BITS).cast("decimal(9,0)")
        lead = reduce(lambda total, down: wide(wide(total * unit) + limb(down)), (1, 2, 3), limb(0))
        below = F.exists(F.slice(limbs, F.lit(1), F.greatest(top - 3, F.lit(0))), lambda x: x != 0)
        lead = wide(lead * F.lit(2).cast("decimal(1,0)")) + wide(F.when(below, 1).otherwise(0))
        return lead.cast("double") * F.pow(F.lit(2.0), (LOWEST - 1 + LIMB_BITS * (top - 3)).cast("double"))

    places = F.transform(limbs, lambda limb, at: F.when(limb != 0, at).otherwise(0))
    return _once(F.array_max(places), from_top)


def _rounded(sums: Column) -> Column:
    """The double nearest to what an array of limb sums stands for (of two as near, the even one)."""

    def signed(carried: Column) -> Column:
        negated = _once(_carried(F.transform(carried, lambda x: -x)), _magnitude)
        return F.when(F.element_at(carried, -1) < 0, -negated).otherwise(_magnitude(carried))

    return _once(_carried(sums), signed)


def exact_sum(value: ColumnLike, over: WindowSpec | None = None) -> Column:
    """Sum that is the double nearest to the exact total, as an aggregate or a window value.

    NULL if there is no value. Right to the last bit if no value has bits below
    2 ** LOWEST; finer ones are rounded first, value by value, so the result
    still is the same in any order. A value of LIMIT or more, infinite or not a
    number is an error.
    """
    source = (F.col(value) if isinstance(value, str) else value).cast("double")
    sums = [F.sum(limb) for limb in _limbs(source)]
    if over is not None:
        sums = [total.over(over) for total in sums]
    return F.when(~reduce(or_, [s.isNull() for s in sums]), _rounded(F.array(*sums)))
