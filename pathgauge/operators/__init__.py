"""Reusable DataFrame operators."""

from pathgauge.operators.interpolate import interpolate_yearly
from pathgauge.operators.lookup import fixed_lookup, salted_join
from pathgauge.operators.ranking import average_rank_desc
from pathgauge.operators.reshape import prefixed_years, strict_pivot, unpivot_years
from pathgauge.operators.union import stack_named, stack_same

__all__ = [
    "average_rank_desc",
    "fixed_lookup",
    "interpolate_yearly",
    "salted_join",
    "prefixed_years",
    "stack_named",
    "stack_same",
    "strict_pivot",
    "unpivot_years",
]
