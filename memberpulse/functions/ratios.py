"""Ratio metrics.

Division is always ``try_divide`` (ANSI mode would raise on a zero divisor).
Rounding is half-even (``bround``), as pandas/numpy ``round`` intends.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def zero_ratio(num, den, places: int) -> Column:
    """``num / den`` rounded half-even; ±inf and NaN become 0 (report ratios, RAT1–RAT3)."""
    q = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return F.bround(F.coalesce(q, F.lit(0.0)), places) + F.lit(0.0)   # + 0.0 turns -0.0 into 0.0


def null_ratio(num, den, places: int) -> Column:
    """``num / den`` rounded half-even; NULL when ``den`` is 0 (KPI ratios, RAT4–RAT7, D7)."""
    q = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return F.bround(q, places) + F.lit(0.0)
