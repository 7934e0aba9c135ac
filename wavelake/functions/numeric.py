"""Share arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_col


def percent(part: str | Column, whole: str | Column, scale: int = 2) -> Column:
    """``round(part * 100.0 / whole, scale)`` as double (HALF_UP on the decimal
    text of the double, Spark's ``round``).  A zero base (a group whose ids
    are all NULL) gives NULL, as without ANSI mode, instead of failing."""
    return F.round(F.try_divide(as_col(part) * F.lit(100.0), as_col(whole)), scale)
