"""Pay-band text helpers: order key from the first amount, anomaly flag.

A band label is ordered by its first amount (thousands separators removed).  Misprinted options are kept but
flagged, and may get an explicit order key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_col


@dataclass(frozen=True)
class BandSpec:
    """How a questionnaire writes its bands; ``amount_pattern`` has one group
    around the digits of the first amount and their thousands separators."""
    amount_pattern: str
    thousands_sep: str = ""
    anomaly_prefixes: Sequence[str] = field(default_factory=tuple)
    anomaly_contains: Sequence[str] = field(default_factory=tuple)
    # label prefix -> order key used instead of the parsed first amount
    order_overrides: Mapping[str, int] = field(default_factory=dict)


def first_amount(c: str | Column, spec: BandSpec) -> Column:
    """First amount in the label as int; NULL when the label has none."""
    raw = F.regexp_extract(as_col(c), spec.amount_pattern, 1)
    digits = F.regexp_replace(raw, "[" + "\\" + spec.thousands_sep + "]", "") if spec.thousands_sep else raw
    return digits.try_cast("int")


def band_anomaly(c: str | Column, spec: BandSpec) -> Column:
    col = as_col(c)
    tests = [col.startswith(p) for p in spec.anomaly_prefixes] + [col.contains(s) for s in spec.anomaly_contains]
    if not tests:
        return F.lit(False)
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def band_order(c: str | Column, spec: BandSpec) -> Column:
    col = as_col(c)
    out = first_amount(col, spec)
    for prefix, key in reversed(list(spec.order_overrides.items())):
        out = F.when(col.startswith(prefix), F.lit(int(key))).otherwise(out)
    return out.cast("int")
