"""Deterministic de-duplication.

``dropDuplicates`` keeps an arbitrary row per key.  Here the kept row is the
smallest by a caller-given order (then by every remaining column, so the
choice is total).  It is an aggregate, not a window: ``min(struct(...))``
combines map-side before the shuffle, so a hot key (or the NULL key) that
holds a third of the rows is reduced to one row per map task instead of
landing whole in one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_col


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None,
           nulls_last: bool = False) -> DataFrame:
    """One row per ``keys``: the first by ``order`` ascending, ties broken by
    the remaining columns; a NULL is the least value, or with ``nulls_last``
    the greatest.  NULL keys form one group, as in
    ``dropDuplicates``.  Column order of ``df`` is kept."""
    cols = list(df.columns)
    rest = [c for c in cols if c not in keys]
    order = list(order or [])
    order_exprs = [(safe_col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    if not rest:
        return df.select(*[safe_col(k) for k in keys]).distinct().select(*[safe_col(c) for c in cols])
    parts = [*order_exprs, *[safe_col(c).alias(f"_v{i}") for i, c in enumerate(rest)]]
    if nulls_last:
        parts = [x for p in parts for x in (p.isNull(), p)]
    best = F.min(F.struct(*parts)).alias("_best")
    agg = df.groupBy(*[safe_col(k) for k in keys]).agg(best)
    out = {c: safe_col(c) for c in keys}
    out.update({c: F.col("_best").getField(f"_v{i}").alias(c) for i, c in enumerate(rest)})
    return agg.select(*[out[c] for c in cols])
