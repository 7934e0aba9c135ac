"""Wave harmonisation: map each edition's raw headers onto one typed schema.

A ``Field`` names a canonical column, its kind (how the raw string becomes a
typed value) and, per edition, the raw header it comes from.  ``harmonize``
is one ``select``: no row-level Python, so Catalyst prunes every raw column
that is not mapped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame

from ..functions.columns import clean_text_sql, ident, tolerant_int_sql, tolerant_long_sql

TEXT = "text"        # trim, blank -> NULL
RAW = "raw"          # as string, untouched
INT = "int"          # tolerant int ('29', '29.0', junk -> NULL)
LONG = "long"


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = TEXT


def _convert(expr: str, kind: str) -> str:
    if kind == TEXT:
        return clean_text_sql(expr)
    if kind == INT:
        return tolerant_int_sql(expr)
    if kind == LONG:
        return tolerant_long_sql(expr)
    if kind == RAW:
        return f"CAST({expr} AS STRING)"
    raise ValueError(f"unknown field kind {kind!r}")


def harmonize(df: DataFrame, fields: Sequence[Field], mapping: Mapping[str, str],
              wave: int | str | Column, wave_name: str = "wave",
              wave_position: int = 1) -> DataFrame:
    """Project ``df`` onto ``fields`` using ``mapping`` (canonical -> raw header).

    ``wave`` is a literal (one file per wave), a raw column name or a Column;
    the wave column is placed at ``wave_position``."""
    missing = [f.name for f in fields if f.name not in mapping]
    if missing:
        raise ValueError(f"no raw header mapped for {missing}")
    absent = [mapping[f.name] for f in fields if mapping[f.name] not in df.columns]
    if absent:
        raise ValueError(f"headers not in the input: {absent}")
    if isinstance(wave, Column):
        df = df.withColumn("__wave", wave)
        wave_sql = "`__wave`"
    elif isinstance(wave, str):
        wave_sql = tolerant_int_sql(ident(wave))
    else:
        wave_sql = str(int(wave))
    exprs = [f"{_convert(ident(mapping[f.name]), f.kind)} AS {ident(f.name)}" for f in fields]
    exprs.insert(wave_position, f"CAST({wave_sql} AS INT) AS {ident(wave_name)}")
    # one selectExpr for the whole mapped schema (one JVM call, same plan)
    return df.selectExpr(*exprs)


def union_waves(parts: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by column name (editions may order columns differently)."""
    if not parts:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), parts)
