"""Answers -> long rows: single-choice questions and numbered multi-select
blocks of one edition in a single pass.

Every answer column of the edition (categorical text and 0/1 flags) is
unpivoted once; a broadcast metadata table (one row per column, bounded by
the schema width) says what each column is.  Categorical text is normalised
by the question's ordered rules (first match wins, else the trimmed text);
flags keep the controlled code of their option.  One scan per edition,
whatever the number of questions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ident, is_selected_sql
from ..functions.text import ordered_rules_sql
from .multiselect import Option, options_frame, unpivot_slots


@dataclass(frozen=True)
class Categorical:
    """A single-choice question column and its normalisation rules."""
    header: str
    rules: Sequence[tuple[str, str]]
    values: Mapping[str, str] = field(default_factory=dict)


def answers_long(df: DataFrame, id_col: str, wave: int | str | Column, categorical: Sequence[Categorical],
                 flags: Sequence[Option], columns: Sequence[str], *, answer_name: str = "answer",
                 original_name: str = "answer_original", id_name: str = "entity_id", wave_name: str = "wave",
                 blank_as_null: bool = True, fold_accents: bool = False) -> DataFrame:
    """Rows ``(id, wave, *columns)``; ``columns`` must include ``answer_name``
    and ``original_name``.  Flag options carry both in ``Option.values``; for
    categorical questions they come from the text."""
    n_cat = len(categorical)
    options = [Option(c.header, c.values) for c in categorical] + list(flags)
    headers = {i: o.header for i, o in enumerate(options)}
    # what a column is follows from its number, so cells that are no answer go
    # before the join
    long = unpivot_slots(df, id_col, wave, headers, id_name, wave_name, blank_as_null)
    text_ok = "NULLIF(trim(_v), '') IS NOT NULL" if blank_as_null else "_v IS NOT NULL"
    long = long.filter(f"CASE WHEN _slot >= {n_cat} THEN {is_selected_sql('_v')} ELSE {text_ok} END")
    meta = F.broadcast(options_frame(df.sparkSession, options, columns))
    code = "CASE " + " ".join(
        f"WHEN _slot = {i} THEN {ordered_rules_sql('_v', c.rules, fold_accents)}"
        for i, c in enumerate(categorical)) + " END" if categorical else "CAST(NULL AS STRING)"
    own = {answer_name: code, original_name: "trim(_v)"}
    return long.join(meta, "_slot").selectExpr(
        ident(id_name), ident(wave_name),
        *[f"CASE WHEN _slot >= {n_cat} THEN {ident(c)} ELSE {own[c]} END AS {ident(c)}" if c in own else ident(c)
          for c in columns])
