"""Answer normalisation as data-driven Spark expressions.

* ``ordered_rules``: first-match-wins list of (phrase, code) tested with
  ``contains`` on ``lower(trim(text))``; unmatched text keeps its trimmed
  original, so it still counts.
* ``alias``: exact-match rename table (identity by default).
* ``classify``: ordered (phrase, class) list on the lower-cased label,
  with a default class.

Rules are configuration: callers pass them; nothing here is specific to one
questionnaire.  No accent folding is done unless asked (``fold_accents``).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_col

Rules = Sequence[tuple[str, str]]


def fold(text: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFD", text) if unicodedata.category(ch) != "Mn")


def _latin_accents() -> tuple[str, str]:
    """Accented Latin letters (Latin-1 and Latin Extended-A blocks) and their
    base letters, generated from Unicode decomposition."""
    src, dst = [], []
    for code in range(0x00C0, 0x0180):
        ch = chr(code)
        base = fold(ch)
        if base != ch and len(base) == 1 and base.isascii():
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


_ACCENTS = _latin_accents()


def _fold_col(c: Column) -> Column:
    # one translate() call: built-in, stays in codegen
    return F.translate(c, _ACCENTS[0], _ACCENTS[1])


def ordered_rules(c: str | Column, rules: Rules, fallback: str | Column | None = "trimmed",
                  fold_accents: bool = False) -> Column:
    """First rule whose phrase is contained in lower(trim(c)) gives the code.

    ``fallback='trimmed'`` keeps trim(c) when nothing matches; pass a Column or
    None to choose another default."""
    original = F.trim(as_col(c).cast("string"))
    probe = F.lower(original)
    phrases = [(p.lower(), code) for p, code in rules]
    if fold_accents:
        probe = _fold_col(probe)
        phrases = [(fold(p), code) for p, code in phrases]
    if isinstance(fallback, Column):
        out = fallback
    elif fallback == "trimmed":
        out = original
    elif fallback is None:
        out = F.lit(None).cast("string")
    else:
        out = F.lit(fallback)
    for phrase, code in reversed(phrases):
        out = F.when(probe.contains(phrase), F.lit(code)).otherwise(out)
    return out


def ordered_rules_sql(expr: str, rules: Rules, fold_accents: bool = False) -> str:
    """``ordered_rules`` as SQL text (first match wins, else trim(expr))."""
    from .columns import sql_str
    original = f"trim(CAST({expr} AS STRING))"
    probe = f"lower({original})"
    phrases = [(p.lower(), code) for p, code in rules]
    if fold_accents:
        probe = f"translate({probe}, {sql_str(_ACCENTS[0])}, {sql_str(_ACCENTS[1])})"
        phrases = [(fold(p), code) for p, code in phrases]
    if not phrases:
        return original
    whens = " ".join(f"WHEN contains({probe}, {sql_str(p)}) THEN {sql_str(c)}" for p, c in phrases)
    return f"CASE {whens} ELSE {original} END"


def alias(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Exact-match rename after trimming; values not in the table pass through."""
    trimmed = F.trim(as_col(c).cast("string"))
    if not mapping:
        return trimmed
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, trimmed), trimmed)


def classify(c: str | Column, rules: Rules, default: str) -> Column:
    """Ordered (phrase, class) tests on lower(label); ``default`` otherwise."""
    return ordered_rules(c, rules, fallback=F.lit(default))


def alias_py(label: str, mapping: Mapping[str, str]) -> str:
    label = label.strip()
    return mapping.get(label, label)


def classify_py(label: str, rules: Rules, default: str) -> str:
    low = label.lower()
    for phrase, cls in rules:
        if phrase.lower() in low:
            return cls
    return default
