"""Column-level helpers: safe names, text cleaning, tolerant casts, flags.

Every helper returns a ``Column`` built from built-in Spark expressions, so
it stays inside whole-stage codegen.  Casts use ``try_cast`` because Spark 4
runs with ANSI mode on, where a bad string raises instead of giving NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_col(name: str) -> Column:
    """Reference a column whose name may hold dots, quotes, parentheses,
    slashes or spaces (wide questionnaire headers)."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_col(c: str | Column) -> Column:
    return safe_col(c) if isinstance(c, str) else c


def clean_text(c: str | Column) -> Column:
    """Trim (spaces only, like SQL TRIM) and turn the empty string into NULL."""
    trimmed = F.trim(as_col(c).cast("string"))
    return F.when(trimmed == "", F.lit(None).cast("string")).otherwise(trimmed)


def tolerant_int(c: str | Column) -> Column:
    """String to int without failing: '29' and '29.0' give 29, '29.7' gives 29,
    blank or junk gives NULL."""
    text = F.trim(as_col(c).cast("string"))
    as_double = text.try_cast("double")
    return F.coalesce(text.try_cast("int"), as_double.try_cast("int"))


def tolerant_long(c: str | Column) -> Column:
    text = F.trim(as_col(c).cast("string"))
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def is_selected(c: str | Column, value: float = 1.0) -> Column:
    """A 0/1 multi-select cell is selected when it parses to the number 1
    ('1', '1.0', ' 1 '); blank, NULL, '0' and junk are not selected."""
    return F.coalesce(F.trim(as_col(c).cast("string")).try_cast("double") == F.lit(value), F.lit(False))


def not_blank(c: str | Column) -> Column:
    col = as_col(c)
    return col.isNotNull() & (F.trim(col) != "")


# --- the same helpers as SQL expression text --------------------------------
# Wide projections (hundreds of questionnaire columns) are built as one
# ``selectExpr`` call instead of several Py4J calls per column; Catalyst
# receives the identical expressions.

def ident(name: str) -> str:
    """Back-quoted identifier for any header text."""
    return "`" + name.replace("`", "``") + "`"


def sql_str(value: str) -> str:
    """Spark SQL string literal (backslash escapes are on by default)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def clean_text_sql(expr: str) -> str:
    return f"NULLIF(trim(CAST({expr} AS STRING)), '')"


def tolerant_int_sql(expr: str) -> str:
    text = f"trim(CAST({expr} AS STRING))"
    return f"COALESCE(TRY_CAST({text} AS INT), TRY_CAST(TRY_CAST({text} AS DOUBLE) AS INT))"


def tolerant_long_sql(expr: str) -> str:
    text = f"trim(CAST({expr} AS STRING))"
    return f"COALESCE(TRY_CAST({text} AS BIGINT), TRY_CAST(TRY_CAST({text} AS DOUBLE) AS BIGINT))"


def is_selected_sql(expr: str, value: float = 1.0) -> str:
    parsed = f"COALESCE(TRY_CAST(trim(CAST({expr} AS STRING)) AS DOUBLE) = {float(value)!r}D, false)"
    if float(value) != 1.0:
        return parsed
    # the common spellings are decided by a string compare; only other text
    # is parsed as a number (same result, far fewer parses)
    return (f"CASE WHEN {expr} IN ('1', '1.0') THEN true WHEN {expr} IS NULL OR {expr} IN ('0', '0.0', '') "
            f"THEN false ELSE {parsed} END")
