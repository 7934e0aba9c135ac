"""Wide 0/1 multi-select columns -> one long row per selected option.

Plan shape (per edition): one scan, ``unpivot`` of the option columns
(an ``Expand``), a filter on the parsed flag, and a broadcast join to the
option metadata.  The metadata has one row per option column of the header,
known when the plan is built.  A respondent who selected nothing in a block
yields no row (inner semantics).

De-duplication needs no text and no long rows: ``distinct_flags`` gives every
form row bit masks of its ticked options.  The masks of a respondent are
joined by ``bit_or`` in a hash aggregate, so that one row per form is shuffled
and held, however many options it ticks; the kept options are laid out
afterwards by a join with the broadcast option table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import clean_text_sql, ident, is_selected_sql, tolerant_int_sql
from ..functions.text import alias_py, classify_py
from . import discover
from .harmonize import union_waves


@dataclass(frozen=True)
class Option:
    """One option column and the literal values its selected rows carry."""
    header: str
    values: Mapping[str, str] = field(default_factory=dict)


def _id_sql(id_col: str, blank_as_null: bool) -> str:
    return clean_text_sql(ident(id_col)) if blank_as_null else f"trim(CAST({ident(id_col)} AS STRING))"


def _with_wave_sql(df: DataFrame, wave: int | str | Column) -> tuple[DataFrame, str]:
    """The wave as SQL text over ``df`` (a Column wave is added first)."""
    if isinstance(wave, Column):
        return df.withColumn("__wave", wave.cast("int")), "`__wave`"
    if isinstance(wave, str):
        return df, tolerant_int_sql(ident(wave))
    return df, f"CAST({int(wave)} AS INT)"


def options_frame(spark: SparkSession, options: Sequence[Option], columns: Sequence[str]) -> DataFrame:
    """One row per option: its number ``_slot`` and its literal values."""
    schema = T.StructType([T.StructField("_slot", T.IntegerType(), False)] +
                          [T.StructField(c, T.StringType(), True) for c in columns])
    rows = [(i, *[o.values.get(c) for c in columns]) for i, o in enumerate(options)]
    return spark.createDataFrame(rows, schema)


def unpivot_slots(df: DataFrame, id_col: str, wave: int | str | Column, headers: Mapping[int, str], id_name: str,
                  wave_name: str, blank_as_null: bool) -> DataFrame:
    """(id, wave, _slot, _v): one row per numbered column and row with an id."""
    df, wave_sql = _with_wave_sql(df, wave)
    base = df.selectExpr(
        f"{_id_sql(id_col, blank_as_null)} AS {ident(id_name)}", f"{wave_sql} AS {ident(wave_name)}",
        *[f"CAST({ident(h)} AS STRING) AS _f{i}" for i, h in headers.items()])
    return (base.unpivot([id_name, wave_name], [f"_f{i}" for i in headers], "_name", "_v")
            .filter(f"{ident(id_name)} IS NOT NULL")
            .selectExpr(ident(id_name), ident(wave_name), "CAST(substr(_name, 3) AS INT) AS _slot", "_v"))


def flags_to_long(df: DataFrame, id_col: str, wave: int | str | Column, options: Sequence[Option],
                  columns: Sequence[str], id_name: str = "entity_id", wave_name: str = "wave",
                  selected_value: float = 1.0, blank_as_null: bool = True) -> DataFrame:
    """Selected options as rows ``(id_name, wave_name, *columns)``.

    ``columns`` are the metadata keys carried by every ``Option.values``; a
    cell is selected when it parses to ``selected_value``."""
    if not options:
        raise ValueError("no option columns")
    headers = {i: o.header for i, o in enumerate(options)}
    long = unpivot_slots(df, id_col, wave, headers, id_name, wave_name, blank_as_null).filter(
        is_selected_sql("_v", selected_value))
    meta = F.broadcast(options_frame(df.sparkSession, options, columns))
    return long.join(meta, "_slot").select(id_name, wave_name, *columns)


#: columns of a form that are tested together, and groups of them in one mask,
#: which stays positive as a long
TOGETHER, GROUPS = 8, 7


def _masks_of(places: Iterable[int], words: int) -> list[int]:
    """Masks that hold the bits of these places."""
    out = [0] * words
    for n in places:
        out[n // (TOGETHER * GROUPS)] |= 1 << (n % (TOGETHER * GROUPS))
    return out


def row_masks(df: DataFrame, id_col: str, wave: int | str | Column, headers: Sequence[str], first: int, words: int,
              id_name: str, wave_name: str, blank_as_null: bool) -> DataFrame:
    """(id, wave, _m0, _m1, ...): the ticked columns of rows with an id as
    bits, at ``first`` (a multiple of ``TOGETHER``) and the places after it.

    A row is laid out in groups of columns, so that the code that tests cells
    is as long as one group whatever the width of the form: the JVM never
    compiles a method that tests a whole wide form."""
    df, wave_sql = _with_wave_sql(df, wave)
    base = df.selectExpr(
        f"{_id_sql(id_col, blank_as_null)} AS {ident(id_name)}", f"{wave_sql} AS {ident(wave_name)}",
        *[f"CAST({ident(h)} AS STRING) AS _f{i}" for i, h in enumerate(headers)])
    cells = [f"_f{i}" for i in range(len(headers))] + ["CAST(NULL AS STRING)"] * (-len(headers) % TOGETHER)
    groups = [", ".join([str((first + i) // TOGETHER), *cells[i:i + TOGETHER]]) for i in range(0, len(cells), TOGETHER)]
    names = ["_group", *[f"_v{i}" for i in range(TOGETHER)]]
    bits = " | ".join(f"CASE WHEN {is_selected_sql(f'_v{i}')} THEN {1 << i}L ELSE 0L END" for i in range(TOGETHER))
    own = [ident(id_name), ident(wave_name)]
    return (base.filter(f"{ident(id_name)} IS NOT NULL")
            .selectExpr(*own, f"stack({len(groups)}, {', '.join(groups)}) AS ({', '.join(names)})")
            .selectExpr(*own, "_group", f"{bits} AS _bits")
            .selectExpr(*own, *[f"CASE WHEN _group DIV {GROUPS} = {w} THEN shiftleft(_bits, _group % {GROUPS} * {TOGETHER}) "
                                f"ELSE 0L END AS _m{w}" for w in range(words)]))


def distinct_flags(parts: Sequence[tuple[DataFrame, str, int | str | Column, Sequence[Option]]],
                   columns: Sequence[str], keys: Sequence[str], order: Sequence[str], id_name: str = "entity_id",
                   wave_name: str = "wave", blank_as_null: bool = True) -> DataFrame:
    """``flags_to_long`` of several editions (frame, id column, wave, options),
    united and de-duplicated on (wave, id, *keys): of the options that name
    one item the first by ``order`` and then the other columns stays."""
    rest = [c for c in columns if c not in keys and c not in order]

    def rank(option: Option) -> list[tuple[bool, bytes]]:  # as Spark orders: NULL first, then by bytes
        return [(v is not None, (v or "").encode()) for v in (option.values.get(c) for c in [*order, *rest, *keys])]
    placed, first = [], []  # (place, option) of all; place of every edition's first
    end = 0
    for *_, options in parts:
        first.append(end)
        placed += enumerate(options, end)
        end += -(-len(options) // TOGETHER) * TOGETHER
    if not placed:
        raise ValueError("no option columns")
    words = -(-end // (TOGETHER * GROUPS))
    rows = [row_masks(df, id_col, wave, [o.header for o in options], at, words, id_name, wave_name, blank_as_null)
            for (df, id_col, wave, options), at in zip(parts, first) if options]
    forms = union_waves(rows).groupBy(id_name, wave_name).agg(*[F.bit_or(f"_m{w}").alias(f"_m{w}")
                                                                for w in range(words)])
    # an option is kept where it is ticked and no earlier one of its item is
    earlier: dict[tuple, list[int]] = {}
    found = []
    for n, option in sorted(placed, key=lambda x: rank(x[1])):
        same = earlier.setdefault(tuple(option.values.get(k) for k in keys), [])
        found.append((*_masks_of([n], words), *_masks_of(same, words), *[option.values.get(c) for c in columns]))
        same.append(n)
    schema = T.StructType([T.StructField(f"{part}{w}", T.LongType(), False) for part in ("_own", "_earlier")
                           for w in range(words)] + [T.StructField(c, T.StringType(), True) for c in columns])
    meta = F.broadcast(parts[0][0].sparkSession.createDataFrame(found, schema))

    def any_of(part: str) -> str:
        return " OR ".join(f"(_m{w} & {part}{w}) <> 0" for w in range(words))
    return (forms.join(meta, F.expr(f"({any_of('_own')}) AND NOT ({any_of('_earlier')})"))
            .select(id_name, wave_name, *columns))


# --- option builders (plan time, from the header only) ---------------------

def prefix_options(columns: Sequence[str], prefix: str, style: str, *, category_col: str, category: str,
                   item_col: str, original_col: str, class_col: str | None = None,
                   aliases: Mapping[str, str] | None = None,
                   class_rules: Sequence[tuple[str, str]] = (), default_class: str = "item",
                   extra: Mapping[str, str] | None = None) -> list[Option]:
    """Every column starting with ``prefix`` is an option; its label comes from
    the header, the item name is the alias of the label and its class is
    tested on the original label."""
    out = []
    for header in discover.by_prefix(columns, prefix):
        label = discover.header_label(header, style)
        values = {category_col: category, item_col: alias_py(label, aliases or {}), original_col: label}
        if class_col:
            values[class_col] = classify_py(label, class_rules, default_class)
        values.update(extra or {})
        out.append(Option(header, values))
    return out


def coded_options(columns: Sequence[str], prefix: str, codes: Mapping[int | str, str], style: str, *,
                  dimension_col: str, dimension: str, answer_col: str, original_col: str,
                  block_col: str | None = None, extra: Mapping[str, str] | None = None) -> list[Option]:
    """One option per numbered code ``prefix + n``: exactly one column must
    carry the code (``1`` never matches ``10``); the answer is the controlled
    code value and the original is the header label."""
    out = []
    for number, answer in codes.items():
        code = f"{prefix}{number}"
        header = discover.by_code(columns, code, style)
        values = {dimension_col: dimension, answer_col: answer,
                  original_col: discover.header_label(header, style)}
        if block_col:
            values[block_col] = prefix
        values.update(extra or {})
        out.append(Option(header, values))
    return out
