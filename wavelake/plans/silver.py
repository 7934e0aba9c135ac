"""Bronze editions -> the three silver tables, driven by a ``Questionnaire``.

* entities:   one typed row per (wave, entity)            -- harmonise + dedupe
* selections: one row per (wave, entity, category, item)  -- prefix multi-select
* answers:    one row per (wave, entity, dimension, answer)-- categorical + coded

Editions are unioned by name and de-duplicated once on the table key (one
shuffle).  Ticked options are de-duplicated as bit masks and get their labels
afterwards; single-choice answers, whose text decides, as text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators.answers import Categorical, answers_long
from ..operators.dedupe import dedupe
from ..operators.harmonize import harmonize, union_waves
from ..operators.multiselect import coded_options, distinct_flags, flags_to_long, prefix_options
from .config import Questionnaire

SELECTION_COLUMNS = ["category", "item", "item_original", "item_type", "question", "comparability"]
ANSWER_COLUMNS = ["dimension", "answer", "answer_original", "answer_type", "comparability", "block"]


def entities(q: Questionnaire, bronze: Mapping[str, DataFrame], deduplicate: bool = True) -> DataFrame:
    parts = []
    for e in q.editions:
        mapping = {q.fields[0].name: e.id_header, **e.profile_map}
        parts.append(harmonize(bronze[e.name], q.fields, mapping, e.wave, wave_name=q.wave_name))
    out = union_waves(parts)
    if not deduplicate:
        return out
    # the id first: it tells most rows apart where the aggregate sorts
    return dedupe(out, [q.id_name, q.wave_name], order=list(q.dedupe_order), nulls_last=q.dedupe_nulls_last)


def selection_options(q: Questionnaire, edition, columns):
    opts = []
    for category, (prefix, question, comparability) in edition.prefix_blocks.items():
        opts += prefix_options(columns, prefix, edition.style, category_col="category", category=category,
                               item_col="item", original_col="item_original", class_col="item_type",
                               aliases=q.aliases, class_rules=q.class_rules, default_class=q.item_class,
                               extra={"question": question, "comparability": comparability})
    return opts


def selections(q: Questionnaire, bronze: Mapping[str, DataFrame], deduplicate: bool = True) -> DataFrame:
    names = {"id_name": q.id_name, "wave_name": q.wave_name, "blank_as_null": q.blank_as_null}
    parts = [(bronze[e.name], e.id_header, e.wave, selection_options(q, e, bronze[e.name].columns))
             for e in q.editions]
    if deduplicate:
        return distinct_flags(parts, SELECTION_COLUMNS, ["category", "item"], ["item_original", "question"], **names)
    return union_waves([flags_to_long(*p, SELECTION_COLUMNS, **names) for p in parts])


def answer_inputs(q: Questionnaire, edition, columns):
    cats = [Categorical(c.header, c.rules, {"dimension": c.dimension, "answer_type": q.single_choice,
                                            "comparability": c.comparability, "block": c.block})
            for c in edition.categorical]
    flags = []
    for b in edition.coded_blocks:
        flags += coded_options(columns, b.prefix, b.codes, edition.coded_style, dimension_col="dimension",
                               dimension=b.dimension, answer_col="answer", original_col="answer_original",
                               block_col="block", extra={"answer_type": q.multi_select,
                                                         "comparability": b.comparability})
    return cats, flags


ANSWER_KEYS, ANSWER_ORDER = ["dimension", "answer"], ["block", "answer_original"]


def answers(q: Questionnaire, bronze: Mapping[str, DataFrame], deduplicate: bool = True) -> DataFrame:
    """The equivalent blocks of one dimension merge in the dedupe; the first
    block is kept."""
    names = {"id_name": q.id_name, "wave_name": q.wave_name, "blank_as_null": q.blank_as_null}
    inputs = [(e, bronze[e.name], *answer_inputs(q, e, bronze[e.name].columns)) for e in q.editions]
    if not deduplicate:
        return union_waves([answers_long(df, e.id_header, e.wave, cats, flags, ANSWER_COLUMNS, **names)
                            for e, df, cats, flags in inputs])
    keys, found = [q.id_name, q.wave_name, *ANSWER_KEYS], []
    texts = [answers_long(df, e.id_header, e.wave, cats, [], ANSWER_COLUMNS, **names)
             for e, df, cats, _ in inputs if cats]
    if texts:
        found.append(dedupe(union_waves(texts), keys, order=ANSWER_ORDER))
    coded = [(df, e.id_header, e.wave, flags) for e, df, _, flags in inputs]
    if any(flags for *_, flags in coded):
        found.append(distinct_flags(coded, ANSWER_COLUMNS, ANSWER_KEYS, ANSWER_ORDER, **names))
    both = {c.dimension for e in q.editions for c in e.categorical} & {
        b.dimension for e in q.editions for b in e.coded_blocks}
    out = union_waves(found)
    # a dimension asked both ways can have an answer in either form
    return dedupe(out, keys, order=ANSWER_ORDER) if both else out
