"""Questionnaire configuration: editions, field maps, blocks and rules.

An *edition* is one layout of the wide questionnaire (one or more waves share
it).  Everything that is specific to a questionnaire lives in these objects;
the operators only receive them as arguments.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from ..functions.bands import BandSpec
from ..operators.harmonize import Field


@dataclass(frozen=True)
class CodedBlock:
    """Numbered multi-select block: ``prefix + n`` for every code n."""
    dimension: str
    prefix: str
    codes: Mapping[int, str]
    comparability: str


@dataclass(frozen=True)
class CategoricalQuestion:
    dimension: str
    header: str
    rules: Sequence[tuple[str, str]]
    comparability: str
    block: str


@dataclass(frozen=True)
class Edition:
    name: str
    style: str                                   # discover.TUPLE / UNDERSCORE
    id_header: str
    profile_map: Mapping[str, str]               # canonical field -> raw header
    wave: int | str                              # literal wave, or raw header holding it
    # multi-select by prefix: category -> (prefix, question text, comparability)
    prefix_blocks: Mapping[str, tuple[str, str, str]] = field(default_factory=dict)
    coded_blocks: Sequence[CodedBlock] = ()
    categorical: Sequence[CategoricalQuestion] = ()
    coded_style: str = "space"                   # header form of numbered options


@dataclass(frozen=True)
class Questionnaire:
    fields: Sequence[Field]
    editions: Sequence[Edition]
    id_name: str = "entity_id"
    wave_name: str = "wave"
    dedupe_order: Sequence[str] = ()
    # which of two duplicated entities is kept where the order decides nothing:
    # False the one with missing answers first, True the one with answers
    dedupe_nulls_last: bool = False
    # blank ids / answers count as missing (True); False keeps the
    # reference's mixed handling (ids only trimmed, spaces-only answers kept)
    blank_as_null: bool = True
    # technologies-like multi-select
    aliases: Mapping[str, str] = field(default_factory=dict)
    class_rules: Sequence[tuple[str, str]] = ()
    item_class: str = "item"                    # class that counts as adoption
    # answers
    single_choice: str = "single_choice"
    multi_select: str = "multi_select"
    # indicators
    profile_dims: Sequence[str] = ()
    band_field: str = "pay_band"
    band_dims: Sequence[str] = ()
    band_overall: tuple[str, str] = ("overall", "all")
    band_spec: BandSpec | None = None            # needed for the pay indicators
