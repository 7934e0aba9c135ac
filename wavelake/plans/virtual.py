"""A questionnaire derived from the driver's TPC-H-like tables.

One *response* is one order: the respondent is the customer, the wave is the
order year.  A customer with several orders in a year is a duplicated
respondent, resolved by the entity dedupe (lowest order key kept).  The wide
0/1 option columns are the order's line items:

* prefix blocks (selections): part type, part item and part colour (from
  ``p_name``), return flag;
* numbered blocks (answers): brand bought, split in two equivalent blocks by
  line status (finished / open lines), and discount level;
* single-choice questions (answers): order priority; order status text in the
  last edition only;
* profile: segment, nation, region, status, an age-like number from the
  account balance, and a pay-band-like label from the order total.

Waves 1995-1996 use tuple-style headers, 1997-1998 dotted codes, 1999 on the
dotted codes shifted the way later editions renumber questions.  Flags are
written '1'/'0', '1.0'/'0.0' and '1'/'' respectively.  Everything is built
with DataFrame operations over the whole tables.

Rows are spoiled by the order key, so that every cleaning rule has work: ids
and answers that are NULL or blank, ages that are no number, a segment with
quotes, and one option printed twice in two spellings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bands import BandSpec
from ..operators.discover import TUPLE, UNDERSCORE
from ..operators.harmonize import INT, LONG, TEXT, Field
from ..functions.columns import ident, sql_str
from ..session import scratch_path
from ..sources.parquet import write_partitioned
from . import survey_preset as P
from .config import CategoricalQuestion, CodedBlock, Edition, Questionnaire

# Fixed values of the virtual questionnaire (its option lists and labels).
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PART_ITEMS = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]
PART_COLORS = ["blue", "cold", "hot", "large", "new", "old", "red", "small"]
RETURN_LABELS = {"A": "Accepted return", "N": "No return", "R": "Returned"}
STATUS_TEXT = {"F": "Fulfilled", "O": "Open", "P": 'Partial "split" shipment'}
N_BRANDS = 25
DISCOUNT_LEVELS = {1: "no_discount", 2: "low_discount", 3: "mid_discount", 4: "high_discount"}
DISCOUNT_LABELS = {1: "No discount", 2: "Discount 1-3%", 3: "Discount 4-7%", 4: "Discount 8% or more"}
BAND_EDGES = [50_000, 100_000, 150_000, 200_000, 300_000, 400_000]
NO_BAND = "Prefiro não informar"
OTHER = "other"
# a part type that the form offers twice, in both spellings of its label
TWICE = "PROMO"

PRIORITY_RULES = [("not specified", "not_specified"), ("specified", "specified"),
                  ("urgent", "urgent"), ("high", "high")]
STATUS_RULES = [('"split"', "partial_split"), ("fulfilled", "fulfilled"), ("partial", "partial")]
CLASS_RULES = [("no return", "no_use"), ("other", "other_answer")]

E1, E2, E3 = "e1", "e2", "e3"
# first wave of editions 2 and 3; every earlier wave is edition 1, every later one edition 3
EDITION_START = {E2: 1997, E3: 1999}


def amount(n: int) -> str:
    return f"{n:,}".replace(",", ".")


def band_labels() -> list[str]:
    edges = BAND_EDGES
    labels = [f"Menos de R$ {amount(edges[0])}/mês"]
    labels += [f"de R$ {amount(lo + 1)}/mês a R$ {amount(hi)}/mês" for lo, hi in zip(edges, edges[1:])]
    labels.append(f"Acima de R$ {amount(edges[-1])}/mês")
    return labels


# Misprinted options, one per edition, as they would appear in the form.
MISPRINTS = {E1: ("de R$ 50.001/", "de R$ 501/"), E3: ("a R$ 400.000/", "a R$ 400000/")}

BAND_SPEC = BandSpec(amount_pattern=r"R\$\s*([0-9\.]+)", thousands_sep=".", anomaly_prefixes=("de R$ 501/",),
                     anomaly_contains=("a R$ 400000/",), order_overrides={"de R$ 501/": 50_001})

FIELDS = [Field("entity_id", TEXT), Field("response_id", LONG), Field("age", INT), Field("segment"),
          Field("nation"), Field("region"), Field("priority"), Field("status"), Field("pay_band")]


def _labels(edition: str) -> dict[str, list[str]]:
    def title(s: str) -> str:
        return s[:1].upper() + s[1:].lower()
    types = PART_TYPES + ["OTHER"]
    return {
        "part_type": [*types, title(TWICE)] if edition == E1 else [*map(title, types), TWICE],
        "part_item": PART_ITEMS + [OTHER],
        "part_color": PART_COLORS + [OTHER],
        "returns": list(RETURN_LABELS.values()) + ["Other return status"],
    }


# the wave of the survey preset whose headers an edition carries
LIKE = {E1: 2023, E2: 2024, E3: 2025}


def _prefixes(edition: str) -> dict[str, str]:
    p = P.TECH_PREFIXES[LIKE[edition]]
    return {"part_type": p["linguagem"], "part_item": p["banco_dados"], "part_color": p["cloud"], "returns": p["bi"]}


QUESTIONS = {
    E1: {"part_type": "Which part types did the order include?", "part_item": "Which items?",
         "part_color": "Which colour words?", "returns": "Return status of the lines"},
    E2: {"part_type": "part_type_(per_order)", "part_item": "part_item_(per_order)",
         "part_color": "part_color_(per_order)", "returns": "return_status_(per_order)"},
    E3: {"part_type": "part_type_(per_order)", "part_item": "part_item_(per_order)",
         "part_color": "colour_word_(per_order)", "returns": "return_status_(per_order)"},
}
SEMANTIC_ATTENTION = {(E1, "part_color"), (E3, "returns")}


def _coded_prefixes(edition: str) -> dict[str, list[str]]:
    of = {}
    for block in P.CODED_BLOCKS[LIKE[edition]]:
        of.setdefault(block.dimension, []).append(block.prefix)
    return {"brand_bought": of["tipo_uso_empresa"], "discount_level": of["produtividade_pessoal"]}


BRAND_CODES = {n: f"brand_{n:02d}" for n in range(1, N_BRANDS + 1)} | {N_BRANDS + 1: "brand_other"}
BRAND_LABELS = {n: f"Brand#{n}" for n in range(1, N_BRANDS + 1)} | {N_BRANDS + 1: "Brand other"}


def _profile_map(edition: str) -> dict[str, str]:
    p = P.PROFILE_MAPS[LIKE[edition]]
    own = {"response_id": "('P0_r', 'resposta')", "nation": "('P1_i_1 ', 'Pais onde mora')"} if edition == E1 else \
        {"response_id": "0.b_resposta", "nation": "1.i.1_pais_onde_mora"}
    return {"response_id": own["response_id"], "age": p["idade"], "segment": p["genero"], "nation": own["nation"],
            "region": p["regiao"], "priority": P.QUESTIONS[LIKE[edition]][0].header, "status": p["situacao_trabalho"],
            "pay_band": p["faixa_salarial_original"]}


def _id_header(edition: str) -> str:
    return P.PROFILE_MAPS[LIKE[edition]][P.ID]


def _wave_header(edition: str) -> str:
    return "('P0_a', 'ano')" if edition == E1 else "0.c_ano"


def _flag_header(edition: str, prefix: str, n: int, label: str) -> str:
    if edition == E1:
        return f"{prefix}{n} ', '{label}')"
    return f"{prefix}{n}_{label}"


def _coded_header(edition: str, prefix: str, n: int, label: str) -> str:
    if edition == E1:
        return f"('{prefix}{n} ', '{label}')"
    return f"{prefix}{n} {label}"


def _status_header(edition: str) -> str | None:
    return P.QUESTIONS[LIKE[edition]][1].header if edition == E3 else None


def questionnaire() -> Questionnaire:
    editions = []
    for name in (E1, E2, E3):
        prefixes = _prefixes(name)
        blocks = {c: (prefixes[c], QUESTIONS[name][c],
                      "semantic_attention" if (name, c) in SEMANTIC_ATTENTION else "comparable")
                  for c in prefixes}
        coded = []
        for dim, pfx in _coded_prefixes(name).items():
            codes = BRAND_CODES if dim == "brand_bought" else DISCOUNT_LEVELS
            coded += [CodedBlock(dim, p, codes, "comparable_all_editions") for p in pfx]
        cats = [CategoricalQuestion("order_priority", _profile_map(name)["priority"], PRIORITY_RULES,
                                    "comparable_all_editions", "P3_e / 3.e")]
        if _status_header(name):
            cats.append(CategoricalQuestion("order_status", _status_header(name), STATUS_RULES,
                                            "last_edition_only", "3.g"))
        editions.append(Edition(name=name, style=TUPLE if name == E1 else UNDERSCORE, id_header=_id_header(name),
                                profile_map=_profile_map(name), wave=_wave_header(name),
                                prefix_blocks=blocks, coded_blocks=coded,
                                categorical=cats, coded_style=TUPLE if name == E1 else "space"))
    aliases = {t: t[:1] + t[1:].lower() for t in PART_TYPES + ["OTHER"]}
    return Questionnaire(fields=FIELDS, editions=editions, dedupe_order=["response_id"], aliases=aliases,
                         class_rules=CLASS_RULES, item_class="item",
                         profile_dims=["segment", "region", "nation", "status"],
                         band_field="pay_band", band_dims=["segment", "region", "status"],
                         band_overall=("overall", "all"), band_spec=BAND_SPEC)


# --- bronze ------------------------------------------------------------------

def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _option_bits() -> dict[str, tuple[str, int]]:
    """Every 0/1 option of the virtual form -> (mask column, bit).  Two long
    masks hold all options; a line sets the bits of its options.  The option
    lists are fixed in this module, at most 63 per mask."""
    keys = ([f"type_{i}" for i in range(len(PART_TYPES) + 1)] + [f"item_{i}" for i in range(len(PART_ITEMS) + 1)] +
            [f"color_{i}" for i in range(len(PART_COLORS) + 1)] + [f"return_{i}" for i in range(len(RETURN_LABELS) + 1)] +
            [f"discount_{n}" for n in DISCOUNT_LEVELS])
    bits = {k: ("mask_a", i) for i, k in enumerate(keys)}
    brands = [f"brand_f_{n}" for n in BRAND_CODES] + [f"brand_o_{n}" for n in BRAND_CODES]
    bits.update({k: ("mask_b", i) for i, k in enumerate(brands)})
    assert len(keys) <= 63 and len(brands) <= 63
    return bits


def _bit_of(col: Column, values, prefix: str) -> Column:
    """The bit of the option ``prefix_i`` whose value ``col`` has; of the one
    after the last, which is "other", for any other value or NULL."""
    bits = [1 << _option_bits()[f"{prefix}_{i}"][1] for i in range(len(values) + 1)]
    out = F
    for v, bit in zip(values, bits):
        out = out.when(col == v, F.lit(bit).cast("long"))
    return out.otherwise(F.lit(bits[-1]).cast("long"))


def _part_masks(part: DataFrame) -> DataFrame:
    """Per part, the bits of its type, item and colour, and its brand number:
    the text of a part is taken apart once and not for each of its lines."""
    words = F.split(F.col("p_name"), " ")
    brand_no = F.regexp_extract("p_brand", r"#(\d+)$", 1).try_cast("int")
    mask = (_bit_of(F.col("p_type"), PART_TYPES, "type")
            .bitwiseOR(_bit_of(F.get(words, F.lit(1)), PART_ITEMS, "item"))
            .bitwiseOR(_bit_of(F.get(words, F.lit(0)), PART_COLORS, "color")))
    return part.select("p_partkey", mask.alias("part_mask"),
                       F.when(brand_no.between(1, N_BRANDS), brand_no).otherwise(F.lit(N_BRANDS + 1)).alias("brand"))


def _line_masks(li: DataFrame, part: DataFrame) -> DataFrame:
    """Per line, the two option bitmasks (pure expressions); what the line
    itself says is a mask before the join, so that no text is shuffled."""
    bits = _option_bits()
    level = {n: F.lit(1 << bits[f"discount_{n}"][1]).cast("long") for n in DISCOUNT_LEVELS}
    discount = (F.when(F.col("l_discount") <= 0.0, level[1]).when(F.col("l_discount") < 0.035, level[2])
                .when(F.col("l_discount") < 0.075, level[3]).otherwise(level[4]))
    own = _bit_of(F.col("l_returnflag"), RETURN_LABELS, "return").bitwiseOR(discount)
    first_o = bits["brand_o_1"][1]
    block = F.when(F.col("l_linestatus") == "F", F.lit(0)).when(F.col("l_linestatus").isNotNull(), F.lit(first_o))
    lines = li.select("l_orderkey", "l_partkey", own.alias("own"), block.alias("block"))
    joined = lines.join(_part_masks(part), F.col("l_partkey") == F.col("p_partkey"), "left")
    # a line without a part has the "other" options
    no_part = sum(1 << bits[k][1] for k in (f"type_{len(PART_TYPES)}", f"item_{len(PART_ITEMS)}",
                                            f"color_{len(PART_COLORS)}"))
    mask_a = F.col("own").bitwiseOR(F.coalesce("part_mask", F.lit(no_part).cast("long")))
    shift = F.coalesce("brand", F.lit(N_BRANDS + 1)) - F.lit(1) + F.col("block")
    mask_b = F.coalesce(F.call_function("shiftleft", F.lit(1).cast("long"), shift), F.lit(0).cast("long"))
    return joined.select("l_orderkey", mask_a.alias("mask_a"), mask_b.alias("mask_b"))


def base_responses(spark: SparkSession, sf_dir: str, with_flags: bool = True) -> DataFrame:
    """One row per order with typed attributes and (optionally) the two
    option bitmasks of its lines."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                   "o_orderdate", "o_orderpriority")
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation/region are dimension tables of a few rows; Catalyst/AQE choose the
    # join strategy from their measured size
    base = (orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
            .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
            .join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
                    "c_acctbal", "c_mktsegment", "n_name", "r_name", F.year("o_orderdate").alias("wave")))
    if not with_flags:
        return base
    # two bit_or aggregates per order instead of one aggregate per option;
    # partial aggregation runs map-side, the shuffle is on the order key
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus", "l_discount")
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name", "p_brand")
    flags = _line_masks(li, part).groupBy("l_orderkey").agg(
        F.bit_or("mask_a").alias("mask_a"), F.bit_or("mask_b").alias("mask_b"))
    return base.join(flags, base.o_orderkey == flags.l_orderkey, "left").drop("l_orderkey")


def _input_key(spark: SparkSession, sf_dir: str) -> tuple:
    """Identity of the inputs (paths, sizes, modification times) in this
    session, so a stored base is reused only for the same data."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for name in ("orders", "customer", "nation", "region", "lineitem", "part"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(conf)
        for st in fs.listStatus(path):
            parts.append(f"{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}")
    return (spark.sparkContext.applicationId, *sorted(parts))


_BASES: dict[tuple, str] = {}


def prepare(spark: SparkSession, sf_dir: str) -> str:
    """Derive the response base of ``sf_dir`` (with the option masks), once
    per session and input, into a folder of its own below the session's
    scratch folder; returns the folder.  Nothing is shared between sessions,
    so builds cannot collide, and the scratch goes with the session."""
    key = _input_key(spark, sf_dir)
    if key not in _BASES:
        path = scratch_path(spark, "base")
        # partitioned by wave: each edition's scan prunes to its own waves
        write_partitioned(base_responses(spark, sf_dir, True), path, ["wave"])
        _BASES[key] = path
    return _BASES[key]


def stored_base(spark: SparkSession, sf_dir: str, with_flags: bool = True) -> DataFrame:
    """The response base as stored by ``prepare`` (the bronze layer of the
    virtual form).  It cuts the lineage: the three editions and all silver
    queries scan this compact table instead of re-deriving it from lineitem
    each time; profile-only reads prune the mask columns."""
    base = spark.read.parquet(prepare(spark, sf_dir))
    return base if with_flags else base.drop("mask_a", "mask_b")


def _flag_sql(key: str) -> str:
    mask, i = _option_bits()[key]
    return f"({mask} & {1 << i}L) <> 0"


def _flag_text(edition: str, key: str) -> str:
    on = _flag_sql(f"type_{PART_TYPES.index(TWICE)}" if key == "type_twice" else key)
    if key == "type_twice":  # ticked as well by some of those who ticked the first spelling
        on += " AND o_orderkey % 3 = 0"
    yes, no = {E1: ("'1'", "'0'"), E2: ("'1.0'", "'0.0'")}.get(edition, ("'1'", "''"))
    return f"IF({on}, {yes}, {no})"


def _age_text(edition: str) -> str:
    age = "CAST(20 + floor((c_acctbal + 1000.0D) / 250.0D) AS INT)"
    shown = f"format_string('%d.0', {age})" if edition == E2 else f"CAST({age} AS STRING)"
    missing = "'n/a'" if edition == E3 else "''"
    return (f"CASE WHEN c_acctbal < 0 THEN {missing} WHEN o_orderkey % 13 = 4 THEN 'abc' "
            f"WHEN o_orderkey % 13 = 5 THEN concat(' ', CAST({age} AS STRING), '.7 ') ELSE {shown} END")


def _pay_text(edition: str) -> str:
    labels = band_labels()
    whens = " ".join(f"WHEN o_totalprice <= {float(edge)!r}D THEN {sql_str(label)}"
                     for edge, label in zip(BAND_EDGES, labels))
    text = f"CASE {whens} ELSE {sql_str(labels[-1])} END"
    if edition in MISPRINTS:
        good, bad = MISPRINTS[edition]
        text = f"replace({text}, {sql_str(good)}, {sql_str(bad)})"
    return (f"CASE WHEN o_orderkey % 17 = 6 THEN ' ' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {sql_str(NO_BAND)} "
            f"ELSE {text} END")


def _status_text() -> str:
    whens = " ".join(f"WHEN o_orderstatus = {sql_str(k)} THEN {sql_str(v)}" for k, v in STATUS_TEXT.items())
    return f"CASE {whens} END"


def edition_filter_sql(edition: str) -> str:
    if edition == E1:
        return f"wave < {EDITION_START[E2]}"
    if edition == E2:
        return f"wave >= {EDITION_START[E2]} AND wave < {EDITION_START[E3]}"
    return f"wave >= {EDITION_START[E3]}"


def bronze_edition(base: DataFrame, edition: str, parts: tuple[str, ...] = ("profile", "flags")) -> DataFrame:
    """The wide, all-string layout of one edition (its waves only), built as
    one projection of the response base.

    No lines, no mask: nothing is ticked.  Masks without NULL keep the code
    that writes a cell short; the JVM does not compile a method of over 8,000
    bytes, and the coded blocks make one of all their cells."""
    masks = [c for c in ("mask_a", "mask_b") if c in base.columns]
    base = base.withColumns({m: F.coalesce(m, F.lit(0).cast("long")) for m in masks})
    pm = _profile_map(edition)
    cols = ["CASE WHEN o_orderkey % 97 = 1 THEN NULL WHEN o_orderkey % 97 = 2 THEN '  ' "
            f"ELSE CAST(o_custkey AS STRING) END AS {ident(_id_header(edition))}",
            f"CAST(wave AS STRING) AS {ident(_wave_header(edition))}"]
    if "profile" in parts or "answers" in parts:
        cols.append("CASE WHEN o_orderkey % 19 = 7 THEN '  ' WHEN o_orderkey % 19 <> 8 THEN o_orderpriority END "
                    f"AS {ident(pm['priority'])}")
    if "profile" in parts:
        segment = "concat(c_mktsegment, ' ')" if edition == E2 else "c_mktsegment"
        segment = (f"CASE o_orderkey % 11 WHEN 3 THEN '   ' WHEN 5 THEN '' WHEN 7 THEN NULL "
                   f"WHEN 9 THEN concat(' ', c_mktsegment, ' \"new\"') ELSE {segment} END")
        cols += [f"CAST(o_orderkey AS STRING) AS {ident(pm['response_id'])}",
                 f"{_age_text(edition)} AS {ident(pm['age'])}", f"{segment} AS {ident(pm['segment'])}",
                 f"n_name AS {ident(pm['nation'])}", f"r_name AS {ident(pm['region'])}",
                 f"o_orderstatus AS {ident(pm['status'])}", f"{_pay_text(edition)} AS {ident(pm['pay_band'])}"]
    if "answers" in parts and _status_header(edition):
        cols.append(f"{_status_text()} AS {ident(_status_header(edition))}")
    if "flags" in parts:
        prefixes, labels = _prefixes(edition), _labels(edition)
        keys = {"part_type": "type", "part_item": "item", "part_color": "color", "returns": "return"}
        for cat, key in keys.items():
            for i, label in enumerate(labels[cat]):
                option = "type_twice" if key == "type" and i > len(PART_TYPES) else f"{key}_{i}"
                cols.append(f"{_flag_text(edition, option)} AS "
                            f"{ident(_flag_header(edition, prefixes[cat], i + 1, label))}")
    if "answers" in parts:
        coded = _coded_prefixes(edition)
        (pf, po), (pd,) = coded["brand_bought"], coded["discount_level"]
        for n in BRAND_CODES:
            cols.append(f"{_flag_text(edition, f'brand_f_{n}')} AS {ident(_coded_header(edition, pf, n, BRAND_LABELS[n]))}")
            cols.append(f"{_flag_text(edition, f'brand_o_{n}')} AS {ident(_coded_header(edition, po, n, BRAND_LABELS[n]))}")
        for n in DISCOUNT_LEVELS:
            cols.append(f"{_flag_text(edition, f'discount_{n}')} AS "
                        f"{ident(_coded_header(edition, pd, n, DISCOUNT_LABELS[n]))}")
    return base.filter(edition_filter_sql(edition)).selectExpr(*cols)


def bronze(spark: SparkSession, sf_dir: str, parts: tuple[str, ...] = ("profile",),
           stored: bool = True) -> dict[str, DataFrame]:
    """The three editions; together they hold every order that has a date
    exactly once.
    ``stored=False`` derives the base inside the plan instead of reading the
    stored one."""
    need_flags = "flags" in parts or "answers" in parts
    base = (stored_base if stored else base_responses)(spark, sf_dir, with_flags=need_flags)
    return {e: bronze_edition(base, e, parts) for e in (E1, E2, E3)}
