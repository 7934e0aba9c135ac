"""Cost of the persisted job: code that the JVM compiles, parts taken apart once."""

import re

import pytest

from wavelake.plans import queries as Q
from wavelake.plans import virtual as V

#: HotSpot never compiles a longer method (``-XX:-DontCompileHugeMethods`` aside)
HUGE_METHOD = 8000


def _longest_methods(spark, df, capsys):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the stages as planned, before any ran
    try:
        capsys.readouterr()
        df.explain(mode="codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]


@pytest.mark.parametrize("build", [Q.entities, Q.selections, Q.answers])
def test_every_stage_of_silver_is_compiled(spark, sf, capsys, build):
    V.prepare(spark, sf)
    sizes = _longest_methods(spark, build(spark, sf), capsys)
    assert sizes and max(sizes) < HUGE_METHOD


def test_every_stage_of_the_base_is_compiled(spark, sf, capsys):
    sizes = _longest_methods(spark, V.base_responses(spark, sf), capsys)
    assert sizes and max(sizes) < HUGE_METHOD


def _options(row):
    return {k for k, (mask, bit) in V._option_bits().items() if row[mask] >> bit & 1}


def test_line_masks_of_odd_parts_and_lines(spark):
    """A part name of one word raised before, where the form says "other"."""
    part = spark.createDataFrame(
        [(1, "PROMO", "blue ring", "Brand#7"), (2, "OTHER", "blue", "Brand#99"), (3, None, None, None),
         (4, "promo", "ring blue x", "Brand"), (1, "LARGE", "red rod", "Brand#8"), (None, "PROMO", "blue ring", "Brand#1")],
        "p_partkey bigint, p_type string, p_name string, p_brand string")
    lines = spark.createDataFrame(
        [(1, 1, "A", "F", 0.0), (2, 2, "?", "O", 0.03), (3, 3, None, None, None), (4, 4, "R", "", 0.07),
         (5, 77, "N", "P", 0.075), (6, None, "N", "F", -1.0)],
        "l_orderkey bigint, l_partkey bigint, l_returnflag string, l_linestatus string, l_discount double")
    found = {}
    for r in V._line_masks(lines, part).collect():
        found.setdefault(r["l_orderkey"], set()).add(frozenset(_options(r)))
    other = {"type_6", "item_8", "color_8"}
    assert found == {
        1: {frozenset({"type_3", "item_5", "color_0", "return_0", "brand_f_7", "discount_1"}),
            frozenset({"type_1", "item_6", "color_6", "return_0", "brand_f_8", "discount_1"})},
        2: {frozenset({"type_6", "item_8", "color_0", "return_3", "brand_o_26", "discount_2"})},
        3: {frozenset({*other, "return_3", "discount_4"})},
        4: {frozenset({*other, "return_2", "brand_o_26", "discount_3"})},
        5: {frozenset({*other, "return_1", "brand_o_26", "discount_4"})},
        6: {frozenset({*other, "return_1", "brand_f_26", "discount_1"})},
    }


def test_form_without_lines_ticks_nothing(spark):
    """No lines, no mask: every cell says so, none is NULL."""
    base = spark.createDataFrame(
        [(1, 1, None, None, 1995), (2, 2, 1, 1, 1997), (3, 3, None, None, 1999)],
        "o_orderkey bigint, o_custkey bigint, mask_a bigint, mask_b bigint, wave int")
    for edition, ticked, blank in ((V.E1, 0, "0"), (V.E2, 2, "0.0"), (V.E3, 0, "")):
        rows = V.bronze_edition(base.withColumn("o_orderpriority", base.wave.cast("string"))
                                .withColumn("o_orderstatus", base.wave.cast("string")),
                                edition, ("flags", "answers")).collect()
        cells = [v for c, v in rows[0].asDict().items()
                 if c not in (V._id_header(edition), V._wave_header(edition), V._profile_map(edition)["priority"],
                              V._status_header(edition))]
        assert len(rows) == 1 and None not in cells
        assert sum(v != blank for v in cells) == ticked


def test_text_of_a_part_is_read_before_the_join(spark, sf):
    plan = V.base_responses(spark, sf)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    reads = [i for i, line in enumerate(plan) if "regexp_extract(" in line]
    scans = [i for i, line in enumerate(plan) if "Relation" in line and "p_partkey" in line]
    joins = [i for i, line in enumerate(plan) if "Join" in line and "l_partkey" in line]
    assert len(reads) == 1 and joins[0] < reads[0] < scans[0]
