"""Operators on hand-made frames: discovery, harmonise, dedupe, unpivot, shares."""

import pytest
from pyspark.sql import functions as F

from wavelake.operators import discover
from wavelake.operators.answers import Categorical, answers_long
from wavelake.operators.dedupe import dedupe
from wavelake.operators.harmonize import INT, TEXT, Field, harmonize, union_waves
from wavelake.operators.metrics import (distinct_share, profile_distribution, share_of_sum, top_k)
from wavelake.operators.multiselect import coded_options, flags_to_long, prefix_options
from wavelake.operators.quality import duplicate_keys, row_counts


def test_by_prefix_errors_when_block_missing():
    assert discover.by_prefix(["id", "4.d.1_SQL", "4.d.10_R"], "4.d.") == ["4.d.1_SQL", "4.d.10_R"]
    with pytest.raises(ValueError):
        discover.by_prefix(["id", "4.d.1_SQL"], "4.g.")


def test_by_code_distinguishes_1_from_10_and_rejects_ambiguity():
    cols = ["3.f.1 a", "3.f.10 b", "('P3_f_1 ', 'x')", "('P3_f_10 ', 'y')"]
    assert discover.by_code(cols, "3.f.1", discover.SPACE) == "3.f.1 a"
    assert discover.by_code(cols, "3.f.10", discover.SPACE) == "3.f.10 b"
    assert discover.by_code(cols, "P3_f_1", discover.TUPLE) == "('P3_f_1 ', 'x')"
    with pytest.raises(ValueError):
        discover.by_code(cols, "3.f.2", discover.SPACE)
    with pytest.raises(ValueError):
        discover.by_code(cols + ["3.f.1 dup"], "3.f.1", discover.SPACE)


def test_header_label_forms(spark):
    assert discover.header_label("('P4_d_1 ', 'Python')", discover.TUPLE) == "Python"
    assert discover.header_label("('P4_d_2 ', \"R's lib, v2\")", discover.TUPLE) == "R's lib, v2"
    assert discover.header_label("not a tuple", discover.TUPLE) == "not a tuple"
    assert discover.header_label("4.d.3_Python", discover.UNDERSCORE) == "Python"
    assert discover.header_label("3.f.1 Uso descentralizado ", discover.SPACE) == "Uso descentralizado"
    df = spark.createDataFrame([("('P4_d_1 ', 'Python')",), ("4.d.3_Big_Query",)], ["h"])
    got = df.select(discover.header_label_expr("h", discover.TUPLE).alias("t"),
                    discover.header_label_expr("h", discover.UNDERSCORE).alias("u")).collect()
    assert got[0]["t"] == "Python" and got[1]["u"] == "Big_Query"


def test_harmonize_maps_editions_and_unions_by_name(spark):
    fields = [Field("id", TEXT), Field("age", INT), Field("level", TEXT)]
    a = spark.createDataFrame([("1", "29.0", " Senior ")], ["('P0', 'id')", "('P1_a ', 'Idade')", "('P2_g ', 'Nivel')"])
    b = spark.createDataFrame([("Pleno", "x", " "), ("", "31", "7")], ["2.g_nivel", "1.a_idade", "0.a_token"])
    ha = harmonize(a, fields, {"id": "('P0', 'id')", "age": "('P1_a ', 'Idade')", "level": "('P2_g ', 'Nivel')"}, 2023)
    hb = harmonize(b, fields, {"id": "0.a_token", "age": "1.a_idade", "level": "2.g_nivel"}, 2024)
    out = union_waves([ha, hb])
    assert out.columns == ["id", "wave", "age", "level"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted([("1", 2023, 29, "Senior"), ("7", 2024, 31, None), (None, 2024, None, "Pleno")], key=str)
    with pytest.raises(ValueError):
        harmonize(a, fields, {"id": "('P0', 'id')"}, 2023)


def test_dedupe_is_deterministic_and_keeps_null_key_once(spark):
    data = [("a", 1, "x3"), ("a", 1, "x1"), ("a", 1, "x2"), (None, 1, "n2"), (None, 1, "n1"), ("b", 1, None),
            ("b", 1, "b1")]
    df = spark.createDataFrame(data, "id string, wave int, v string").repartition(3)
    out = {(r["id"], r["wave"]): r["v"] for r in dedupe(df, ["id", "wave"], order=["v"]).collect()}
    assert out == {("a", 1): "x1", (None, 1): "n1", ("b", 1): None}
    again = dedupe(dedupe(df, ["id", "wave"], ["v"]), ["id", "wave"], ["v"])
    assert again.count() == 3 and duplicate_keys(again, ["id", "wave"]).count() == 0


def test_dedupe_hot_key_is_combined_map_side(spark):
    df = spark.range(0, 30000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("v"))
    out = dedupe(df, ["k"], order=["v"])
    assert sorted(tuple(r) for r in out.collect()) == [(0, 1), (1, 0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan or "HashAggregate" in plan
    assert "Window" not in plan


def _flags(spark):
    cols = ["id", "4.d.1_SQL", "4.d.10_R", "4.d.11_X", "other"]
    data = [("r1", "1", "0", "1.0", "z"), ("r2", "0", "", "abc", "z"), ("r3", " 1 ", None, "0", "z"),
            (None, "1", "1", "1", "z"), (" ", "1", "1", "1", "z")]
    return spark.createDataFrame(data, cols)


def test_flags_to_long_one_row_per_selected_option(spark):
    df = _flags(spark)
    opts = prefix_options(df.columns, "4.d.", discover.UNDERSCORE, category_col="category", category="lang",
                          item_col="item", original_col="item_original", class_col="item_type",
                          aliases={"R": "R lang"}, class_rules=[("x", "none")], default_class="tech")
    out = flags_to_long(df, "id", 2024, opts, ["category", "item", "item_original", "item_type"])
    got = sorted((r["entity_id"], r["item"], r["item_type"]) for r in out.collect())
    # r2 selected nothing -> no row; NULL and blank ids dropped
    assert got == [("r1", "SQL", "tech"), ("r1", "X", "none"), ("r3", "SQL", "tech")]
    assert out.columns == ["entity_id", "wave", "category", "item", "item_original", "item_type"]


def test_coded_options_and_answers_long_single_pass(spark):
    df = spark.createDataFrame(
        [("r1", "É a principal prioridade", "1", "0", "1"), ("r2", "  ", "0", "1", "0"), ("r3", None, "0", "0", "0")],
        ["0.a_token", "3.e_prioridade?", "3.f.1 Uso a", "3.f.10 Uso j", "4.l.1 Uso a"])
    flags = coded_options(df.columns, "3.f.", {1: "use_a", 10: "use_j"}, discover.SPACE, dimension_col="dimension",
                          dimension="use", answer_col="answer", original_col="answer_original", block_col="block")
    flags += coded_options(df.columns, "4.l.", {1: "use_a"}, discover.SPACE, dimension_col="dimension",
                           dimension="use", answer_col="answer", original_col="answer_original", block_col="block")
    cats = [Categorical("3.e_prioridade?", [("principal prioridade", "top")], {"dimension": "priority",
                                                                                "block": "3.e"})]
    out = answers_long(df, "0.a_token", 2025, cats, flags, ["dimension", "answer", "answer_original", "block"])
    got = sorted((r["entity_id"], r["dimension"], r["answer"], r["answer_original"], r["block"]) for r in out.collect())
    assert got == [("r1", "priority", "top", "É a principal prioridade", "3.e"),
                   ("r1", "use", "use_a", "Uso a", "3.f."), ("r1", "use", "use_a", "Uso a", "4.l."),
                   ("r2", "use", "use_j", "Uso j", "3.f.")]
    merged = dedupe(out, ["entity_id", "wave", "dimension", "answer"], order=["block"])
    assert merged.filter("dimension = 'use' AND entity_id = 'r1'").count() == 1


def test_distinct_share_denominator_includes_non_counted_items(spark):
    rows_ = [("a", 1, "db", "pg", "tech"), ("b", 1, "db", "none", "no_use"), ("c", 1, "db", "pg", "tech"),
             ("c", 1, "db", "my", "tech"), ("d", 1, "bi", "pbi", "tech"), (None, 1, "db", "pg", "tech")]
    df = spark.createDataFrame(rows_, "id string, wave int, cat string, item string, kind string")
    out = distinct_share(df, ["wave", "cat"], ["item"], "id", numerator=F.col("kind") == "tech", rank_name="rank")
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, "bi", "pbi", 1, 1, 100.0, 1), (1, "db", "my", 1, 3, 33.33, 2), (1, "db", "pg", 2, 3, 66.67, 1)]


def test_profile_distribution_one_scan_and_ranks(spark):
    df = spark.createDataFrame([("1", 1, "x", "p"), ("2", 1, "x", ""), ("3", 1, "y", None), ("4", 1, "y", "q"),
                                ("5", 1, "y", "q")], "id string, wave int, a string, b string")
    out = profile_distribution(df, "wave", "id", ["a", "b"])
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, "a", "x", 2, 5, 40.0, 2), (1, "a", "y", 3, 5, 60.0, 1),
                   (1, "b", "p", 1, 3, 33.33, 2), (1, "b", "q", 2, 3, 66.67, 1)]


def test_share_of_sum_and_top_k_plan(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (2, "a", 2), (2, "c", 2), (2, "d", 1)],
                               "wave int, cat string, q long")
    s = {(r["wave"], r["cat"]): r["percent"] for r in share_of_sum(df, ["wave"], "q").collect()}
    assert s[(1, "a")] == 75.0 and s[(2, "d")] == 20.0
    top = top_k(df, ["wave"], [F.desc("q"), F.asc("cat")], 1)
    assert sorted(tuple(r) for r in top.collect()) == [(1, "a", 3), (2, "a", 2)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_row_counts_single_job(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "wave int")
    b = spark.createDataFrame([(2,)], "wave int")
    got = sorted(tuple(r) for r in row_counts({"a": a, "b": b}).collect())
    assert got == [("a", 1, 2), ("a", 2, 1), ("b", 2, 1)]


def test_hot_category_and_null_ids_keep_exact_results(spark, stored_frames):
    """A third of all rows in one category plus a block of NULL ids: the share
    stays exact (NULL ids do not count) and the distinct count is planned
    with a shuffle on (keys, id), so the hot category is spread by id."""
    n = 30000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 1000).cast("string")).alias("id"),
        F.lit(1).alias("wave"),
        F.when(F.col("id") < n // 3, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string")))
        .alias("cat"))
    out = distinct_share(df, ["wave"], ["cat"], "id", rank_name="rank")
    rows = {r["cat"]: r for r in out.collect()}
    pdf = df.toPandas()
    valid = pdf[pdf["id"].notna()]
    base = valid["id"].nunique()
    for cat, g in valid.groupby("cat"):
        assert rows[cat]["count"] == g["id"].nunique() and rows[cat]["total"] == base
    plan = stored_frames[0]._jdf.queryExecution().executedPlan().toString()
    assert "count(distinct" in plan and "Expand" in plan


def test_blank_handling_option_reproduces_reference(spark):
    """Default: a spaces-only answer is missing.  ``blank_as_null=False``:
    the answer is kept as '' (tested for NULL before trimming)."""
    df = spark.createDataFrame([("r1", "   "), ("r2", "x"), ("r3", None)], ["id", "q"])
    cats = [Categorical("q", [("x", "code_x")], {"dimension": "d"})]
    cols = ["dimension", "answer", "answer_original"]
    strict = answers_long(df, "id", 2024, cats, [], cols)
    legacy = answers_long(df, "id", 2024, cats, [], cols, blank_as_null=False)
    assert sorted((r["entity_id"], r["answer"]) for r in strict.collect()) == [("r2", "code_x")]
    assert sorted((r["entity_id"], r["answer"]) for r in legacy.collect()) == [("r1", ""), ("r2", "code_x")]


def test_zero_base_gives_null_percent_not_an_error(spark):
    df = spark.createDataFrame([(None, 1, "d", "p")], "id string, wave int, dim string, cat string")
    got = distinct_share(df, ["wave", "dim"], ["cat"], "id").collect()
    assert [(r["count"], r["total"], r["percent"]) for r in got] == [(0, 0, None)]


def test_empty_dimension_lists_are_rejected(spark):
    from wavelake.functions import BandSpec
    from wavelake.operators.metrics import band_distribution
    df = spark.createDataFrame([("1", 1, "b")], "id string, wave int, band string")
    with pytest.raises(ValueError):
        profile_distribution(df, "wave", "id", [])
    with pytest.raises(ValueError):
        band_distribution(df, "wave", "id", "band", [], BandSpec(amount_pattern="([0-9]+)"), overall=None)


def test_schema_check_reports_missing_type_and_extra_columns(spark):
    from wavelake.operators.quality import schema_check
    df = spark.createDataFrame([("1", 2023, 3)], "id string, wave int, extra long")
    ok = schema_check(df.select("id", "wave"), [("id", "string"), ("wave", "int")])
    assert ok.count() == 0
    bad = {(r["column"], r["problem"]) for r in schema_check(df, [("id", "string"), ("wave", "bigint"),
                                                                  ("missing", "string")]).collect()}
    assert bad == {("wave", "type"), ("missing", "missing"), ("extra", "unexpected")}
