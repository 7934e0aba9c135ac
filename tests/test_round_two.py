"""Partial runs, CSV edges, catalog safety, plan shapes and filters that must
have work."""

import dataclasses

import duckdb
import pytest
from pyspark.sql import functions as F

from wavelake.functions import columns as C
from wavelake.functions import text as X
from wavelake.operators import discover, metrics
from wavelake.operators.dedupe import dedupe
from wavelake.plans import medallion, oracle, silver
from wavelake.plans import survey_preset as P
from wavelake.plans import virtual as V
from wavelake.session import path_exists, scratch_path
from wavelake.sources import (read_table, read_wave_csv, register_external, replace_waves, write_partitioned,
                              write_wave_csv)

from .test_survey_preset import bronze_rows


# --- runs on some of the waves -------------------------------------------------

def _bronze(spark, years, keep=None):
    out = {}
    for year in years:
        cols, rows = bronze_rows(year)
        out[str(year)] = spark.createDataFrame(rows[:keep] if keep else rows, cols)
    return out


def _run(spark, root, bronze, **kw):
    q = P.questionnaire()
    q = dataclasses.replace(q, editions=[e for e in q.editions if e.name in bronze])
    medallion.run(spark, q, bronze, root, P.TABLE_NAMES, P.OUTPUT_NAMES, **kw)


def _rows(spark, root, layer, table, year):
    return sorted(map(repr, read_table(spark, f"{root}/{layer}/{table}").filter(F.col(P.WAVE) == year).collect()))


def test_a_run_on_one_wave_keeps_the_others(spark):
    root = scratch_path(spark, "partial")
    _run(spark, root, _bronze(spark, (2023, 2024, 2025)))
    tables = [("silver" if k in medallion.SILVER else "gold", t) for k, t in P.TABLE_NAMES.items()]
    before = {(t, y): _rows(spark, root, layer, t, y) for layer, t in tables for y in (2023, 2024, 2025)}
    assert all(before[t, y] for _, t in tables for y in (2023, 2024, 2025))
    _run(spark, root, _bronze(spark, (2025,), keep=2))
    after = {(t, y): _rows(spark, root, layer, t, y) for layer, t in tables for y in (2023, 2024, 2025)}
    for _, t in tables:
        assert all(before[t, y] == after[t, y] for y in (2023, 2024))
    assert before["silver_respondentes", 2025] != after["silver_respondentes", 2025]
    assert before["gold_perfil_mercado", 2025] != after["gold_perfil_mercado", 2025]


def test_a_held_wave_without_rows_loses_its_partition(spark):
    path = scratch_path(spark, "held")
    write_partitioned(spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "wave int, v string"), path)
    replace_waves(spark.createDataFrame([(2, "x")], "wave int, v string"), path, "wave", [1, 2, None])
    assert [tuple(r) for r in read_table(spark, path).collect()] == [("x", 2)]
    replace_waves(spark.createDataFrame([], "wave int, v string"), path, "wave", [2])
    assert not path_exists(spark, f"{path}/wave=2")


def test_external_tables_leave_other_tables_alone(spark):
    root = scratch_path(spark, "catalog")
    _run(spark, root, _bronze(spark, (2023, 2024, 2025)), catalog=True)
    assert spark.sql("SELECT COUNT(*) FROM gold_ia").first()[0] == 86
    _run(spark, root, _bronze(spark, (2024,)), catalog=True)  # registered again: refreshed
    assert spark.sql("SELECT COUNT(*) FROM gold_ia").first()[0] == 86
    with pytest.raises(ValueError, match="gold_ia"):
        register_external(spark, "gold_ia", scratch_path(spark, "elsewhere"))
    for t in P.TABLE_NAMES.values():
        spark.sql(f"DROP TABLE {t}")


# --- CSV -----------------------------------------------------------------------

def test_csv_keeps_spaces_and_quotes_and_reads_empty_as_null(spark):
    rows = [("1", " x ", 'a "b", c'), ("2", "", None), ("3", None, "  ")]
    back = [("1", " x ", 'a "b", c'), ("2", None, None), ("3", None, "  ")]
    path = scratch_path(spark, "csv-edges")
    write_wave_csv(spark.createDataFrame(rows, "a string, b string, c string"), path)
    for columns in (None, ["a", "b", "c"]):
        assert sorted(tuple(r) for r in read_wave_csv(spark, path, columns=columns).collect()) == back


def test_a_reordered_header_fails(spark):
    path = scratch_path(spark, "csv-order")
    write_wave_csv(spark.createDataFrame([("1", "2")], "b string, a string"), path)
    with pytest.raises(Exception, match="(?i)header"):
        read_wave_csv(spark, path, columns=["a", "b"]).collect()


# --- header grammar and twin helpers -------------------------------------------

def test_both_label_forms_agree_on_quotes_and_escapes(spark):
    headers = ["('P4_d_1 ', 'Python')", r"('P4 ', 'it\'s')", "('P4 ', \"R's, v2\")", r"('P4 ', 'back\\slash')",
               "('a', 'b', 'c')", "( 'a' ,  'padded ' )", "not a tuple", "('one',)", " 4.d.1_Big_Query ", "3.f.1 Uso a ",
               "", "_", " ", "a_", "('x', '')"]
    df = spark.createDataFrame([(h,) for h in headers], "h string")
    for style in (discover.TUPLE, discover.UNDERSCORE, discover.SPACE):
        got = {r["h"]: r["l"] for r in df.select("h", discover.header_label_expr("h", style).alias("l")).collect()}
        assert got == {h: discover.header_label(h, style) for h in headers}
    assert discover.header_label(r"('P4 ', 'it\'s')", discover.TUPLE) == "it's"


def test_column_and_sql_forms_of_the_helpers_agree(spark):
    df = spark.createDataFrame([(v,) for v in ["29", " 29.0 ", "29.7", "", "  ", "x", None, "1", "1.0", " 1 ", "0", "2",
                                               "Não sei", " PRINCIPAL ", "9999999999"]], "v string")
    rules = [("não sei", "n"), ("principal", "p"), ("nao sei", "m")]
    for column, text in ((C.clean_text("v"), C.clean_text_sql("v")), (C.tolerant_int("v"), C.tolerant_int_sql("v")),
                         (C.tolerant_long("v"), C.tolerant_long_sql("v")),
                         (C.is_selected("v"), C.is_selected_sql("v")), (C.is_selected("v", 2.0), C.is_selected_sql("v", 2.0)),
                         (X.ordered_rules("v", rules), X.ordered_rules_sql("v", rules)),
                         (X.ordered_rules("v", rules, fold_accents=True), X.ordered_rules_sql("v", rules, True))):
        assert df.filter(~column.eqNullSafe(F.expr(text))).count() == 0
    for value in ["SQL SERVER", " SQL SERVER ", "x"]:
        one = spark.createDataFrame([(value,)], "v string")
        assert one.select(X.alias("v", {"SQL SERVER": "SQL Server"})).first()[0] == X.alias_py(value, {"SQL SERVER": "SQL Server"})
        assert one.select(X.classify("v", [("sql", "db")], "other")).first()[0] == X.classify_py(value, [("sql", "db")], "other")


def test_dedupe_can_prefer_rows_with_answers(spark):
    df = spark.createDataFrame([("a", None, "y"), ("a", "x", None), ("a", "z", "w")], "k string, p string, q string")
    assert [tuple(r) for r in dedupe(df, ["k"]).collect()] == [("a", None, "y")]
    assert [tuple(r) for r in dedupe(df, ["k"], nulls_last=True).collect()] == [("a", "x", None)]


# --- plans ---------------------------------------------------------------------

def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line], plan


def test_unique_ids_count_without_shuffling_ids(spark, sf, stored_frames):
    from wavelake.plans.queries import QUERIES
    for key in ("profile_distribution", "band_distribution_overall", "band_distribution_by_dimension",
                "band_distribution_all"):
        df = QUERIES[key](spark, sf)
        exchanges, plan = _exchanges(stored_frames.pop() if stored_frames else df)  # ranks are numbered after a copy
        assert sum("entity_id" in e for e in exchanges) == 1 and "distinct" not in plan  # the dedupe's own
    df = spark.range(1000).select((F.col("id") % 500).cast("string").alias("id"), (F.col("id") % 2).cast("int").alias("w"),
                                  F.concat(F.lit("c"), F.col("id") % 3).alias("c")).dropDuplicates(["id", "w"])
    plain, unique = (metrics.distinct_share(df, ["w"], ["c"], "id", unique_ids=u) for u in (False, True))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, unique.collect()))


def test_options_are_deduplicated_as_integers(spark, sf):
    from wavelake.plans.queries import QUERIES
    exchanges, plan = _exchanges(QUERIES["dedupe_selections"](spark, sf))
    assert len(exchanges) == 1 and not any(c in exchanges[0] for c in ("item", "category", "question", "comparab"))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "HashAggregate" in plan


def test_share_over_all_rows_needs_no_single_window(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1)], "c string, n long")
    out = metrics.share_of_sum(df, [], "n")
    assert sorted(tuple(r) for r in out.collect()) == [("a", 3, 75.0), ("b", 1, 25.0)]
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_ranks_of_a_million_answers_are_spread_over_tasks(spark):
    n, seen = 1_000_000, []
    df = spark.range(n).select(F.lit(1).alias("w"), F.lit("d").alias("d"), (F.col("id") % 3).alias("n"),
                               F.concat(F.lit("answer "), F.col("id").cast("string")).alias("a"))

    def stored(frame):
        path = scratch_path(spark, "ranges")
        frame.write.parquet(path)
        seen.append(spark.read.parquet(path))
        return seen[-1]
    order = [F.desc("n"), F.asc("a")]
    out = metrics.row_numbers(df, ["w", "d"], order, "rank", stored)
    largest = seen[0].groupBy("w", "d", "_range").count().agg(F.max("count")).first()[0]
    assert largest < n / 3
    want = metrics.row_numbers(df, ["w", "d"], order, "rank", bounded=True)
    differ = out.select("a", "rank").join(want.select(F.col("a").alias("b"), F.col("rank").alias("r")),
                                          (F.col("a") == F.col("b")) & (F.col("rank") == F.col("r")), "left_anti")
    assert out.count() == n and differ.isEmpty()
    small = spark.createDataFrame([(1, None, 2, "x"), (1, None, 2, "y"), (None, "e", 1, "z")], "w int, d string, n int, a string")
    assert sorted(map(repr, metrics.row_numbers(small, ["w", "d"], order, "rank", stored).collect())) == sorted(
        map(repr, metrics.row_numbers(small, ["w", "d"], order, "rank", bounded=True).collect()))


# --- filters have work ---------------------------------------------------------

@pytest.mark.parametrize("key, condition, without", [
    ("multiselect_long", oracle.HAS_ID, "true"),                                       # ids that are missing
    ("categorical_answers", f"AND {oracle.PRIORITY} IS NOT NULL", ""),                 # answers that are missing
    ("profile_distribution", "category IS NOT NULL AND trim(category) <> ''", "true"),  # blank categories
    ("band_distribution_overall", "pay_band IS NOT NULL AND trim(pay_band) <> ''", "true"),
    ("clean_text_nulls", "WHEN o_orderkey % 11 IN (3, 5, 7) THEN NULL", ""),           # blank text is NULL
    ("tolerant_cast", "OR o_orderkey % 13 = 4", ""),                                   # numbers that are none
    ("dedupe_selections", "WHERE rn = 1", ""),                                         # two spellings of one item
])
def test_no_filter_is_idle(sf, key, condition, without):
    text = oracle.oracle_sql()[key]
    assert condition in text
    with duckdb.connect() as db:
        for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        assert sorted(map(repr, db.execute(text).fetchall())) != \
            sorted(map(repr, db.execute(text.replace(condition, without)).fetchall()))


def test_every_order_and_line_reaches_the_base(spark, sf):
    base = V.stored_base(spark, sf)
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    assert base.count() == orders.count() == base.select("o_orderkey").distinct().count()
    assert orders.filter("o_orderdate IS NULL").isEmpty()
    editions = V.bronze(spark, sf)
    assert sum(df.count() for df in editions.values()) == orders.count()
    assert {e.dimension for x in V.questionnaire().editions for e in x.categorical} & {
        b.dimension for x in V.questionnaire().editions for b in x.coded_blocks} == set()


def test_a_dimension_asked_both_ways_is_deduplicated_once_more(spark):
    from wavelake.operators.harmonize import Field
    from wavelake.plans.config import CategoricalQuestion, CodedBlock, Edition, Questionnaire
    e = Edition("e", discover.SPACE, "id", {}, 2024,
                coded_blocks=[CodedBlock("d", "1.a.", {1: "yes"}, "c")],
                categorical=[CategoricalQuestion("d", "q", [("yes", "yes")], "c", "0.q")])
    q = Questionnaire(fields=[Field("entity_id")], editions=[e])
    df = spark.createDataFrame([("r", "yes indeed", "1"), ("s", None, "1")], ["id", "q", "1.a.1 Yes"])
    got = sorted((r.entity_id, r.answer, r.block) for r in silver.answers(q, {"e": df}).collect())
    assert got == [("r", "yes", "0.q"), ("s", "yes", "1.a.")]
