"""Sources/sinks and plan-shape checks."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from wavelake.operators.metrics import profile_distribution
from wavelake.session import local_path, scratch_path
from wavelake.sources import (export_report, read_report, read_table, read_wave_csv, register_external,
                              write_partitioned, write_wave_csv)

ODD = ["('P0', 'id')", "('P1_b ', \"Genero, \"\"x\"\"\")", "4.d.1_Python", "1.c_cor/raca/etnia", "a`b"]


def test_csv_round_trip_keeps_odd_headers_and_quotes(spark):
    rows = [("1", 'say "hi", ok', "1", "Branca", "x"), ("2", "", "0.0", None, "y")]
    df = spark.createDataFrame(rows, ODD)
    path = scratch_path(spark, "csv-odd")
    write_wave_csv(df, path)
    back = read_wave_csv(spark, path)
    assert back.columns == ODD
    got = sorted(tuple(r) for r in back.collect())
    assert got[0] == ("1", 'say "hi", ok', "1", "Branca", "x")
    assert got[1][0] == "2" and got[1][2] == "0.0"
    # with the schema given no header job is needed and names are identical
    assert read_wave_csv(spark, path, columns=ODD).columns == ODD


def test_partitioned_overwrite_static_and_dynamic(spark):
    path = scratch_path(spark, "parts")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "wave int, v string")
    write_partitioned(df, path)
    write_partitioned(spark.createDataFrame([(2, "c")], "wave int, v string"), path, dynamic=True)
    assert sorted(tuple(r) for r in read_table(spark, path).collect()) == [("a", 1), ("c", 2)]
    write_partitioned(spark.createDataFrame([(2, "d")], "wave int, v string"), path)
    assert sorted(tuple(r) for r in read_table(spark, path).collect()) == [("d", 2)]


def test_partition_filter_as_string_is_pruned(spark):
    path = scratch_path(spark, "prune")
    write_partitioned(spark.range(0, 100).select((F.col("id") % 4).cast("int").alias("wave"), "id"), path)
    t = read_table(spark, path)
    q = t.filter("wave = '2'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(wave" in plan and "= 2)" in plan
    assert q.count() == 25 and dict(zip(t.columns, [f.dataType.simpleString() for f in t.schema]))["wave"] == "int"


def test_register_external_table_discovers_partitions(spark):
    path = scratch_path(spark, "ext")
    write_partitioned(spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "wave int, v string"), path)
    register_external(spark, "wl_ext_test", path)
    got = {r["wave"]: r["n"] for r in spark.sql("SELECT wave, COUNT(*) AS n FROM wl_ext_test GROUP BY wave").collect()}
    assert got == {1: 1, 2: 2}


def test_export_report_quotes_every_value(spark):
    df = spark.createDataFrame([(2023, "Sênior", 1419, 36.79), (2023, "x", 31, 31.0)],
                               "ano_pesquisa int, senioridade string, quantidade long, percentual double")
    path = scratch_path(spark, "report")
    export_report(df, path, single_file=True)
    files = [f for f in os.listdir(local_path(path)) if f.endswith(".csv")]
    text = open(os.path.join(local_path(path), files[0]), encoding="utf-8").read().splitlines()
    assert text[0] == '"ano_pesquisa","senioridade","quantidade","percentual"'
    assert '"2023","x","31","31.0"' in text
    assert sorted(tuple(r) for r in read_report(spark, path).collect())[0] == ("2023", "Sênior", "1419", "36.79")


def test_profile_distribution_scans_source_once_with_pruned_columns(spark, stored_frames):
    path = scratch_path(spark, "profile-src")
    src = spark.createDataFrame([("1", 1, "a", "x", "unused"), ("2", 1, "b", "", "unused")],
                                "id string, wave int, d1 string, d2 string, other string")
    src.write.parquet(path)
    out = profile_distribution(spark.read.parquet(path), "wave", "id", ["d1", "d2"])
    assert out.count() == 3 and len(stored_frames) == 1
    plan = stored_frames[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "other" not in plan.split("ReadSchema:")[1].split("\n")[0]
    assert "Expand" in plan and "BroadcastHashJoin" not in plan and "SortMergeJoin" not in plan


def _plan_text(df):
    df._jdf.queryExecution().executedPlan()
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("key", ["dedupe_entities", "dedupe_selections", "dedupe_answers", "profile_distribution",
                                 "band_distribution_all", "adoption_share", "answer_share", "topk_per_group",
                                 "sql_indicator_subset", "header_label_extract", "union_missing_columns"])
def test_no_python_evaluation_in_registered_plans(spark, sf, key):
    from __spark_entry__ import queries
    text = _plan_text(queries()[key](spark, sf))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert marker not in text


def test_topk_uses_window_group_limit(spark, sf):
    from __spark_entry__ import queries
    assert "WindowGroupLimit" in _plan_text(queries()["topk_per_group"](spark, sf))


ORACLE_KEYS = ["harmonize_waves", "dedupe_entities", "dedupe_selections", "dedupe_answers", "profile_distribution",
               "band_distribution_all", "adoption_share", "answer_share", "sql_share_window", "sql_single_wave_share"]


def _norm(v):
    return "NULL" if v is None else repr(round(v, 6)) if isinstance(v, float) else str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("key", ORACLE_KEYS)
def test_matches_sql_oracle(spark, sf, key):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[key](spark, sf)
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.execute(oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _digest(df.columns, [tuple(r) for r in df.collect()]) == _digest(ocols, res.fetchall())


def test_landing_keeps_odd_headers_and_prunes_columns(spark):
    from wavelake.sources import land, read_landed
    rows = [("1", 'say "hi", ok', "1", "Branca", "x"), ("2", "", "0.0", None, "y")]
    df = spark.createDataFrame(rows, ODD)
    path = scratch_path(spark, "landed")
    landed = land(df, path)
    assert landed.columns == ODD
    assert sorted(tuple(r) for r in landed.collect()) == sorted(rows, key=str)
    again = read_landed(spark, path).select("`4.d.1_Python`")
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c00002:string>" in plan


def test_multiselect_and_answers_scan_each_edition_once(spark):
    """All option blocks of an edition (4 prefix blocks; categorical + coded
    answers) come from one scan, not one scan per option as in the
    reference's plan."""
    from wavelake.plans import silver
    from wavelake.plans import survey_preset as P

    from .test_survey_preset import bronze_rows
    q = P.questionnaire()
    cols, rows = bronze_rows(2024)
    path = scratch_path(spark, "edition-2024")
    from wavelake.sources import land
    landed = land(spark.createDataFrame(rows, cols), path)
    one = __import__("dataclasses").replace(q, editions=[e for e in q.editions if e.name == "2024"])
    for build in (silver.selections, silver.answers):
        plan = build(one, {"2024": landed}, deduplicate=False)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1
        assert plan.count("Expand") == 1
