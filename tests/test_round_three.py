"""Versions and their commit, scratch with an owner, header drift, quoted line
ends, exports without one task, ranks without one task."""

import dataclasses
import os
import random

import pytest
from pyspark.sql import functions as F

from wavelake import scratch
from wavelake.operators import quality
from wavelake.plans import gold, medallion
from wavelake.plans import queries as Q
from wavelake.plans import survey_preset as P
from wavelake.session import list_folder, local_path, path_exists, scratch_path
from wavelake.sources import export_report, read_report, read_table, read_wave_csv, register_version, versions, write_wave_csv
from wavelake.sources import export
from wavelake.sources.csv import HeaderDrift, file_headers

from .test_survey_preset import bronze_rows

TABLES = [f"{'silver' if k in medallion.SILVER else 'gold'}/{t}" for k, t in P.TABLE_NAMES.items()]


# --- versions ------------------------------------------------------------------

def _run(spark, root, years, keep=None, **kw):
    bronze = {}
    for year in years:
        cols, rows = bronze_rows(year)
        bronze[str(year)] = spark.createDataFrame(rows[:keep] if keep else rows, cols)
    q = P.questionnaire()
    q = dataclasses.replace(q, editions=[e for e in q.editions if e.name in bronze])
    return medallion.run(spark, q, bronze, root, P.TABLE_NAMES, P.OUTPUT_NAMES, **kw)


def _rows(spark, root):
    return {t: sorted(map(repr, read_table(spark, f"{root}/{t}").collect())) for t in TABLES}


def test_a_job_killed_between_silver_and_gold_changes_no_table(spark, monkeypatch):
    root = scratch_path(spark, "killed")
    _run(spark, root, (2023, 2024))
    before, number = _rows(spark, root), versions.current(spark, root).number

    def die(*_, **__):
        raise RuntimeError("lost driver")
    for stage in ("profile", "answers"):
        with monkeypatch.context() as m:
            m.setattr(gold, stage, die)
            with pytest.raises(RuntimeError, match="lost driver"):
                _run(spark, root, (2024,), keep=2)
        assert _rows(spark, root) == before and versions.current(spark, root).number == number
    left = versions.vacuum(spark, root)  # what the two runs had written
    assert left and all(path.split("/")[0] in ("silver", "gold") for path in left)
    assert _rows(spark, root) == before
    _run(spark, root, (2024,), keep=2)
    after = _rows(spark, root)
    assert all(after[t] != before[t] for t in TABLES[:1]) and versions.current(spark, root).number == number + 1


def test_readers_of_the_version_before_keep_their_files(spark):
    root = scratch_path(spark, "readers")

    def write(text):
        run, seen = versions.new_run(), versions.current(spark, root)
        new = versions.write_run(spark.createDataFrame([(1, text)], "wave int, v string"), root, "t", run, "wave", [1])
        versions.publish(spark, root, seen, {"t": new}, [1])
    write("a")
    old = versions.read_current(spark, root, "t")
    write("b")
    assert [r.v for r in old.collect()] == ["a"] and [r.v for r in read_table(spark, f"{root}/t").collect()] == ["b"]
    write("c")
    write("d")  # of four versions the last two have files
    assert sum(bool([n for n in list_folder(spark, f"{root}/t/{f}") if n.startswith("wave=")])
               for f in list_folder(spark, f"{root}/t")) == 2
    assert len([n for n in list_folder(spark, f"{root}/{versions.FOLDER}") if n.endswith(".json")]) == 2


def test_runs_at_the_same_time_merge_or_conflict(spark):
    root = scratch_path(spark, "at-once")
    seen = versions.current(spark, root)

    def part(wave, text):
        df = spark.createDataFrame([(wave, text)], "wave int, v string")
        return {"t": versions.write_run(df, root, "t", versions.new_run(), "wave", [wave])}
    one, two, again = part(1, "a"), part(2, "b"), part(1, "c")
    versions.publish(spark, root, seen, one, [1])
    versions.publish(spark, root, seen, two, [2])  # another wave: both stay
    assert sorted(r.v for r in versions.read_current(spark, root, "t").collect()) == ["a", "b"]
    with pytest.raises(versions.Conflict, match="t for"):
        versions.publish(spark, root, seen, again, [1])
    assert sorted(r.v for r in versions.read_current(spark, root, "t").collect()) == ["a", "b"]


def test_null_waves_empty_waves_and_counts(spark):
    root = scratch_path(spark, "odd-waves")
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "wave int, v string")
    new = versions.write_run(df, root, "t", versions.new_run(), "wave", [1, 2, None])
    assert new.rows == {"1": 1, versions.NULL_PARTITION: 2}
    first = versions.publish(spark, root, versions.current(spark, root), {"t": new}, [1, 2, None])
    counts = quality.recorded_counts(spark, first.tables)
    want = quality.row_counts({"t": versions.read_current(spark, root, "t")})
    assert sorted(map(repr, counts.collect())) == sorted(map(repr, want.select(*counts.columns).collect()))
    none = versions.write_run(df.filter("false"), root, "t", versions.new_run(), "wave", [1])
    versions.publish(spark, root, first, {"t": none}, [1])
    assert sorted(r.v for r in versions.read_current(spark, root, "t").collect()) == ["b", "c"]
    none = versions.write_run(df.filter("false"), root, "t", versions.new_run(), "wave", [None])
    versions.publish(spark, root, versions.current(spark, root), {"t": none}, [None])
    empty = versions.read_current(spark, root, "t")
    assert empty.collect() == [] and empty.columns == ["v", "wave"]
    with pytest.raises(ValueError, match="holds waves"):
        versions.publish(spark, root, first, {"t": new}, [1])


def test_a_wave_filter_reads_one_folder(spark):
    root = scratch_path(spark, "pruned")
    df = spark.range(90).select((F.col("id") % 3).cast("int").alias("wave"), "id")
    new = versions.write_run(df, root, "t", versions.new_run(), "wave", [0, 1, 2])
    versions.publish(spark, root, versions.current(spark, root), {"t": new}, [0, 1, 2])
    one = read_table(spark, f"{root}/t").filter("wave = 1")
    assert "PartitionFilters: [isnotnull(wave" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 30


def test_a_rerun_sets_only_its_partitions_in_the_catalog(spark, monkeypatch):
    root = scratch_path(spark, "delta")
    _run(spark, root, (2023, 2024, 2025), catalog=True)
    said = []
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, _sql=type(spark).sql, **k: said.append(text) or _sql(self, text, *a, **k))
    _run(spark, root, (2024,), keep=2, catalog=True)
    monkeypatch.undo()
    assert not any("REPAIR" in t for t in said)
    changed = [t for t in said if t.startswith("ALTER TABLE")]
    assert len(changed) == 2 * len(P.TABLE_NAMES) and all("2024" in t for t in changed)
    for key, name in P.TABLE_NAMES.items():
        layer = "silver" if key in medallion.SILVER else "gold"
        assert sorted(map(repr, spark.table(name).collect())) == sorted(
            map(repr, read_table(spark, f"{root}/{layer}/{name}").select(*spark.table(name).columns).collect()))
        spark.sql(f"DROP TABLE {name}")


def test_catalog_partitions_of_null_and_emptied_waves(spark):
    root = scratch_path(spark, "null-part")
    df = spark.createDataFrame([(1, "it's"), (None, "b")], "wave int, v string")
    first = versions.write_run(df, root, "t", versions.new_run(), "wave", [1, None])
    published = versions.publish(spark, root, versions.current(spark, root), {"t": first}, [1, None])
    register_version(spark, "wl_null_part", root, "t", published.tables["t"])
    assert {tuple(r) for r in spark.table("wl_null_part").collect()} == {("b", None), ("it's", 1)}
    none = versions.write_run(df.filter("false"), root, "t", versions.new_run(), "wave", [None])
    published = versions.publish(spark, root, published, {"t": none}, [None])
    register_version(spark, "wl_null_part", root, "t", published.tables["t"], [None])
    assert [tuple(r) for r in spark.table("wl_null_part").collect()] == [("it's", 1)]
    with pytest.raises(ValueError, match="wl_null_part"):
        register_version(spark, "wl_null_part", scratch_path(spark, "elsewhere"), "t", published.tables["t"])
    spark.sql("DROP TABLE wl_null_part")


# --- scratch -------------------------------------------------------------------

def test_a_scope_releases_its_copies_and_hands_over_what_is_kept(spark):
    df = spark.range(5)
    with scratch.scope(spark) as outer:
        with scratch.scope(spark) as inner:
            a, b = scratch.write(df, "a"), scratch.write(df, "b")
            inner.keep(b)
            assert path_exists(spark, a.path)
        assert not a.alive and not path_exists(spark, a.path)
        assert b.df.count() == 5 and outer.copies == [b]
        with pytest.raises(RuntimeError, match="released"):
            a.acquire()
    assert not path_exists(spark, b.path)
    with pytest.raises(ZeroDivisionError), scratch.scope(spark):
        c = scratch.write(df, "c")
        raise ZeroDivisionError
    assert not path_exists(spark, c.path)


def test_a_copy_stays_until_its_last_reader(spark):
    with scratch.scope(spark):
        copy = scratch.write(spark.range(3), "shared")
        reading = scratch.using(copy)
        df = reading.__enter__()
    assert copy.alive and df.count() == 3  # the scope is over, a reader is left
    reading.__exit__(None, None, None)
    assert not copy.alive and not path_exists(spark, copy.path)
    copy.release()  # nothing more happens
    lasting = scratch.write(spark.range(3), "session")
    assert lasting.df.count() == 3 and lasting.uses == 1


def test_quality_queries_read_one_shared_copy_that_is_released(spark, sf):
    with Q.shared(spark, sf) as tables:
        root = Q.prepare(spark, sf).root
        with Q.shared(spark, sf):
            counts = {(r.table_name, r.wave): r.row_count for r in Q.quality_row_counts(spark, sf).collect()}
            assert Q.quality_sample(spark, sf).count() == 20 and Q.prepare(spark, sf).root == root
        assert path_exists(spark, root)  # the outer block still reads
        want = quality.row_counts({k: tables[k] for k in medallion.SILVER}).collect()
        assert counts == {(r.table_name, r.wave): r.row_count for r in want}
        names = list(Q.prepare(spark, sf).names.values())
    assert not path_exists(spark, root) and not any(spark.catalog.tableExists(n) for n in names)
    assert Q.quality_row_counts(spark, sf).count() == len(counts)  # made again on demand


def test_counts_of_written_tables_need_no_scan(spark, sf):
    plan = Q.quality_row_counts(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Exchange" not in plan
    for query in (Q.quality_sample, Q.quality_answer_distribution):
        assert query(spark, sf)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


# --- ranks ---------------------------------------------------------------------

@pytest.mark.parametrize("key", ["profile_distribution", "answer_share"])
def test_text_is_never_ranked_or_summed_in_one_task_per_dimension(spark, sf, stored_frames, key):
    df = Q.QUERIES[key](spark, sf)
    plans = [f._jdf.queryExecution().executedPlan().toString() for f in (df, *stored_frames)]
    assert stored_frames and "Window" not in plans[1]
    text = {"category", "answer"}
    for line in "\n".join(plans).splitlines():
        if "Window [" in line:  # over rows of one range, or over one row per range
            assert "_range" in line.split("windowspecdefinition(")[1] or "(_part#" in line or "(_n#" in line, line
    assert text & set(df.columns)


# --- CSV -----------------------------------------------------------------------

def _file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_files_of_one_wave_with_another_header_order(spark):
    folder = local_path(scratch_path(spark, "drift"))
    _file(folder, "one.csv", 'a,"b, ""c"""\n1,2\n3,\n')
    _file(folder, "two.csv", '"b, ""c""",a\r\n5,4\r\n')
    _file(folder, "three.csv", '﻿a,"b, ""c"""\n6,7\n')
    _file(folder, "empty.csv", "")
    df = read_wave_csv(spark, folder)
    assert df.columns == ["a", 'b, "c"'] and sorted(map(repr, map(tuple, df.collect()))) == [
        "('1', '2')", "('3', None)", "('4', '5')", "('6', '7')"]
    assert sorted(len(f) for f in file_headers(spark, folder).values()) == [1, 2]
    _file(folder, "four.csv", "a,d\n8,9\n")
    with pytest.raises(HeaderDrift, match="four.csv"):
        read_wave_csv(spark, folder)
    same = local_path(scratch_path(spark, "same-names"))
    _file(same, "one.csv", "a,,a\n1,2,3\n")
    assert [tuple(r) for r in read_wave_csv(spark, same).collect()] == [("1", "2", "3")]
    _file(same, "two.csv", ",a,a\n1,2,3\n")
    with pytest.raises(HeaderDrift, match="names"):
        read_wave_csv(spark, same)


def test_a_compressed_file_and_a_list_of_folders(spark):
    one, two = scratch_path(spark, "gz"), scratch_path(spark, "plain")
    spark.createDataFrame([("1", "2")], "a string, b string").write.option("header", "true").option(
        "compression", "gzip").csv(one)
    write_wave_csv(spark.createDataFrame([("4", "3")], "b string, a string"), two)
    assert sorted(tuple(r) for r in read_wave_csv(spark, [one, two]).collect()) == [("1", "2"), ("3", "4")]


@pytest.mark.parametrize("split", [97, 1000, 1 << 27])
def test_quoted_line_ends_whatever_the_split_size(spark, split):
    folder, rnd = local_path(scratch_path(spark, "quoted")), random.Random(split)
    for k in range(2):
        rows = []
        for i in range(120):
            v = "".join(rnd.choice(["x", "y,", " ", '"', "\n", "\r\n", "é", ""]) for _ in range(rnd.randint(0, 12)))
            v += "long\n" * (60 if i % 50 == 3 else 0)
            rows.append(f'{k}-{i},"{v.replace(chr(34), chr(34) * 2)}",{i if i % 7 else ""}\n')
        _file(folder, f"f{k}.csv", 'id,"a ""text""",n\n' + "".join(rows))
    _file(folder, "none.csv", 'id,"a ""text""",n\n')
    want = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(folder).collect()
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = read_wave_csv(spark, folder, quoted_line_ends=True)
        rows = got.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got.columns == ["id", 'a "text"', "n"] and len(rows) == 240
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, map(tuple, want)))
    with pytest.raises(HeaderDrift):
        read_wave_csv(spark, folder, columns=["id", "n", "x"], quoted_line_ends=True)


# --- export --------------------------------------------------------------------

def test_a_single_report_file_is_put_together_from_ordered_parts(spark, monkeypatch):
    df = spark.range(2000, numPartitions=8).select((F.col("id") * 7919 % 2000).alias("k"), F.lit('a "b"').alias('say "x"'))
    path = scratch_path(spark, "one-file")
    export_report(df.orderBy("k"), path, single_file=True)
    files = [f for f in os.listdir(local_path(path)) if not f.startswith((".", "_"))]
    lines = open(os.path.join(local_path(path), files[0]), encoding="utf-8").read().splitlines()
    assert len(files) == 1 and lines[0] == '"k","say ""x"""'
    assert lines[1:] == [f'"{k}","a ""b"""' for k in range(2000)]
    assert read_report(spark, path).count() == 2000
    export_report(df.filter("k < 0"), path, single_file=True)  # replaced; only a header is left
    assert read_report(spark, path).columns == ["k", 'say "x"'] and read_report(spark, path).count() == 0
    monkeypatch.setattr(export, "SINGLE_FILE_BYTES", 100)
    with pytest.raises(ValueError, match="too many"):
        export_report(df, path, single_file=True)
    assert read_report(spark, path).count() == 0  # nothing was replaced
