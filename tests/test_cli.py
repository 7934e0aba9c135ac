"""The command line end to end on the preset fixture: CSV wave folders in,
written tables and the seven dashboard report files out."""

import os

from wavelake.__main__ import export_reports, main
from wavelake.plans.survey_preset import REPORT_HEADERS, TABLE_NAMES
from wavelake.session import local_path, scratch_path
from wavelake.sources.csv import write_wave_csv

from .test_survey_preset import bronze_rows


def test_cli_run_then_reports(spark):
    waves = []
    for year in (2023, 2024, 2025):
        cols, rows = bronze_rows(year)
        path = scratch_path(spark, f"cli-bronze-{year}")
        write_wave_csv(spark.createDataFrame(rows, cols), path)
        waves += ["--wave", f"{year}={path}"]
    root = scratch_path(spark, "cli-lake")
    assert main(["run", *waves, "--root", root]) == 0
    assert spark.table("gold_ia").count() == 86
    out = scratch_path(spark, "cli-reports")
    written = export_reports(spark, root, out)
    assert len(written) == 7
    for path in written:
        name = os.path.basename(path)
        files = [f for f in os.listdir(local_path(path)) if f.endswith(".csv")]
        header = open(os.path.join(local_path(path), files[0]), encoding="utf-8").readline().strip()
        assert header == '"' + '","'.join(REPORT_HEADERS[name]) + '"'
    for table in TABLE_NAMES.values():  # external: the files stay
        spark.sql(f"DROP TABLE {table}")
