"""Command line: run the survey job on wave folders and export reports.

    python -m wavelake run --wave 2023=/lake/bronze/ano=2023 --wave 2024=... --root /lake
    python -m wavelake reports --root /lake --out /lake/reports

``run`` reads each wave's CSV folder (all strings), lands it as Parquet,
builds and writes the three silver and four gold tables (survey preset names),
publishes them together and registers them as external tables of the session's
catalog.  Given some of the waves, it replaces these and keeps the others.  ``reports`` exports the
dashboard reports of the written tables (quoted CSV, one folder per report).
"""

from __future__ import annotations

import argparse
import dataclasses
import sys

from . import scratch
from .plans import medallion, reports
from .plans import survey_preset as P
from .session import get_spark
from .sources import export_report, read_table, read_wave_csv


def _waves(specs: list[str]) -> dict[str, str]:
    out = {}
    for spec in specs:
        year, _, path = spec.partition("=")
        if not year.isdigit() or not path:
            raise SystemExit(f"--wave expects YEAR=PATH, got {spec!r}")
        out[year] = path
    return out


def _engine_tables(spark, root: str) -> dict:
    """Written tables read back under the engine's column names."""
    out = {}
    for key, table in P.TABLE_NAMES.items():
        layer = "silver" if key in medallion.SILVER else "gold"
        df = read_table(spark, f"{root.rstrip('/')}/{layer}/{table}")
        inverse = {v: k for k, v in P.OUTPUT_NAMES[key].items()}
        out[key] = df.select(*[df[c].alias(inverse.get(c, c)) for c in df.columns])
    return out


REPORTS = {
    "01_senioridade": lambda s, n: reports.profile_report(s, "senioridade", "senioridade", True, True, names=n),
    "02_genero": lambda s, n: reports.profile_report(s, "genero", "genero", True, False, names=n),
    "03_regiao": lambda s, n: reports.profile_report(s, "regiao", "regiao", False, False, names=n),
    "04_modelo_trabalho": lambda s, n: reports.profile_report(s, "modelo_trabalho_atual", "modelo_trabalho",
                                                               False, False, names=n),
    "05_remuneracao_senioridade": lambda s, n: reports.band_by_dimension(s, "senioridade", "senioridade", names=n),
    "06_top_tecnologias": lambda s, n: reports.top_technologies(s, 5, names=n),
    "07_ia": lambda s, n: reports.indicator_subset(s, ["prioridade_empresa", "resultado_llm_empresa"], names=n),
}


def export_reports(spark, root: str, out: str) -> list[str]:
    names = reports.register(_engine_tables(spark, root),
                             names={**{k: f"wl_{k}" for k in P.TABLE_NAMES}, "wave": P.WAVE, "id": P.ID,
                                    "band": "faixa_salarial_original"})
    written = []
    for name, build in REPORTS.items():
        path = f"{out.rstrip('/')}/{name}"
        export_report(build(spark, names).toDF(*P.REPORT_HEADERS[name]), path, single_file=True)
        written.append(path)
    return written


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="wavelake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="bronze CSV waves -> silver + gold tables")
    run.add_argument("--wave", action="append", required=True, help="YEAR=PATH of one wave's CSV folder")
    run.add_argument("--root", required=True, help="lake root for bronze_landed/, silver/, gold/")
    run.add_argument("--quoted-line-ends", action="store_true", help="values in quotes may hold line ends")
    run.add_argument("--large-scale", action="store_true", help="apply the large-cluster session settings")
    rep = sub.add_parser("reports", help="export the dashboard reports from written tables")
    rep.add_argument("--root", required=True)
    rep.add_argument("--out", required=True)
    args = ap.parse_args(argv)
    spark = get_spark(large_scale=getattr(args, "large_scale", False))
    if args.cmd == "run":
        q, waves = P.questionnaire(), _waves(args.wave)
        known = {e.name for e in q.editions}
        if set(waves) - known:
            raise SystemExit(f"no layout for waves {sorted(set(waves) - known)}")
        q = dataclasses.replace(q, editions=[e for e in q.editions if e.name in waves])
        with scratch.scope(spark):
            bronze = {year: read_wave_csv(spark, path, quoted_line_ends=args.quoted_line_ends)
                      for year, path in waves.items()}
            medallion.run(spark, q, bronze, args.root, table_names=P.TABLE_NAMES, output_names=P.OUTPUT_NAMES,
                          catalog=True)
    else:
        for path in export_reports(spark, args.root, args.out):
            print(path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
