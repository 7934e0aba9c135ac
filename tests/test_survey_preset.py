"""The reference's own survey layout, end to end on a small hand-made fixture:
wide CSV (real header forms) -> silver -> gold, persisted and registered, then
the dashboard SQL.  Structural checks follow the reference's published facts
(gold AI rows = 3 waves x (5 + 8 + 5 + 9) + 5 = 86 when every option occurs)."""

import pytest
from pyspark.sql import functions as F

from wavelake.plans import medallion, reports
from wavelake.plans import survey_preset as P
from wavelake.session import scratch_path
from wavelake.sources.csv import read_wave_csv, write_wave_csv

PRIORITY_TEXTS = [
    "Sim, é a principal prioridade como empresa",
    "Sim, está entre as principais prioridades",
    "É uma das várias iniciativas",
    "Não é uma iniciativa prioritária",
    "Não sei opinar",
]
RESULT_TEXTS = [
    "Sim, já temos soluções em produção",
    'Temos projetos "piloto" com pouco impacto',
    "Estamos em fase de investigação e planejamento",
    "Ainda não começamos",
    "Não sei",
]
TECH_OPTIONS = {
    "linguagem": ["SQL", "Python", "R", "Não utilizo nenhuma"],
    "banco_dados": ["SQL SERVER", "Neo4J", "ElasticSearch"],
    "cloud": ["AWS", "Servidores On Premise/Não utilizamos Cloud"],
    "bi": ["Amazon Quicksight", "Looker Studio(Google Data Studio)", "Não utilizo nenhuma ferramenta de BI"],
}
BANDS = ["Menos de R$ 1.000/mês", "de R$ 101/mês a R$ 2.000/mês", "de R$ 2.001/mês a R$ 3000/mês",
         "de R$ 3.001/mês a R$ 4.000/mês", "Acima de R$ 40.001/mês"]
LEVELS = ["Júnior", "Pleno", "Sênior", "Júnior", ""]


def _flag_header(year, prefix, n, label):
    return f"{prefix}{n} ', '{label}')" if year == 2023 else f"{prefix}{n}_{label}"


def _coded_header(year, prefix, n, label):
    return f"('{prefix}{n} ', '{label}')" if year == 2023 else f"{prefix}{n} {label}"


def bronze_rows(year, n_resp=5):
    cols, rows = [], [[] for _ in range(n_resp)]

    def add(header, values):
        cols.append(header)
        for r, v in zip(rows, values):
            r.append(v)
    pmap = P.PROFILE_MAPS[year]
    ids = [f"{year}-{i}" for i in range(n_resp)]
    ids[-1] = ids[0]                                     # a duplicated respondent
    for field, header in pmap.items():
        if field == "id_respondente":
            add(header, ids)
        elif field == "idade":
            add(header, ["29.0", "31", "", "x", "40"])
        elif field == "senioridade":
            add(header, LEVELS)
        elif field == "faixa_salarial_original":
            add(header, BANDS)
        elif field == "genero":
            add(header, ["Feminino", "Masculino", " Masculino ", None, "Feminino"])
        else:
            add(header, [f"{field}-{i % 2}" for i in range(n_resp)])
    for cat, prefix in P.TECH_PREFIXES[year].items():
        for n, label in enumerate(TECH_OPTIONS[cat], start=1):
            flag = "1.0" if year == 2024 else "1"
            add(_flag_header(year, prefix, n, label), [flag if (i + n) % 2 == 0 else "0" for i in range(n_resp)])
    for question, texts in zip(P.QUESTIONS[year], (PRIORITY_TEXTS, RESULT_TEXTS), strict=False):
        add(question.header, texts[:n_resp])
    for b, block in enumerate(P.CODED_BLOCKS[year]):
        for n in block.codes:
            add(_coded_header(year, block.prefix, n, f"opção {n} do bloco"),
                ["1" if (i + n + b) % 2 == 0 else "0" for i in range(n_resp)])
    return cols, [tuple(r) for r in rows]


@pytest.fixture(scope="module")
def bronze(spark):
    out = {}
    for year in (2023, 2024, 2025):
        cols, rows = bronze_rows(year)
        df = spark.createDataFrame(rows, cols)
        path = scratch_path(spark, f"preset-bronze-{year}")
        write_wave_csv(df, path)                         # real CSV round trip of the odd headers
        back = read_wave_csv(spark, path)
        assert back.columns == cols
        out[str(year)] = back
    return out


@pytest.fixture(scope="module")
def tables(spark, bronze):
    root = scratch_path(spark, "preset-lake")
    return medallion.run(spark, P.questionnaire(), bronze, root, table_names=P.TABLE_NAMES,
                        output_names=P.OUTPUT_NAMES)


def test_silver_schemas_match_reference(spark, tables):
    cols = spark.table("silver_respondentes").columns
    assert cols[:3] == ["id_respondente", "ano_pesquisa", "idade"] and len(cols) == 24
    assert set(spark.table("silver_tecnologias").columns) == {
        "id_respondente", "ano_pesquisa", "categoria", "tecnologia", "tecnologia_original", "tipo_item",
        "pergunta_origem", "comparabilidade"}
    assert set(spark.table("silver_ia").columns) == {
        "id_respondente", "ano_pesquisa", "dimensao", "resposta", "resposta_original", "tipo_resposta",
        "comparabilidade", "bloco_origem"}


def test_entities_deduplicated_and_typed(tables):
    ent = tables["entities"]
    assert ent.count() == 12                              # 5 rows, one duplicate id, per wave
    ages = {r["idade"] for r in ent.collect()}
    assert {29, 31, None} <= ages
    genders = {r["genero"] for r in ent.collect()}
    assert "Masculino" in genders and " Masculino " not in genders


def test_aliases_and_classes(tables):
    sel = tables["selections"]
    techs = {r["item"] for r in sel.collect()}
    assert {"SQL Server", "Neo4j", "Elasticsearch", "Amazon QuickSight",
            "Looker Studio (Google Data Studio)"} <= techs
    classes = {(r["item_original"], r["item_type"]) for r in sel.collect()}
    assert ("Não utilizo nenhuma", "nao_utiliza") in classes
    assert ("Servidores On Premise/Não utilizamos Cloud", "nao_cloud") in classes
    assert ("Python", "tecnologia") in classes


def test_answers_rules_and_blocks(tables):
    ans = tables["answers"]
    prio = {r["answer"] for r in ans.filter(F.col("dimension") == "prioridade_empresa").collect()}
    assert prio == {"prioridade_principal", "alta_prioridade_2_4_anos", "iniciativa_secundaria", "nao_prioridade",
                    "nao_sabe"}
    res = {r["answer"] for r in ans.filter(F.col("dimension") == "resultado_llm_empresa").collect()}
    assert res == {"producao_com_impacto", "pilotos_pouco_impacto", "investigacao_planejamento", "nao_iniciou",
                   "nao_sabe"}
    # the two use blocks merged: one row per (wave, id, answer), first block kept
    use = ans.filter(F.col("dimension") == "tipo_uso_empresa")
    assert use.count() == use.select("ano_pesquisa", "id_respondente", "answer").distinct().count()
    assert {r["block"] for r in use.collect()} <= {"P3_f_", "P4_l_", "3.f.", "4.l.", "4.i."}


def test_gold_answer_rows_are_structural(spark):
    # every option occurs in every wave: 3 x (5 + 8 + 5 + 9) + 5 rows
    g = spark.table("gold_ia")
    assert g.count() == 86
    per = {(r["dimensao"]): r["n"] for r in g.groupBy("dimensao").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per == {"prioridade_empresa": 15, "tipo_uso_empresa": 24, "produtividade_pessoal": 15,
                   "barreira_adocao": 27, "resultado_llm_empresa": 5}
    flags = {(r["tipo_resposta"], r["percentuais_somam_100"]) for r in g.collect()}
    assert flags == {("categorica", True), ("multisselecao", False)}


def test_gold_pay_flags_anomalies_and_orders(spark):
    pay = spark.table("gold_remuneracao")
    rows = {r["faixa_salarial_original"]: (r["faixa_salarial_ordem"], r["anomalia_faixa_salarial"])
            for r in pay.filter("dimensao_analise = 'geral'").collect()}
    assert rows["Menos de R$ 1.000/mês"] == (1000, False)
    assert rows["de R$ 101/mês a R$ 2.000/mês"] == (1001, True)
    assert rows["de R$ 2.001/mês a R$ 3000/mês"] == (2001, True)


def test_dashboard_sql_runs_on_registered_tables(spark, tables):
    names = {"entities": "silver_respondentes", "selections": "silver_tecnologias", "answers": "silver_ia",
             "profile": "gold_perfil_mercado", "pay": "gold_remuneracao", "technologies": "gold_tecnologias",
             "gold_answers": "gold_ia"}
    # the engine's report texts read engine column names: run them on the
    # read-back frames registered under the engine names
    eng = reports.register(tables, names={**{k: f"eng_{k}" for k in tables}, "wave": P.WAVE, "id": P.ID,
                                          "band": "faixa_salarial_original"})
    top = reports.top_technologies(spark, 5, names=eng).collect()
    assert top and all(r["rank"] <= 5 for r in top)
    counts = {r["table_name"]: r["row_count"] for r in reports.gold_row_counts(spark, names=eng).collect()}
    assert counts["profile"] == spark.table(names["profile"]).count()
    one = reports.single_wave_share(spark, 2025, "resultado_llm_empresa", names=eng).collect()
    assert abs(sum(r["percent"] for r in one) - 100.0) < 0.05
    band = reports.band_by_dimension(spark, "senioridade", "senioridade", names=eng).collect()
    assert band and not any(r["faixa_salarial_original"].startswith("de R$ 101/") for r in band)
    prof = reports.profile_report(spark, "senioridade", "senioridade", True, True, names=eng).collect()
    assert [r["rank"] for r in prof if r[P.WAVE] == 2023] == [1, 2, 3]


def test_gold_schemas_match_reference_types(spark, tables):
    """Column names, types and order of the four gold tables as the reference
    defines them (the registered views keep the wave first)."""
    from wavelake.operators.quality import schema_check
    expected = {
        "gold_perfil_mercado": [("dimensao", "string"), ("categoria", "string"), ("quantidade", "bigint"),
                                ("total_validos", "bigint"), ("percentual", "double"), ("ranking", "int")],
        "gold_remuneracao": [("dimensao_analise", "string"), ("categoria_analise", "string"),
                             ("faixa_salarial_original", "string"), ("faixa_salarial_ordem", "int"),
                             ("anomalia_faixa_salarial", "boolean"), ("quantidade", "bigint"),
                             ("total_validos", "bigint"), ("percentual", "double")],
        "gold_tecnologias": [("categoria", "string"), ("tecnologia", "string"), ("qtd_profissionais", "bigint"),
                             ("total_respondentes_categoria", "bigint"), ("percentual_adocao", "double"),
                             ("ranking", "int"), ("comparabilidade", "string")],
        "gold_ia": [("dimensao", "string"), ("resposta", "string"), ("qtd_respondentes", "bigint"),
                    ("total_respondentes_dimensao", "bigint"), ("percentual", "double"), ("ranking", "int"),
                    ("tipo_resposta", "string"), ("percentuais_somam_100", "boolean"),
                    ("comparabilidade", "string")],
    }
    for table, cols in expected.items():
        problems = schema_check(spark.table(table), [("ano_pesquisa", "int")] + cols).collect()
        assert problems == [], (table, problems)
