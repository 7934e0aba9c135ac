"""Preset: the three-edition (2023/2024/2025) data-career survey layout that
the reference processes, and the names of its output tables.

Everything below the FIXED VALUES marker must equal the reference for equal
results (raw headers, block prefixes, option codes, answer rules, aliases,
classes, dimensions, band rules, output names).  ``questionnaire()`` turns
them into the configuration the generic operators take.
"""

from __future__ import annotations

from ..functions.bands import BandSpec
from ..operators.discover import SPACE, TUPLE, UNDERSCORE
from ..operators.harmonize import INT, TEXT, Field
from .config import CategoricalQuestion, CodedBlock, Edition, Questionnaire

# ============================================================================
# FIXED VALUES (must equal the reference)
# ============================================================================

PROFILE_FIELDS = [
    "id_respondente", "idade", "faixa_idade", "genero", "raca_etnia", "pcd", "vive_brasil", "uf", "regiao",
    "nivel_ensino", "area_formacao", "situacao_trabalho", "setor", "numero_funcionarios", "atua_como_gestor",
    "cargo_atual", "senioridade", "faixa_salarial_original", "tempo_experiencia_dados", "tempo_experiencia_ti",
    "satisfeito_emprego", "modelo_trabalho_atual", "modelo_trabalho_ideal",
]

PROFILE_MAP_2023 = {
    "id_respondente": "('P0', 'id')",
    "idade": "('P1_a ', 'Idade')",
    "faixa_idade": "('P1_a_1 ', 'Faixa idade')",
    "genero": "('P1_b ', 'Genero')",
    "raca_etnia": "('P1_c ', 'Cor/raca/etnia')",
    "pcd": "('P1_d ', 'PCD')",
    "vive_brasil": "('P1_g ', 'vive_no_brasil')",
    "uf": "('P1_i_1 ', 'uf onde mora')",
    "regiao": "('P1_i_2 ', 'Regiao onde mora')",
    "nivel_ensino": "('P1_l ', 'Nivel de Ensino')",
    "area_formacao": "('P1_m ', 'Área de Formação')",
    "situacao_trabalho": "('P2_a ', 'Qual sua situação atual de trabalho?')",
    "setor": "('P2_b ', 'Setor')",
    "numero_funcionarios": "('P2_c ', 'Numero de Funcionarios')",
    "atua_como_gestor": "('P2_d ', 'Gestor?')",
    "cargo_atual": "('P2_f ', 'Cargo Atual')",
    "senioridade": "('P2_g ', 'Nivel')",
    "faixa_salarial_original": "('P2_h ', 'Faixa salarial')",
    "tempo_experiencia_dados": "('P2_i ', 'Quanto tempo de experiência na área de dados você tem?')",
    "tempo_experiencia_ti": "('P2_j ', 'Quanto tempo de experiência na área de TI/Engenharia de Software você "
                            "teve antes de começar a trabalhar na área de dados?')",
    "satisfeito_emprego": "('P2_k ', 'Você está satisfeito na sua empresa atual?')",
    "modelo_trabalho_atual": "('P2_r ', 'Atualmente qual a sua forma de trabalho?')",
    "modelo_trabalho_ideal": "('P2_s ', 'Qual a forma de trabalho ideal para você?')",
}

PROFILE_MAP_2024 = {
    "id_respondente": "0.a_token",
    "idade": "1.a_idade",
    "faixa_idade": "1.a.1_faixa_idade",
    "genero": "1.b_genero",
    "raca_etnia": "1.c_cor/raca/etnia",
    "pcd": "1.d_pcd",
    "vive_brasil": "1.g_vive_no_brasil",
    "uf": "1.i.1_uf_onde_mora",
    "regiao": "1.i.2_regiao_onde_mora",
    "nivel_ensino": "1.l_nivel_de_ensino",
    "area_formacao": "1.m_área_de_formação",
    "situacao_trabalho": "2.a_situação_de_trabalho",
    "setor": "2.b_setor",
    "numero_funcionarios": "2.c_numero_de_funcionarios",
    "atua_como_gestor": "2.d_atua_como_gestor",
    "cargo_atual": "2.f_cargo_atual",
    "senioridade": "2.g_nivel",
    "faixa_salarial_original": "2.h_faixa_salarial",
    "tempo_experiencia_dados": "2.i_tempo_de_experiencia_em_dados",
    "tempo_experiencia_ti": "2.j_tempo_de_experiencia_em_ti",
    "satisfeito_emprego": "2.k_satisfeito_atualmente",
    "modelo_trabalho_atual": "2.r_modelo_de_trabalho_atual",
    "modelo_trabalho_ideal": "2.s_modelo_de_trabalho_ideal",
}

PROFILE_MAP_2025 = {
    "id_respondente": "0.a_token",
    "idade": "1.a_idade",
    "faixa_idade": "1.a.1_faixa_idade",
    "genero": "1.b_genero",
    "raca_etnia": "1.c_cor/raca/etnia",
    "pcd": "1.d_pcd",
    "vive_brasil": "1.g_vive_no_brasil",
    "uf": "1.i.1_uf_onde_mora",
    "regiao": "1.i.2_regiao_onde_mora",
    "nivel_ensino": "1.l_nivel_de_ensino",
    "area_formacao": "1.m_área_de_formação",
    "situacao_trabalho": "2.a_situação_de_trabalho",
    "setor": "2.b_setor",
    "numero_funcionarios": "2.c_numero_de_funcionarios",
    "atua_como_gestor": "2.d_atua_como_gestor",
    "cargo_atual": "2.f_cargo_atual",
    "senioridade": "2.g_nivel",
    "faixa_salarial_original": "2.h_faixa_salarial",
    "tempo_experiencia_dados": "2.i_tempo_de_experiencia_em_dados",
    "tempo_experiencia_ti": "2.j_tempo_de_experiencia_em_ti",
    "satisfeito_emprego": "2.k_satisfeito_atualmente",
    "modelo_trabalho_atual": "2.q_modelo_de_trabalho_atual",
    "modelo_trabalho_ideal": "2.r_modelo_de_trabalho_ideal",
}

TECH_PREFIXES = {
    2023: {"linguagem": "('P4_d_", "banco_dados": "('P4_g_", "cloud": "('P4_h_", "bi": "('P4_j_"},
    2024: {"linguagem": "4.d.", "banco_dados": "4.g.", "cloud": "4.h.", "bi": "4.j."},
    2025: {"linguagem": "4.c.", "banco_dados": "4.d.", "cloud": "4.e.", "bi": "4.g."},
}

TECH_QUESTIONS = {
    2023: {"linguagem": "Quais das linguagens listadas abaixo voce utiliza no trabalho?",
           "banco_dados": "Quais dos bancos de dados/fontes de dados listados abaixo voce utiliza no trabalho?",
           "cloud": "Dentre as opcoes listadas, qual sua Cloud preferida?",
           "bi": "Ferramenta de BI utilizada no dia a dia"},
    2024: {"linguagem": "linguagem_de_programacao_(dia_a_dia)", "banco_dados": "banco_de_dados_(dia_a_dia)",
           "cloud": "cloud_(dia_a_dia)", "bi": "ferramenta_de_bi_(dia_a_dia)"},
    2025: {"linguagem": "linguagem_preferida", "banco_dados": "banco_de_dados_(dia_a_dia)",
           "cloud": "cloud_(dia_a_dia)", "bi": "ferramenta_de_bi_(dia_a_dia)"},
}

TECH_COMPARABILITY = {
    2023: {"linguagem": "comparavel", "banco_dados": "comparavel", "cloud": "atencao_semantica",
           "bi": "comparavel"},
    2024: {"linguagem": "comparavel", "banco_dados": "comparavel", "cloud": "comparavel", "bi": "comparavel"},
    2025: {"linguagem": "atencao_semantica", "banco_dados": "comparavel", "cloud": "comparavel",
           "bi": "comparavel"},
}

TECH_ALIASES = {
    "SQL SERVER": "SQL Server",
    "ElasticSearch": "Elasticsearch",
    "Neo4J": "Neo4j",
    "Amazon Quicksight": "Amazon QuickSight",
    "Looker Studio(Google Data Studio)": "Looker Studio (Google Data Studio)",
}

ITEM_CLASS_RULES = [
    ("não utilizo", "nao_utiliza"),
    ("nao utilizo", "nao_utiliza"),
    ("servidores on premise", "nao_cloud"),
    ("análises utilizando apenas excel", "alternativa_planilhas"),
    ("analises utilizando apenas excel", "alternativa_planilhas"),
]
ITEM_DEFAULT_CLASS = "tecnologia"

USE_TYPES = {1: "uso_descentralizado", 2: "direcionamento_centralizado", 3: "copilots_desenvolvedores",
             4: "produtos_externos", 5: "produtos_internos", 6: "principal_frente_negocio",
             7: "nao_prioridade", 8: "nao_sabe"}
PRODUCTIVITY = {1: "nao_usa", 2: "usa_solucao_gratuita", 3: "usa_e_paga", 4: "empresa_paga", 5: "usa_copilot"}
BARRIERS = {1: "falta_compreensao_casos_uso", 2: "falta_confiabilidade_alucinacoes", 3: "incerteza_regulatoria",
            4: "seguranca_privacidade_dados", 5: "roi_nao_comprovado", 6: "dados_nao_prontos",
            7: "falta_expertise_recursos", 8: "alta_direcao_nao_ve_valor", 9: "propriedade_intelectual"}

PRIORITY_RULES = [
    ("principal prioridade como empresa", "prioridade_principal"),
    ("principais prioridades", "alta_prioridade_2_4_anos"),
    ("uma das várias iniciativas", "iniciativa_secundaria"),
    ("uma das varias iniciativas", "iniciativa_secundaria"),
    ("não é uma iniciativa", "nao_prioridade"),
    ("nao é uma iniciativa", "nao_prioridade"),
    ("não sei", "nao_sabe"),
    ("nao sei", "nao_sabe"),
]
RESULT_RULES = [
    ("em produção", "producao_com_impacto"),
    ("em producao", "producao_com_impacto"),
    ('projetos "piloto"', "pilotos_pouco_impacto"),
    ("investigação e planejamento", "investigacao_planejamento"),
    ("investigacao e planejamento", "investigacao_planejamento"),
    ("ainda não começamos", "nao_iniciou"),
    ("ainda nao comecamos", "nao_iniciou"),
    ("não sei", "nao_sabe"),
    ("nao sei", "nao_sabe"),
]

AI_COMPARABLE = "comparavel_2023_2025"
SINGLE_CHOICE, MULTI_SELECT = "categorica", "multisselecao"

# numbered multi-select blocks and single-choice questions of each wave
CODED_BLOCKS = {
    2023: [CodedBlock("tipo_uso_empresa", "P3_f_", USE_TYPES, AI_COMPARABLE),
           CodedBlock("tipo_uso_empresa", "P4_l_", USE_TYPES, AI_COMPARABLE),
           CodedBlock("produtividade_pessoal", "P4_m_", PRODUCTIVITY, AI_COMPARABLE),
           CodedBlock("barreira_adocao", "P3_g_", BARRIERS, AI_COMPARABLE)],
    2024: [CodedBlock("tipo_uso_empresa", "3.f.", USE_TYPES, AI_COMPARABLE),
           CodedBlock("tipo_uso_empresa", "4.l.", USE_TYPES, AI_COMPARABLE),
           CodedBlock("produtividade_pessoal", "4.m.", PRODUCTIVITY, AI_COMPARABLE),
           CodedBlock("barreira_adocao", "3.g.", BARRIERS, AI_COMPARABLE)],
    2025: [CodedBlock("tipo_uso_empresa", "3.f.", USE_TYPES, AI_COMPARABLE),
           CodedBlock("tipo_uso_empresa", "4.i.", USE_TYPES, AI_COMPARABLE),
           CodedBlock("produtividade_pessoal", "4.j.", PRODUCTIVITY, AI_COMPARABLE),
           CodedBlock("barreira_adocao", "3.h.", BARRIERS, AI_COMPARABLE)],
}
QUESTIONS = {
    2023: [CategoricalQuestion("prioridade_empresa", "('P3_e ', 'AI Generativa é uma prioridade em sua empresa?')",
                               PRIORITY_RULES, AI_COMPARABLE, "P3_e / 3.e")],
    2024: [CategoricalQuestion("prioridade_empresa", "3.e_ai_generativa_e_llm_é_uma_prioridade?",
                               PRIORITY_RULES, AI_COMPARABLE, "P3_e / 3.e")],
    2025: [CategoricalQuestion("prioridade_empresa", "3.e_ai_generativa_e_llm_é_uma_prioridade?",
                               PRIORITY_RULES, AI_COMPARABLE, "P3_e / 3.e"),
           CategoricalQuestion("resultado_llm_empresa", "3.g_empresa_está_conseguindo_ter_bons_resultados_com_llms",
                               RESULT_RULES, "somente_2025", "3.g")],
}

PROFILE_DIMENSIONS = ["senioridade", "genero", "raca_etnia", "pcd", "regiao", "cargo_atual",
                      "modelo_trabalho_atual", "nivel_ensino", "situacao_trabalho"]
PAY_DIMENSIONS = ["senioridade", "genero", "regiao", "cargo_atual"]
PAY_OVERALL = ("geral", "todos")
# currency sign, optional spaces, digits with dots between thousands
BAND_SPEC = BandSpec(amount_pattern=r"R\$\s*([0-9\.]+)", thousands_sep=".", 
                     anomaly_prefixes=("de R$ 101/",), anomaly_contains=("R$ 3000/",),
                     order_overrides={"de R$ 101/": 1001})

WAVE, ID = "ano_pesquisa", "id_respondente"

OUTPUT_NAMES = {
    "entities": {},
    "selections": {"category": "categoria", "item": "tecnologia", "item_original": "tecnologia_original",
                   "item_type": "tipo_item", "question": "pergunta_origem", "comparability": "comparabilidade"},
    "answers": {"dimension": "dimensao", "answer": "resposta", "answer_original": "resposta_original",
                "answer_type": "tipo_resposta", "comparability": "comparabilidade", "block": "bloco_origem"},
    "profile": {"dimension": "dimensao", "category": "categoria", "count": "quantidade",
                "total_valid": "total_validos", "percent": "percentual", "rank": "ranking"},
    "pay": {"analysis_dimension": "dimensao_analise", "analysis_category": "categoria_analise",
            "faixa_salarial_original": "faixa_salarial_original", "band_order": "faixa_salarial_ordem",
            "band_anomaly": "anomalia_faixa_salarial", "count": "quantidade", "total_valid": "total_validos",
            "percent": "percentual"},
    "technologies": {"category": "categoria", "item": "tecnologia", "adopters": "qtd_profissionais",
                     "category_base": "total_respondentes_categoria", "adoption_percent": "percentual_adocao",
                     "rank": "ranking", "comparability": "comparabilidade"},
    "gold_answers": {"dimension": "dimensao", "answer": "resposta", "respondents": "qtd_respondentes",
                     "dimension_base": "total_respondentes_dimensao", "percent": "percentual", "rank": "ranking",
                     "answer_type": "tipo_resposta", "percents_sum_to_100": "percentuais_somam_100",
                     "comparability": "comparabilidade"},
}

TABLE_NAMES = {"entities": "silver_respondentes", "selections": "silver_tecnologias", "answers": "silver_ia",
               "profile": "gold_perfil_mercado", "pay": "gold_remuneracao", "technologies": "gold_tecnologias",
               "gold_answers": "gold_ia"}

# column names of the exported report files
REPORT_HEADERS = {
    "01_senioridade": ["ano_pesquisa", "senioridade", "quantidade", "total_validos", "percentual", "ranking"],
    "02_genero": ["ano_pesquisa", "genero", "quantidade", "total_validos", "percentual"],
    "03_regiao": ["ano_pesquisa", "regiao", "quantidade", "percentual"],
    "04_modelo_trabalho": ["ano_pesquisa", "modelo_trabalho", "quantidade", "percentual"],
    "05_remuneracao_senioridade": ["ano_pesquisa", "senioridade", "faixa_salarial", "quantidade", "percentual",
                                   "faixa_salarial_ordem"],
    "06_top_tecnologias": ["ano_pesquisa", "categoria", "ranking", "tecnologia", "qtd_profissionais",
                           "percentual_adocao", "comparabilidade"],
    "07_ia": ["ano_pesquisa", "dimensao", "resposta", "qtd_respondentes", "percentual", "ranking",
              "percentuais_somam_100"],
}

# ============================================================================

PROFILE_MAPS = {2023: PROFILE_MAP_2023, 2024: PROFILE_MAP_2024, 2025: PROFILE_MAP_2025}


def _edition(year: int) -> Edition:
    blocks = {cat: (prefix, TECH_QUESTIONS[year][cat], TECH_COMPARABILITY[year][cat])
              for cat, prefix in TECH_PREFIXES[year].items()}
    headers = dict(PROFILE_MAPS[year])
    return Edition(name=str(year), style=TUPLE if year == 2023 else UNDERSCORE, id_header=headers.pop(ID),
                   profile_map=headers, wave=year, prefix_blocks=blocks, coded_blocks=CODED_BLOCKS[year],
                   categorical=QUESTIONS[year], coded_style=TUPLE if year == 2023 else SPACE)


def questionnaire() -> Questionnaire:
    fields = [Field(name, INT if name == "idade" else TEXT) for name in PROFILE_FIELDS]
    return Questionnaire(fields=fields, editions=[_edition(y) for y in (2023, 2024, 2025)], id_name=ID,
                         wave_name=WAVE, dedupe_nulls_last=True, blank_as_null=False, aliases=TECH_ALIASES, class_rules=ITEM_CLASS_RULES,
                         item_class=ITEM_DEFAULT_CLASS, single_choice=SINGLE_CHOICE, multi_select=MULTI_SELECT,
                         profile_dims=PROFILE_DIMENSIONS, band_field="faixa_salarial_original",
                         band_dims=PAY_DIMENSIONS, band_overall=PAY_OVERALL, band_spec=BAND_SPEC)

