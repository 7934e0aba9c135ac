"""Column helpers: safe names, cleaning, tolerant casts, flags, rules, bands."""

from pyspark.sql import functions as F

from wavelake.functions import (BandSpec, alias, band_anomaly, band_order, classify, clean_text, is_selected,
                                ordered_rules, percent, safe_col, tolerant_int)


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_safe_col_handles_dotted_and_tuple_headers(spark):
    df = spark.createDataFrame([("a", "b", "c")], ["4.d.1_Python", "('P2_g ', 'Nivel')", "we`ird"])
    got = df.select(safe_col("4.d.1_Python"), safe_col("('P2_g ', 'Nivel')"), safe_col("we`ird")).first()
    assert tuple(got) == ("a", "b", "c")


def test_clean_text_trims_spaces_and_blanks_to_null(spark):
    df = spark.createDataFrame([(" x ",), ("",), ("   ",), (None,), ("\ty",)], ["v"])
    assert [r[0] for r in df.select(clean_text("v")).collect()] == ["x", None, None, None, "\ty"]


def test_tolerant_int_never_fails_under_ansi(spark):
    df = spark.createDataFrame([("29",), ("29.0",), ("29.7",), ("",), ("x",), (None,), (" 31 ",)], ["v"])
    assert [r[0] for r in df.select(tolerant_int("v")).collect()] == [29, 29, 29, None, None, None, 31]


def test_is_selected_parses_numeric_one_only(spark):
    vals = ["1", "1.0", " 1 ", "0", "", "abc", None, "2"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r[0] for r in df.select(is_selected("v")).collect()] == [True, True, True, False, False, False, False,
                                                                       False]


def test_ordered_rules_first_match_wins_and_fallback_keeps_trimmed_text(spark):
    rules = [("não sei", "nao_sabe"), ("nao sei", "nao_sabe"), ("principal", "top"), ("prioridade", "some")]
    df = spark.createDataFrame([("  É a principal PRIORIDADE ",), ("Não sei",), (" outra coisa ",), ("nao sei",)],
                               ["v"])
    got = [r[0] for r in df.select(ordered_rules("v", rules)).collect()]
    assert got == ["top", "nao_sabe", "outra coisa", "nao_sabe"]


def test_ordered_rules_no_accent_folding_by_default(spark):
    df = spark.createDataFrame([("Não sei",)], ["v"])
    assert df.select(ordered_rules("v", [("nao sei", "x")])).first()[0] == "Não sei"
    assert df.select(ordered_rules("v", [("nao sei", "x")], fold_accents=True)).first()[0] == "x"


def test_alias_exact_match_and_classify_on_original(spark):
    aliases = {"SQL SERVER": "SQL Server", "Neo4J": "Neo4j"}
    df = spark.createDataFrame([("SQL SERVER",), ("sql server",), ("Neo4J ",), ("Não utilizo",)], ["v"])
    assert [r[0] for r in df.select(alias("v", aliases)).collect()] == ["SQL Server", "sql server", "Neo4j",
                                                                        "Não utilizo"]
    cls = classify("v", [("não utilizo", "nao_utiliza"), ("server", "srv")], "tecnologia")
    assert [r[0] for r in df.select(cls).collect()] == ["srv", "srv", "tecnologia", "nao_utiliza"]


def test_band_order_and_anomaly(spark):
    spec = BandSpec(amount_pattern=r"R\$\s*([0-9\.]+)", thousands_sep=".", anomaly_prefixes=("de R$ 101/",), anomaly_contains=("R$ 3000/",),
                    order_overrides={"de R$ 101/": 1001})
    bands = ["Menos de R$ 1.000/mês", "de R$ 101/mês a R$ 2.000/mês", "de R$ 2.001/mês a R$ 3000/mês",
             "Acima de R$ 40.001/mês", "Prefiro não informar"]
    df = spark.createDataFrame([(b,) for b in bands], ["b"])
    got = rows(df, band_order("b", spec), band_anomaly("b", spec))
    assert got == [(1000, False), (1001, True), (2001, True), (40001, False), (None, False)]


def test_percent_is_half_up_on_golden_rows(spark):
    # published shares of the reference's dashboard export
    cases = [(1419, 3857, 36.79), (1392, 3857, 36.09), (1046, 3857, 27.12), (193, 1046, 18.45),
             (22, 1046, 2.1), (275, 896, 30.69), (201, 20000, 1.01), (1, 8, 12.5)]
    df = spark.createDataFrame([(q, t) for q, t, _ in cases], "q long, t long")
    got = [r[0] for r in df.select(percent("q", "t")).collect()]
    assert got == [e for _, _, e in cases]


def test_percent_matches_integer_half_up_everywhere(spark):
    t = 4000
    df = spark.range(0, t + 1).select(F.col("id").alias("q"), F.lit(t).cast("long").alias("t"))
    got = [r["p"] for r in df.select(F.col("q"), percent("q", "t").alias("p")).orderBy("q").collect()]
    expected = [((q * 20000 + t) // (2 * t)) / 100.0 for q in range(t + 1)]
    assert got == expected
