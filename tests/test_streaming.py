"""Incremental silver: files arriving in two rounds, exactly-once, deduped at read."""

import os

from wavelake.plans import survey_preset as P
from wavelake.session import local_path, scratch_path
from wavelake.streaming import read_silver, stream_silver

from .test_survey_preset import bronze_rows


def _write_csv(spark, df, folder):
    # each round lands as new files in the watched folder
    df.coalesce(1).write.mode("append").options(header="true", quote='"', escape='"').csv(folder)


def test_stream_two_rounds_then_dedupe(spark):
    q = P.questionnaire()
    edition = [e for e in q.editions if e.name == "2024"][0]
    cols, rows = bronze_rows(2024)
    src = scratch_path(spark, "stream-src")
    target = scratch_path(spark, "stream-silver")
    ckpt = scratch_path(spark, "stream-ckpt")
    _write_csv(spark, spark.createDataFrame(rows[:3], cols), src)
    stream_silver(spark, q, edition, cols, src, target, ckpt, "entities").awaitTermination(120)
    first = spark.read.parquet(target).count()
    assert first == 3
    _write_csv(spark, spark.createDataFrame(rows[3:], cols), src)
    stream_silver(spark, q, edition, cols, src, target, ckpt, "entities").awaitTermination(120)
    assert spark.read.parquet(target).count() == 5            # each file processed once
    ent = read_silver(spark, q, target, "entities")
    assert ent.count() == 4                                    # duplicated id resolved at read time
    assert ent.columns[:2] == ["id_respondente", "ano_pesquisa"]
    # a third run with no new files adds nothing
    stream_silver(spark, q, edition, cols, src, target, ckpt, "entities").awaitTermination(120)
    assert spark.read.parquet(target).count() == 5
    assert os.path.isdir(local_path(ckpt))


def test_stream_answers_uses_static_option_table(spark):
    q = P.questionnaire()
    edition = [e for e in q.editions if e.name == "2025"][0]
    cols, rows = bronze_rows(2025)
    src = scratch_path(spark, "stream-src-ans")
    target = scratch_path(spark, "stream-ans")
    _write_csv(spark, spark.createDataFrame(rows, cols), src)
    stream_silver(spark, q, edition, cols, src, target, scratch_path(spark, "ck"), "answers").awaitTermination(120)
    ans = read_silver(spark, q, target, "answers")
    dims = {r["dimension"] for r in ans.select("dimension").distinct().collect()}
    assert dims == {"prioridade_empresa", "resultado_llm_empresa", "tipo_uso_empresa", "produtividade_pessoal",
                    "barreira_adocao"}


def test_stream_selections_match_batch(spark):
    """The incremental selections equal the batch silver on the same files."""
    from wavelake.plans import silver
    q = P.questionnaire()
    edition = [e for e in q.editions if e.name == "2023"][0]
    cols, rows = bronze_rows(2023)
    src = scratch_path(spark, "stream-src-sel")
    target = scratch_path(spark, "stream-sel")
    _write_csv(spark, spark.createDataFrame(rows, cols), src)
    stream_silver(spark, q, edition, cols, src, target, scratch_path(spark, "ck-sel"), "selections") \
        .awaitTermination(120)
    streamed = read_silver(spark, q, target, "selections")
    one = __import__("dataclasses").replace(q, editions=[edition])
    batch = silver.selections(one, {"2023": spark.createDataFrame(rows, cols)})
    key = ["id_respondente", "ano_pesquisa", "category", "item", "item_original", "item_type"]
    assert sorted(tuple(r) for r in streamed.select(*key).collect()) == \
        sorted(tuple(r) for r in batch.select(*key).collect())
