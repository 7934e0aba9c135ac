"""Tables for the tests: documents with nulls, repeats and columns whose names
clash with what the operators add."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, fingerprint string, "
          "kept boolean, lang_pred string, spans string, bucket int, h bigint")


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text) or (doc_id, text, lang)."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, "s", 1, 7, "x", None, "y", "z", 1, 2)
                                  for r in rows], SCHEMA)


def prose(seed: int, n: int, words: int = 300) -> list[str]:
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdeéilnorstuß") for _ in range(rnd.randint(1, 9))) for _ in range(words)]
    return [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(20, 120))) for _ in range(n)]


ODD = [None, "", " \n\t ", "!!! ... ###", "one", "two words", "Ünï \U0001f600 tail", "A" * 5000,
       "x\x00y \x1c z", "word " * 3000]
