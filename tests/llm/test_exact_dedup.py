import hashlib

from pyspark.sql import functions as F

from wavelake.llm import exact_dedup

from .helpers import ODD, documents, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc)
    out = []
    for doc, text in rows:
        t = (text or "").translate(LOWER)
        keep = max((d for d in groups[t] if d is not None), default=None)
        out.append((repr(doc), repr(keep), len(groups[t]), doc == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((repr(r.doc_id), repr(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in df.collect())


def rows():
    base = prose(4, 20)
    long = "\n".join(prose(5, 60))
    texts = [*base, *[t.upper() for t in base[:6]], *base[:4], long, long + " ", long.replace("a", "A"), long[:-1] + "é",
             "É", "é", *ODD]
    return [*enumerate(texts), (None, base[0]), (None, "alone"), (2, base[2]), (2, base[2])]


def test_matches_grouping_by_text(spark):
    assert result(exact_dedup.exact_duplicates(documents(spark, rows()))) == plain(rows())


def test_colliding_chunks_are_told_apart(spark):
    weak = lambda c: F.struct(F.length(c).alias("a"))  # noqa: E731  all chunks of a length collide
    assert result(exact_dedup.exact_duplicates(documents(spark, rows()), fingerprint=weak)) == plain(rows())


def test_chunks_cover_the_text_and_survive_an_insertion(spark):
    text = ". ".join(prose(6, 40))
    df = spark.createDataFrame([(0, text), (1, "New start. " + text), (2, "x" * 9000)], "i int, t string")
    found = {r.i: r.c for r in df.select("i", F.regexp_extract_all("t", F.lit(exact_dedup.CHUNK), F.lit(0)).alias(
        "c")).collect()}
    assert "".join(found[0]) == text and "".join(found[2]) == "x" * 9000
    assert len(set(found[0]) & set(found[1])) >= 0.5 * len(found[0]) > 3


def test_plan_is_built_ins_only_and_empty_table(spark):
    df = exact_dedup.exact_duplicates(documents(spark, []))
    assert df.collect() == []
    assert "Python" not in df._jdf.queryExecution().toString()
