import os

import pytest

import __spark_entry__


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("op", ["op4_exact_dedup", "op8_license_scan", "op11_source_audit"])
def test_queries_match_their_oracles(spark, sf, op):
    import duckdb
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{os.path.join(sf, 'documents.parquet')}'")
        cursor = db.execute(__spark_entry__.oracle_sql()[op])
        names, want = [c[0] for c in cursor.description], cursor.fetchall()
    got = __spark_entry__.queries()[op](spark, sf).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
