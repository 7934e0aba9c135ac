"""Metamorphic / property tests on random small frames (brute force in pandas)."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavelake.operators import discover
from wavelake.operators.dedupe import dedupe
from wavelake.operators.harmonize import union_waves
from wavelake.operators.metrics import distinct_share
from wavelake.operators.multiselect import flags_to_long, prefix_options

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

FLAG_VALUES = st.sampled_from(["1", "0", "1.0", "0.0", "", " 1 ", "x", None])
IDS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", " "]))


@SETTINGS
@given(st.lists(st.tuples(IDS, FLAG_VALUES, FLAG_VALUES, FLAG_VALUES), min_size=1, max_size=25))
def test_unpivot_emits_one_row_per_set_flag(spark, rows):
    cols = ["id", "4.d.1_A", "4.d.2_B", "4.d.10_C"]
    df = spark.createDataFrame(rows, "id string, `4.d.1_A` string, `4.d.2_B` string, `4.d.10_C` string")
    opts = prefix_options(cols, "4.d.", discover.UNDERSCORE, category_col="category", category="c",
                          item_col="item", original_col="item_original")
    out = flags_to_long(df, "id", 1, opts, ["category", "item", "item_original"])

    def on(v):
        try:
            return v is not None and float(v.strip()) == 1.0
        except ValueError:
            return False
    expected = sum(on(v) for r in rows if r[0] is not None and r[0].strip() != "" for v in r[1:])
    assert out.count() == expected


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3", None]), st.integers(1, 3),
                          st.sampled_from(["x", "y", "z", None]), st.integers(0, 5)), min_size=1, max_size=30))
def test_dedupe_independent_of_partitioning_and_union_order(spark, rows):
    schema = "k string, wave int, v string, n int"
    df = spark.createDataFrame(rows, schema)
    a = {tuple(r) for r in dedupe(df.repartition(1), ["k", "wave"], ["v", "n"]).collect()}
    b = {tuple(r) for r in dedupe(df.repartition(7), ["k", "wave"], ["v", "n"]).collect()}
    parts = [df.filter(F.col("wave") == w) for w in (1, 2, 3)]
    c = {tuple(r) for r in dedupe(union_waves(parts[::-1]), ["k", "wave"], ["v", "n"]).collect()}
    assert a == b == c
    # brute force: smallest (v, n) per key, NULLs first
    pdf = pd.DataFrame(rows, columns=["k", "wave", "v", "n"])
    expected = set()
    for (k, w), g in pdf.groupby(["k", "wave"], dropna=False):
        best = sorted(g.itertuples(index=False), key=lambda r: ((r.v is not None, r.v or ""), r.n))[0]
        expected.add((None if pd.isna(k) else k, int(w), best.v, int(best.n)))
    assert a == expected


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["i1", "i2", "i3", "i4", None]), st.integers(1, 2),
                          st.sampled_from(["d1", "d2"]), st.sampled_from(["p", "q", "r", "s"]),
                          st.booleans()), min_size=1, max_size=40))
def test_distinct_share_matches_brute_force_and_ranks_are_permutations(spark, rows):
    df = spark.createDataFrame(rows, "id string, wave int, dim string, cat string, counted boolean")
    out = distinct_share(df, ["wave", "dim"], ["cat"], "id", numerator=F.col("counted"), rank_name="rank")
    got = {(r["wave"], r["dim"], r["cat"]): (r["count"], r["total"], r["percent"], r["rank"]) for r in out.collect()}
    pdf = pd.DataFrame(rows, columns=["id", "wave", "dim", "cat", "counted"])
    valid = pdf[pdf["id"].notna()]
    expected = {}
    for (w, d), g in pdf.groupby(["wave", "dim"]):
        base = g["id"].dropna().nunique()
        num = g[g["counted"]]
        for c, gc in num.groupby("cat"):
            q = gc["id"].dropna().nunique()
            pct = ((q * 20000 + base) // (2 * base)) / 100.0 if base else None
            expected[(int(w), d, c)] = (q, base, pct)
    assert {k: v[:3] for k, v in got.items()} == expected
    del valid
    for (w, d) in {(k[0], k[1]) for k in got}:
        ranks = sorted(v[3] for k, v in got.items() if k[:2] == (w, d))
        assert ranks == list(range(1, len(ranks) + 1))
