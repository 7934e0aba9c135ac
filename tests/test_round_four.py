"""Operators whose rows must not multiply before a shuffle."""

import itertools
import random

from pyspark.sql import functions as F

from wavelake.operators import metrics, quality
from wavelake.operators.dedupe import dedupe
from wavelake.operators.harmonize import union_waves
from wavelake.operators.multiselect import Option, distinct_flags, flags_to_long
from wavelake.plans import gold
from wavelake.plans import queries as Q


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _forms(spark, widths=(150, 9, 64), people=60):
    """Three editions; options of one item occur twice in an edition and in
    several, ids are NULL, blank and repeated, cells of every spelling."""
    rng = random.Random(7)
    parts = []
    for e, width in enumerate(widths):
        headers = [f"q{e}.{i} (x)" for i in range(width)]
        ticks = ["1", "1.0", " 1 ", "0", "", None, "junk", "2"]
        rows = [[rng.choice([None, " ", *[f"p{k}" for k in range(people // 3)]]), rng.choice([None, "1999", "2000"]),
                 *[rng.choice(ticks) for _ in headers]] for _ in range(people)]
        df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in ["id", "year", *headers]))
        options = [Option(h, {"category": f"c{i % 3}", "item": f"i{i % 40}", "original": rng.choice([None, f"o{e}{i % 7}"]),
                              "question": f"q{i % 2}"}) for i, h in enumerate(headers)]
        parts.append((df, "id", "year", options))
    return parts


COLUMNS, KEYS, ORDER = ["category", "item", "original", "question"], ["category", "item"], ["original", "question"]


def test_masks_give_the_rows_of_a_dedupe_of_long_rows(spark):
    parts = _forms(spark)
    long = union_waves([flags_to_long(*p, COLUMNS) for p in parts])
    expected = dedupe(long, ["wave", "entity_id", *KEYS], order=ORDER)
    assert _rows(distinct_flags(parts, COLUMNS, KEYS, ORDER)) == _rows(expected) != []


def test_editions_without_options_and_forms_without_ticks(spark):
    empty = spark.createDataFrame([("p1", "2000", None), ("p2", "2000", "0")], "id string, year string, a string")
    full = spark.createDataFrame([("p1", "2000", "1")], "id string, year string, b string")
    values = {"category": "c", "item": "i", "original": "o", "question": "q"}
    parts = [(empty, "id", "year", []), (empty, "id", "year", [Option("a", values)]),
             (full, "id", "year", [Option("b", values)])]
    assert _rows(distinct_flags(parts, COLUMNS, KEYS, ORDER)) == [("p1", 2000, "c", "i", "o", "q")]


def test_one_row_per_form_is_shuffled(spark):
    plan = _plan(distinct_flags(_forms(spark), COLUMNS, KEYS, ORDER))
    assert plan.count("Exchange hashpartitioning(") == 1 and "Expand" not in plan
    exchange = next(line for line in plan.splitlines() if "Exchange hashpartitioning(" in line)
    assert exchange.split("hashpartitioning(")[1].count("#") == 2  # id and wave, no item


def test_shares_of_unique_items_equal_those_of_distinct_ids(spark):
    rng = random.Random(3)
    every = list(itertools.product([1, 2, None], ["a", "b", None], ["x", "y", "z"], [None, *range(12)]))
    rows = [(w, c, i, "item" if i != "z" else "none", k) for w, c, i, k in rng.sample(every, len(every) // 2)]
    df = spark.createDataFrame(rows, "wave int, category string, item string, kind string, id int")
    for bounded in (True, False):
        def share(unique):
            return metrics.distinct_share(df, ["wave", "category"], ["item", "kind"], "id", rank_name="rank",
                                          numerator=F.col("kind") == "item", unique_items=unique, bounded=bounded)
        assert _rows(share(True)) == _rows(share(False)) != []


def test_shares_multiply_no_rows_and_deal_no_id_again(spark):
    selections = distinct_flags(_forms(spark), COLUMNS, KEYS, ORDER).select(
        "*", F.lit("item").alias("item_type"), F.lit("same").alias("comparability"))
    plan = _plan(gold.technologies(Q.Q, selections))
    assert "Expand" not in plan
    dealt = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    # ids are counted where the forms were put together
    assert all(keys.startswith("entity_id") for keys in dealt if "entity_id" in keys)


def test_difference_counts_copies(spark):
    rng = random.Random(5)
    values = [(None, "a"), (1, None), (1, "a"), (2, "b")]
    a = spark.createDataFrame([rng.choice(values) for _ in range(200)], "`k.1` int, v string")
    b = spark.createDataFrame([rng.choice(values) for _ in range(150)], "`k.1` int, v string")
    expected = a.exceptAll(b).unionByName(b.exceptAll(a))
    assert _rows(quality.difference(a, b)) == _rows(expected) != []
    many = spark.range(150_000).select(F.lit(None).cast("int").alias("k.1"), F.lit("m").alias("v"))
    assert quality.difference(many, a.filter("false")).count() == 150_000  # more than are laid out at once


def test_second_dedupe_reads_and_deals_the_table_once(spark, monkeypatch):
    rows = [(f"p{i % 50}", "c", f"i{i % 3}", f"o{i % 4}", "t", "q", "y", 2000) for i in range(600)]
    names = "entity_id string, category string, item string, item_original string, item_type string, " \
            "question string, comparability string, wave int"
    table = spark.createDataFrame(rows, names)
    monkeypatch.setattr(Q, "stored_table", lambda *_: table)
    twice = dedupe(table, ["wave", "entity_id", "category", "item"], order=["item_original"])
    found = Q.dedupe_is_idempotent(spark, "any")
    plan = _plan(found)
    assert plan.count("Exchange") == 2 and len(set(
        line.split("hashpartitioning(")[1].split("REPARTITION")[0].count("#") for line in plan.splitlines()
        if "Exchange hashpartitioning(" in line)) == 1  # the same one in both branches
    assert _rows(found) == _rows(table.exceptAll(twice)) != []
