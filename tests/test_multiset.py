import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import ROW_ID
from tidemark.operators import keyed
from tidemark.operators.keyed import COPIES
from tidemark.plans.multiset_table import MultisetTable

CHANGES = f"{ROW_ID} string, V bigint, W string, op string, scn bigint, pos bigint, seq int"
SCHEMA = T.StructType().add(ROW_ID, "string").add("V", "long").add("W", "string")


def random_changes(n, seed=1):
    """Changes of rows whose content follows from the id; a third belong to one id."""
    rng, out = random.Random(seed), []
    for i in range(n):
        k = 0 if rng.random() < 0.33 else rng.randrange(60)
        op = rng.choice("ccd")
        out.append((f"k{k}", k if op == "c" else None, f"w{k}" if op == "c" else None, op, i, i, 0))
    return out


def by_hand(rows):
    counts = Counter()
    for key, _, _, op, *_ in set(rows):
        counts[key] += 1 if op == "c" else -1
    return +counts


def read(df):
    return Counter(r[ROW_ID] for r in df.collect())


def test_counts_do_not_depend_on_order_or_batches(spark, folder):
    rows = random_changes(2000)
    want = by_hand(rows)
    df = spark.createDataFrame(rows, CHANGES)
    assert read(keyed.current_multiset(df, ["V", "W"])) == want
    random.Random(5).shuffle(rows)
    table = MultisetTable(f"{folder}/t", SCHEMA, buckets=3)
    for i in range(5):
        table.append(spark.createDataFrame(rows[i::5], CHANGES), run="r", batch=i)
    table.append(spark.createDataFrame(rows[0::5], CHANGES), run="r", batch=0)  # replayed
    assert read(table.current(spark)) == want
    assert {(r.V, r.W) for r in table.current(spark).collect()} == {(int(k[1:]), f"w{k[1:]}") for k in want}
    merged = table.rewrite(spark, f"{folder}/merged")
    assert read(merged.current(spark)) == want
    assert merged.counts(spark).filter(f"{COPIES} = 0").isEmpty()


def test_a_delete_before_its_insert_is_a_debt(spark, folder):
    table = MultisetTable(f"{folder}/t", SCHEMA)
    table.append(spark.createDataFrame([("a", None, None, "d", 9, 9, 0)], CHANGES), run="r", batch=0)
    assert table.current(spark).isEmpty()
    table = table.rewrite(spark, f"{folder}/next")
    inserts = [("a", 1, "x", "c", 1, 1, 0), ("a", 1, "x", "c", 2, 2, 0)]
    table.append(spark.createDataFrame(inserts, CHANGES), run="r", batch=1)
    assert [tuple(r) for r in table.current(spark).collect()] == [("a", 1, "x")]


def test_a_change_that_is_there_twice_counts_once(spark):
    twice = [("a", 1, "x", "c", 1, 1, 0), ("a", 1, "x", "c", 1, 1, 0), ("a", 1, "x", "c", 1, 2, 0)]
    assert read(keyed.current_multiset(spark.createDataFrame(twice, CHANGES), ["V", "W"])) == {"a": 2}


def test_rows_of_nulls_and_empty_tables(spark, folder):
    table = MultisetTable(f"{folder}/t", SCHEMA)
    assert table.current(spark).isEmpty()
    table.append(spark.createDataFrame([("a", None, None, "c", 1, 1, 0)], CHANGES), run="r", batch=0)
    assert [tuple(r) for r in table.current(spark).collect()] == [("a", None, None)]
    table.append(spark.createDataFrame([], CHANGES), run="r", batch=1)
    assert table.current(spark).count() == 1


@pytest.mark.parametrize("n", [0, 1, 3, 7, 8])
def test_shares(spark, monkeypatch, n):
    monkeypatch.setattr(keyed, "COPIES_PER_TASK", 3)
    df = spark.createDataFrame([("a", n), ("b", -2), ("c", 1)], "k string, copies bigint")
    got = Counter(r.k for r in keyed.copies_as_rows(df, "copies").collect())
    assert got == +Counter({"a": n, "c": 1})


def test_hot_id_is_summed_before_the_shuffle(spark):
    df = spark.createDataFrame(random_changes(100), CHANGES).drop_duplicates([ROW_ID]).withColumn("op", F.lit("c"))
    plan = keyed.current_multiset(df, ["V"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_changes_are_sorted_once_before_they_are_summed(spark):
    """And a row's columns are taken as one, however many there are."""
    df = spark.createDataFrame(random_changes(10), CHANGES)
    plan = keyed.signed_counts(df, ["V", "W"])._jdf.queryExecution().executedPlan().toString()
    assert sum("Sort [" in line for line in plan.splitlines()) == 2
    assert "first(V" not in plan and "first(W" not in plan
