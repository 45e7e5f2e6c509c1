from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import statistics
from tidemark.streaming.counters import BatchCounts

START = datetime(2024, 3, 3, 10)
ROWS = "ts timestamp, tag string, who string, x double"


def made(spark, rows):
    return spark.createDataFrame([(START + timedelta(minutes=m), *r) for m, *r in rows], ROWS)


def stats(df, **how):
    who = F.col("who")
    return statistics.tag_statistics(df, "ts", F.col("tag"), distinct=who, number=F.col("x"), frequent=who, **how)


def told(df):
    found = statistics.estimates(df, quantiles={"median": 0.5}, top=2).collect()
    return {(r.window_start, r.tag): (r.messages, r.distinct_values, r.median, [(t.item, t["count"]) for t in r.top]) for r in found}


def test_small_windows_are_exact_and_merge(spark):
    rows = [(1, "a", "u", 1.0), (2, "a", "u", 2.0), (9, "a", "v", 9.0), (11, "a", "v", 3.0), (30, "b", "w", None), (31, "b", None, None), (59, "a", "v", 4.0)]
    tens = stats(made(spark, rows))
    assert told(tens)[(START, "a")] == (3, 2, 2.0, [("u", 2), ("v", 1)])
    assert told(tens)[(START + timedelta(minutes=30), "b")][:3] == (2, 1, None)
    hour = told(statistics.merged(tens, "1 hour"))
    assert hour[(START, "a")] == (5, 2, 3.0, [("v", 3), ("u", 2)])
    assert told(tens.limit(0)) == {}


def test_errors_are_as_stated(spark):
    n = 60_000
    df = spark.range(n).select(
        (F.lit(START).cast("timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, id % 60, 0)")).alias("ts"), F.lit("a").alias("tag"),
        (F.col("id") % 20_000).cast("string").alias("who"), F.pmod(F.xxhash64("id"), F.lit(10_000)).cast("double").alias("x"),
    )
    row = statistics.estimates(statistics.merged(stats(df), "1 hour"), quantiles={"q": 0.9}).first()
    assert row.messages == n and abs(row.distinct_values - 20_000) <= statistics.DISTINCT_ERROR * 20_000
    rank = df.filter(F.col("x") <= row.q).count() / n
    assert abs(rank - 0.9) <= statistics.RANK_ERROR + 1e-3


def test_partly_made_before_the_shuffle(spark):
    plan = stats(made(spark, [(1, "a", "u", 1.0)]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_hll_sketch_agg" in plan and plan.count("Exchange hashpartitioning") == 1


def test_stream_updates_windows_and_counts_late_rows(spark, folder):
    batches = [[(1, "a", "u", 1.0), (45, "a", "u", 5.0)], [(2, "a", "late", 7.0), (46, "a", "v", 6.0)], [(47, "b", "w", 1.0), (44, "a", "u", 5.0)]]
    listener = BatchCounts(spark, f"{folder}/counts").attach()
    try:
        for rows in batches:
            made(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")
            source = spark.readStream.schema(ROWS).parquet(f"{folder}/in")
            query = statistics.start_tag_statistics(stats(source), f"{folder}/out", f"{folder}/ck")
            query.awaitTermination()
            listener.settle(query)
    finally:
        listener.detach()
    now = told(statistics.latest(spark.read.parquet(f"{folder}/out")))
    ten = lambda m: START + timedelta(minutes=m)
    assert {k: v[:2] for k, v in now.items()} == {(ten(0), "a"): (1, 1), (ten(40), "a"): (3, 2), (ten(40), "b"): (1, 1)}
    late = listener.counts().filter("of = 'state'").agg(F.sum("n")).first()[0]
    assert late == 1


@pytest.mark.parametrize("width", ["20 minutes", "1 day"])
def test_merging_in_steps_is_merging_at_once(spark, width):
    rows = [(m, "ab"[m % 2], f"u{m % 17}", float(m * 7 % 31)) for m in range(0, 600, 3)]
    tens = stats(made(spark, rows))
    at_once = told(statistics.merged(tens, width))
    in_steps = told(statistics.merged(statistics.merged(tens, "20 minutes"), width))
    assert {k: (v[:2], v[3]) for k, v in at_once.items()} == {k: (v[:2], v[3]) for k, v in in_steps.items()}
