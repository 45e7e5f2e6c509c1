"""What a task or a batch holds does not grow with the input."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark.functions import typemap
from tidemark.operators import typed
from tidemark.session import small_arrow_batches, unsorted_folders
from tidemark.sources import messages as msg
from tidemark.streaming import jobs
from workload import feeds, queries

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


def orders(spark, folder, n):
    row = "id, id, 'F', 1.5D, timestamp'1995-05-05', '2-HIGH'"
    spark.range(n).selectExpr(*[f"{e.strip()} as {c.split()[0]}" for e, c in zip(row.split(", "), ORDERS.split(", "), strict=True)]).write.parquet(f"{folder}/orders.parquet")


def test_larger_feeds_have_more_partitions(spark, folder, monkeypatch):
    monkeypatch.setattr(feeds, "ROWS_PER_PARTITION", 10)
    orders(spark, folder, 205)
    assert feeds.orders(spark, folder).rdd.getNumPartitions() == 21


@pytest.mark.parametrize("fmt", ["parquet", "lines"])
def test_tables_are_the_same_in_many_batches(spark, folder, monkeypatch, fmt):
    orders(spark, folder, 40)
    monkeypatch.setattr(msg, "BATCH_BYTES", dict.fromkeys(msg.BATCH_BYTES, 1))
    monkeypatch.setattr(queries, "work_dir", lambda _spark, purpose: f"{folder}/{purpose}")
    plan = queries._plan("ORDERS", queries.ORDERS_SCHEMA)
    queries._publish(feeds.orders(spark, folder), plan.source_topic, f"{folder}/w/source")
    queries._sync(spark, f"{folder}/w", [plan], fmt)
    rows = queries.KeyedTable(f"{folder}/w/tables/{plan.keyed_table}", plan.schema)
    assert rows.changes(spark).select("batch").distinct().count() > 1
    assert [r.O_ORDERSTATUS for r in rows.current(spark).collect()] == ["X"] * 40


def test_messages_are_not_sorted_by_topic(spark, folder, monkeypatch):
    """More topics than writers too, and the session's setting is as before."""
    df = spark.range(0, 300, 1, 1).select(
        F.concat(F.lit("t"), F.col("id") % 3).alias("topic"), F.lit(None).cast("string").alias("key"), F.lit("v").alias("value"),
        F.col("id").alias("scn"), F.col("id").alias("pos"), F.lit(0).alias("seq"),
    )
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, "0")
    set_to, save = [], DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda *a, **k: (set_to.append(int(spark.conf.get(name, "0"))), save(*a, **k)))
    msg.write_messages(df, "parquet", path=f"{folder}/few")
    assert set_to and min(set_to) > 0
    with unsorted_folders(spark, 2):
        df.write.partitionBy("topic").parquet(f"{folder}/many")
    assert spark.conf.get(name, "0") == before
    for place in ("few", "many"):
        assert spark.read.parquet(f"{folder}/{place}").select("topic").distinct().count() == 3
        assert spark.read.parquet(f"{folder}/{place}").count() == 300


def test_good_messages_are_held_without_their_text(spark, folder, monkeypatch):
    seen = []
    write = msg.write_messages
    monkeypatch.setattr(jobs.msg, "write_messages", lambda df, *a, **k: (seen.append(df.count()), write(df, *a, **k)))
    good = '{"scn":1,"payload":{"op":"c","schema":{"owner":"A","table":"B"},"after":{"a":1}}}'
    rows = [("t", None, v, None, i, None) for i, v in enumerate([good, "{"])]
    spark.createDataFrame(rows, "topic string, key string, value string, scn bigint, pos bigint, seq int").write.partitionBy("topic").parquet(f"{folder}/in")
    jobs.start_normaliser(msg.read_messages(spark, "parquet", path=f"{folder}/in"), "parquet", f"{folder}/ck", path=f"{folder}/out", quarantine=f"{folder}/bad").awaitTermination()
    bad = spark.read.parquet(f"{folder}/bad").collect()
    assert seen == [1] and [(r.value, r.reason) for r in bad] == [("{", "bad_json")]


def test_scored_texts_go_to_python_in_small_batches(spark, folder, monkeypatch):
    spark.range(0, 1300, 1, 1).selectExpr("id as doc_id", "'t' as text", "'en' as lang").write.parquet(f"{folder}/documents.parquet")
    monkeypatch.setattr(queries, "work_dir", lambda _spark, purpose: f"{folder}/{purpose}")
    monkeypatch.setattr(queries, "length_scorer", lambda: lambda requests: [(200, str(len(requests)))] * len(requests))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    sizes = {int(r.value) for r in queries.score_stream(spark, folder).collect()}
    assert sum(sizes) and max(sizes) <= 500 and spark.conf.get(name) == before
    with small_arrow_batches(spark, 20_000):
        assert spark.conf.get(name) == before


def test_common_numbers_are_checked_without_patterns(spark, monkeypatch):
    numbers = [("1",), ("1.5",), ("-173665.47",), ("123456789012",), (None,)]
    df = spark.createDataFrame(numbers, "t string")
    stop = F.raise_error(F.lit("a pattern")).cast("string")
    for name in ("regexp_extract", "regexp_replace"):
        monkeypatch.setattr(F, name, lambda *a: stop)
    rows = df.select(typemap.is_cut(F.col("t"), 2).alias("cut"), typed._many_digits(F.col("t")).alias("many"))
    assert [(r.cut, r.many) for r in rows.collect() if r.cut is not None] == [(False, False)] * 5


def test_the_last_round_of_tasks_is_short(spark, folder):
    spark.range(1_000_000).selectExpr("id as s_suppkey", "'n' as s_name").write.parquet(f"{folder}/supplier.parquet")
    assert feeds.supplier(spark, folder).rdd.getNumPartitions() == 10


def test_counted_batches_use_all_cores(spark, folder, monkeypatch):
    monkeypatch.setattr(feeds, "ROWS_PER_PARTITION", 10)
    orders(spark, folder, 480)
    asked, read = [], msg.read_messages
    monkeypatch.setattr(msg, "read_messages", lambda *a, **k: (asked.append(k["options"]), read(*a, **k))[1])
    counted = {r.metric: r.n for r in queries.stream_counters(spark, folder).collect()}
    assert asked == [{"maxFilesPerTrigger": "8"}] and counted["read"] == 960


LINES = [
    (1, 10, 7, 1, 17.0, 12345678.9, 0.04, 0.02, "R", "F", "1996-03-13"),
    (1, 11, 8, 2, None, 1.1, None, 0.05, "A", 'O"\\', None),
    (2, 12, 9, 1, 3.0, 2.0, 0.1, 0.03, None, "@", "1997-01-28"),
]
LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate string"
)


@pytest.mark.parametrize("feed", [feeds.lineitem, feeds.lineitem_twice])
def test_a_line_is_written_as_text_once_for_all_its_messages(spark, folder, feed):
    df = spark.createDataFrame(LINES, LINEITEM)
    df.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")).write.parquet(f"{folder}/lineitem.parquet")
    messages = feed(spark, folder)
    df = feeds.table(spark, folder, "lineitem")
    day = {"l_shipdate": feeds._day_text("l_shipdate")}
    row, closed = feeds.row_image(df, **day), feeds.row_image(df, **day, l_linestatus=F.lit("X"))
    first = 3 if feed is feeds.lineitem_twice else 1
    want = set()
    for flag, op, step, images in (("R", "u", 1, {"before": row, "after": closed}), ("A", "d", 2, {"before": row})):
        message = feeds.envelope(op, feeds.OWNER, "LINEITEM", F.lit(first + step).cast("bigint"), **images)
        want |= {r.m for r in df.filter(F.col("l_returnflag") == flag).select(message.alias("m")).collect()}
    for step in range(1, first + 1):
        message = feeds.envelope("c", feeds.OWNER, "LINEITEM", F.lit(step).cast("bigint"), after=row)
        loaded = df.filter(F.round(F.col("l_tax") * 100) % 3 >= step - 1)
        want |= {r.m for r in loaded.select(message.alias("m")).collect()}
    assert {r.value for r in messages.collect()} == want
    plan = messages._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJsonEvaluator") + plan.count("to_json") == 2
