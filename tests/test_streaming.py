import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import ROW_ID
from tidemark.operators import keyed
from tidemark.plans.keyed_table import KeyedTable
from tidemark.plans.tables import TablePlan
from tidemark.sources import messages as msg
from tidemark.sources.envelopes import full_load
from tidemark.streaming import jobs


def image(k, v):
    return '{"K":%d,"V":"%s"}' % (k, v)


def insert(table, k, v, scn):
    return '{"scn":%d,"payload":{"op":"c","schema":{"owner":"O","table":"%s"},"after":%s}}' % (scn, table, image(k, v))


def update(table, k, old, new, scn):
    return '{"scn":%d,"payload":{"op":"u","schema":{"owner":"O","table":"%s"},"before":%s,"after":%s}}' % (
        scn, table, image(k, old), image(k, new),
    )


def plan(name):
    low = f"db-o-{name.lower()}"
    return TablePlan(
        "O", name, low, f"target-{low}", f"kafka_db_o_{name}", f"ice_db_o_{name}", (("K", "INT"), ("V", "STRING"))
    )


def publish(spark, path, topic, values, start=0):
    rows = [(topic, None, v, None, start + i, None) for i, v in enumerate(values)]
    msg.write_messages(spark.createDataFrame(rows, "topic string, key string, value string, scn bigint, pos bigint, seq int"), "parquet", path=path)


def run_jobs(spark, root, plans, tag=""):
    source = msg.read_messages(spark, "parquet", path=f"{root}/source", options={"maxFilesPerTrigger": "1"})
    jobs.start_normaliser(source, "parquet", f"{root}/ckA{tag}", path=f"{root}/target{tag}", quarantine=f"{root}/bad{tag}").awaitTermination()
    target = msg.read_messages(spark, "parquet", path=f"{root}/target{tag}", options={"maxFilesPerTrigger": "2"})
    jobs.start_table_sync(target, plans, f"{root}/tables", f"{root}/ckB{tag}", run=f"run{tag}").awaitTermination()


def current(spark, root, p):
    rows = KeyedTable(f"{root}/tables/{p.keyed_table}", p.schema).current(spark)
    return sorted((r.K, r.V) for r in rows.collect())


def test_two_tables_in_one_stream_then_restart_then_replay(spark, folder):
    a, b = plan("A"), plan("B")
    publish(spark, f"{folder}/source", a.source_topic, [insert("A", k, "x", k) for k in range(40)] + ["broken", ""])
    publish(spark, f"{folder}/source", b.source_topic, [insert("B", k, "y", k) for k in range(10)])
    run_jobs(spark, folder, [a, b])
    assert current(spark, folder, a) == [(k, "x") for k in range(40)]
    assert current(spark, folder, b) == [(k, "y") for k in range(10)]

    # more messages, same checkpoints
    publish(spark, f"{folder}/source", a.source_topic, [update("A", k, "x", "z", 100 + k) for k in range(5)], 100)
    run_jobs(spark, folder, [a, b])
    want = [(k, "z" if k < 5 else "x") for k in range(40)]
    assert current(spark, folder, a) == want

    # everything again with new checkpoints
    run_jobs(spark, folder, [a, b], tag="2")
    assert current(spark, folder, a) == want

    # and the same as in one batch
    batch = jobs.row_changes(msg.read_messages(spark, "parquet", path=f"{folder}/source", streaming=False, topics=[a.source_topic]))
    ids = {r[ROW_ID] for r in keyed.current_rows(batch).collect()}
    table = KeyedTable(f"{folder}/tables/{a.keyed_table}", a.schema)
    assert ids == {r[ROW_ID] for r in table.current(spark).collect()}


def test_topic_list_limits_the_normaliser(spark, folder):
    publish(spark, f"{folder}/source", "db-o-a", [insert("A", 1, "x", 1)])
    publish(spark, f"{folder}/source", "db-o-b", [insert("B", 1, "x", 1)])
    source = msg.read_messages(spark, "parquet", path=f"{folder}/source")
    jobs.start_normaliser(source, "parquet", f"{folder}/ck", path=f"{folder}/target", topics=["db-o-b"], on_bad="fail").awaitTermination()
    out = msg.read_messages(spark, "parquet", path=f"{folder}/target", streaming=False)
    assert [r.topic for r in out.collect()] == ["target-db-o-b"]


def test_rows_without_a_key_do_not_reach_the_table(spark, folder):
    a = plan("A")
    publish(spark, f"{folder}/source", a.source_topic, ["broken", insert("A", 1, "x", 1)])
    source = msg.read_messages(spark, "parquet", path=f"{folder}/source")
    jobs.start_normaliser(source, "parquet", f"{folder}/ckA", path=f"{folder}/target", on_bad="dummy").awaitTermination()
    assert msg.read_messages(spark, "parquet", path=f"{folder}/target", streaming=False).count() == 2
    target = msg.read_messages(spark, "parquet", path=f"{folder}/target")
    jobs.start_table_sync(target, [a], f"{folder}/tables", f"{folder}/ckB", run="r").awaitTermination()
    assert current(spark, folder, a) == [(1, "x")]
    kept = spark.read.parquet(f"{folder}/tables/rejected").collect()
    assert [(r.key, r.image) for r in kept] == [(None, '{"C1":1}')]


def test_bad_messages_are_stored_by_the_normaliser(spark, folder):
    publish(spark, f"{folder}/source", "t", ["broken", insert("A", 1, "x", 1), ""])
    source = msg.read_messages(spark, "parquet", path=f"{folder}/source")
    with pytest.raises(ValueError, match="folder"):
        jobs.start_normaliser(source, "parquet", f"{folder}/ck0", path=f"{folder}/target")
    jobs.start_normaliser(source, "parquet", f"{folder}/ck", path=f"{folder}/target", quarantine=f"{folder}/bad").awaitTermination()
    bad = spark.read.parquet(f"{folder}/bad").collect()
    assert sorted((r.value, r.reason) for r in bad) == [("", "empty"), ("broken", "bad_json")]
    assert msg.read_messages(spark, "parquet", path=f"{folder}/target", streaming=False).count() == 1


def test_unread_target_messages_are_kept(spark, folder):
    a = plan("A")
    publish(spark, f"{folder}/target", a.target_topic, ["nonsense"])
    target = msg.read_messages(spark, "parquet", path=f"{folder}/target")
    jobs.start_table_sync(target, [a], f"{folder}/tables", f"{folder}/ck", run="r", on_bad="keep").awaitTermination()
    assert [r.image for r in spark.read.parquet(f"{folder}/tables/rejected").collect()] == ["nonsense"]


def again(spark, folder, fmt):
    """Insert, delete, insert of the same rows, through both jobs."""
    a = plan("A")
    delete = '{"scn":%d,"payload":{"op":"d","schema":{"owner":"O","table":"A"},"before":%s}}'
    values = [insert("A", k, "x", 1) for k in range(40)]
    values += [delete % (2, image(k, "x")) for k in range(40)] + [insert("A", k, "x", 3) for k in range(20)]
    publish(spark, f"{folder}/source", a.source_topic, values)
    source = msg.read_messages(spark, "parquet", path=f"{folder}/source")
    jobs.start_normaliser(source, fmt, f"{folder}/ckA", path=f"{folder}/target", quarantine=f"{folder}/bad").awaitTermination()
    target = msg.read_messages(spark, fmt, path=f"{folder}/target")
    jobs.start_table_sync(target, [a], f"{folder}/tables", f"{folder}/ckB", run="r").awaitTermination()
    return current(spark, folder, a)


def test_lines_carry_the_order(spark, folder):
    assert again(spark, folder, "lines") == [(k, "x") for k in range(20)]


def test_a_source_without_order_is_refused(spark, folder):
    with pytest.raises(Exception, match="does not keep the order"):
        again(spark, folder, "text")


def test_topics_limit_every_source(spark, folder):
    rows = [(t, "k", "v\\t", 1, 2, 0) for t in ("a", "b")]
    df = spark.createDataFrame(rows, "topic string, key string, value string, scn bigint, pos bigint, seq int")
    for fmt in ("parquet", "lines", "text"):
        msg.write_messages(df, fmt, path=f"{folder}/{fmt}")
        got = msg.read_messages(spark, fmt, path=f"{folder}/{fmt}", streaming=False, topics=["a"]).collect()
        assert [r.topic for r in got] == ["a"]
        if fmt != "text":
            assert tuple(got[0]) == rows[0]


def test_quarantine_and_relay(spark, folder):
    publish(spark, f"{folder}/source", "t", ["broken", insert("A", 1, "x", 1)])
    source = lambda: msg.read_messages(spark, "parquet", path=f"{folder}/source")
    jobs.start_quarantine(source(), f"{folder}/bad", f"{folder}/ck1").awaitTermination()
    assert [(r.value, r.reason) for r in spark.read.parquet(f"{folder}/bad").collect()] == [("broken", "bad_json")]
    jobs.start_relay(source(), "copy", "parquet", f"{folder}/ck2", path=f"{folder}/copy").awaitTermination()
    copied = msg.read_messages(spark, "parquet", path=f"{folder}/copy", streaming=False).collect()
    assert {(r.topic, r.value) for r in copied} == {("copy", "broken"), ("copy", insert("A", 1, "x", 1))}


def test_table_can_be_followed(spark, folder):
    schema = T.StructType([T.StructField(ROW_ID, T.StringType()), T.StructField("V", T.LongType())])
    table = KeyedTable(f"{folder}/t", schema)
    changes = f"{ROW_ID} string, V bigint, op string, scn bigint, pos bigint, seq int"

    def follow():
        q = table.stream(spark).select(ROW_ID, "op").writeStream.format("parquet").option("path", f"{folder}/seen")
        q.option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start().awaitTermination()
        return sorted((r[0], r[1]) for r in spark.read.parquet(f"{folder}/seen").collect())

    table.append(spark.createDataFrame([("a", 1, "c", 1, 1, 0)], changes), run="r", batch=0)
    assert follow() == [("a", "c")]
    table.append(spark.createDataFrame([("a", 1, "d", 2, 2, 0), ("b", 2, "c", 2, 2, 0)], changes), run="r", batch=1)
    assert follow() == [("a", "c"), ("a", "d"), ("b", "c")]


def test_text_topics(spark, folder):
    df = spark.createDataFrame([("t", "k", "one", 1, 1, 0), ("t", None, "two", 1, 1, 0)], "topic string, key string, value string, scn bigint, pos bigint, seq int")
    msg.write_messages(df, "text", path=folder)
    rows = msg.read_messages(spark, "text", path=folder, streaming=False).collect()
    assert {(r.topic, r.key, r.value, r.pos) for r in rows} == {("t", None, "one", None), ("t", None, "two", None)}


def test_broker_options_and_headers(spark):
    options = msg.kafka_options("host:9092", ["a", "b"], extra={"kafka.security.protocol": "SASL_PLAINTEXT"})
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == "latest"
    assert options["kafka.security.protocol"] == "SASL_PLAINTEXT"
    assert "subscribe" not in msg.kafka_options("host:9092")
    sent = msg._for_kafka(
        spark.createDataFrame([("t", "k", "v", 7, 8, 1)], "topic string, key string, value string, scn bigint, pos bigint, seq int")
    )
    received = sent.withColumns({"offset": F.lit(99).cast("bigint"), "value": F.col("value").cast("binary")})
    row = msg._from_kafka(received).collect()[0]
    assert tuple(row) == ("t", "k", "v", 7, 8, 1)
    plain = msg._from_kafka(received.drop("headers")).collect()[0]
    assert tuple(plain) == ("t", "k", "v", None, 99, None)


def test_full_load_of_a_table(spark):
    table = spark.range(50).select("id", F.concat(F.lit("n"), "id").alias("name"))
    loaded = full_load(table, "O", "T", F.col("id"), F.col("id"))
    now = keyed.current_rows(jobs.row_changes(loaded))
    names = {r.n for r in now.select(F.get_json_object("after", "$.NAME").alias("n")).collect()}
    assert names == {f"n{i}" for i in range(50)}


def test_rows_can_be_printed(spark, capsys):
    msg.print_rows(spark.range(50).select(F.concat(F.lit("a" * 40), "id").alias("v")))
    assert capsys.readouterr().out.split() == ["v", *("a" * 40 + str(i) for i in range(50))]
