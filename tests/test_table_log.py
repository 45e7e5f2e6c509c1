import pytest
from pyspark.sql import functions as F

from tidemark.model import ROW_ID
from tidemark.plans.table_log import TableLog
from tidemark.plans.tables import TablePlan
from tidemark.streaming import jobs

MESSAGES = "topic string, key string, value string, scn bigint, pos bigint, seq int"


def plan(columns=(("N", "DECIMAL(20,2)"), ("S", "STRING"), ("D", "DATE"))):
    return TablePlan("O", "T", "s", "t", "k", "ice", columns)


def target(table, at, op, key, image):
    images = f'"before":{image},"after":null' if op == "d" else f'"before":null,"after":{image}'
    value = f'{{"op":"{op}","schema":{{"owner":"O","table":"{table}"}},"row":1,"rid":null,{images},"sql":null}}'
    return (table, key, value, at, at, 0)


def sync(spark, folder, rows, n=1, **how):
    spark.createDataFrame(rows, MESSAGES).write.mode("append").parquet(f"{folder}/in")
    source = spark.readStream.schema(MESSAGES).parquet(f"{folder}/in")
    log = TableLog(f"{folder}/log", buckets=2)
    query = jobs.start_log_sync(source, log, f"{folder}/ck", run="r", **how)
    query.awaitTermination()
    return log, query


def test_tables_share_a_log_and_keep_digits(spark, folder):
    rows = [
        target("a", 1, "c", "k1", '{"N":12345678901234567.89,"S":"x\\"y","D":"2024-03-03 10:00:00"}'),
        target("a", 2, "c", "k2", '{"N":1.239,"S":null,"D":"no day"}'),
        target("a", 3, "d", "k1", "{}"), target("a", 4, "c", "k1", '{"N":7,"S":{"z":1,"y":[2]}}'),
        target("b", 1, "c", "k1", '{"N":"5.5","S":8}'), target("b", 2, "d", "k9", "{}"),
    ]
    log, _ = sync(spark, folder, rows)
    schema = plan().schema
    a = {r[ROW_ID]: (str(r.N), r.S, str(r.D)) for r in log.current(spark, "a", schema).collect()}
    assert a == {"k1": ("7.00", '{"y":[2],"z":1}', "None"), "k2": ("1.24", None, "None")}
    assert [tuple(map(str, r)) for r in log.current(spark, "b", schema).collect()] == [("k1", "5.50", "8", "None")]
    counted = {r[ROW_ID]: (r.bad_cells, r.lossy_cells) for r in log.changes(spark, "a", schema).collect()}
    assert counted == {"k1": (0, 0), "k2": (1, 1)}
    assert log.current(spark, "unknown", schema).isEmpty()


def test_replayed_and_late_batches_change_nothing(spark, folder):
    first, second = target("a", 5, "c", "k", '{"S":"new"}'), target("a", 4, "c", "k", '{"S":"old"}')
    sync(spark, folder, [first])
    log, _ = sync(spark, folder, [second, first])
    assert [r.S for r in log.current(spark, "a", plan().schema).collect()] == ["new"]


@pytest.mark.parametrize("on_bad", ["fail", "keep"])
def test_rejected(spark, folder, on_bad):
    rows = [target("a", 1, "c", None, '{"S":"x"}'), target("a", 2, "c", "k", f'{{"{ROW_ID}":"k"}}')]
    rows += [("a", "q", "no change", 3, 3, 0)] if on_bad == "keep" else []
    log, _ = sync(spark, folder, rows, on_bad=on_bad)
    assert log.current(spark, "a", plan().schema).count() == 1
    assert spark.read.parquet(f"{log.path}/rejected").count() == len(rows) - 1


def test_jobs_do_not_grow_with_tables(spark, folder):
    counts = []
    for n in (1, 12):
        rows = [target(f"t{i % n}", i, "c", f"k{i}", f'{{"N":{i}}}') for i in range(60)]
        log, query = sync(spark, f"{folder}/{n}", rows)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))))
        assert sum(log.current(spark, f"t{i}", plan().schema).count() for i in range(n)) == 60
    assert counts[0] == counts[1] > 0


def test_a_table_reads_its_own_files_only(spark, folder):
    log, _ = sync(spark, folder, [target(t, i, "c", f"k{i}", '{"N":1}') for t in "ab" for i in range(20)])
    scan = log.changes(spark, "a", plan().schema)
    assert "PartitionFilters: [isnotnull(table" in scan._jdf.queryExecution().executedPlan().toString()
    assert {f.split("/table=")[1][0] for f in scan.inputFiles()} <= {"a", "b"}
    assert scan.count() == 20


def test_a_change_without_its_order_stops_the_job(spark, folder):
    rows = [("a", "k", target("a", 1, "c", "k", "{}")[2], None, None, None)]
    with pytest.raises(Exception, match="does not keep the order"):
        sync(spark, folder, rows)
