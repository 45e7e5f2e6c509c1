"""Files of a keyed table: what is skipped, packed and forgotten."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import ROW_ID
from tidemark.plans import keyed_table
from tidemark.plans.keyed_table import KeyedTable

CHANGES = f"{ROW_ID} string, V bigint, op string, scn bigint, pos bigint, seq int"
SCHEMA = T.StructType([T.StructField(ROW_ID, T.StringType()), T.StructField("V", T.LongType())])


def append(spark, table, rows, batch):
    table.append(spark.createDataFrame(rows, CHANGES), run="r", batch=batch)


def filled(spark, folder, batches=4, n=300, **how):
    """Every batch brings its own values; some rows go again."""
    table = KeyedTable(folder, SCHEMA, buckets=2, content_ids=True, **how)
    for b in range(batches):
        rows = [(f"k{v * 7919 % 100003}", v, "c", v, v, 0) for v in range(b * n, (b + 1) * n)]
        gone = [(f"k{v * 7919 % 100003}", None, "d", 10_000 + v, v, 0) for v in range(b * n, (b + 1) * n, 10)]
        append(spark, table, rows + gone, b)
    return table


def scanned(spark, df):
    """Rows and files that the scans of a query gave."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        metrics = [leaves.apply(i).metrics() for i in range(leaves.size())]
        value = lambda m, k: m.apply(k).value()
        return [(value(m, "numOutputRows"), value(m, "numFiles")) for m in metrics]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def files(spark, table):
    return {r[0] for r in table.changes(spark).select("_metadata.file_path").distinct().collect()}


def test_a_filter_skips_files_of_rows(spark, folder):
    table = filled(spark, folder)
    found = table.where(spark, F.col("V") == 601)
    assert [r.V for r in found.collect()] == [601]
    (rows, _), (gone, _) = scanned(spark, found)
    assert rows <= 300 and gone == 120  # of 1080 rows, those of one batch


def test_a_key_skips_by_bloom_filter(spark, folder):
    table = filled(spark, folder)
    key = f"k{601 * 7919 % 100003}"
    assert [r.V for r in table.by_key(spark, key).collect()] == [601]
    total = table.changes(spark).count()
    # Every file's ids span the whole range, so smallest and largest exclude none; Bloom filters do.
    assert sum(r for r, _ in scanned(spark, table.by_key(spark, key))) < total / 4


def test_ranges_plan_without_opening_files(spark, folder):
    table = filled(spark, folder, ranges=("V",))
    planned = table.planned_files(spark, "V", 650, 700)
    held = table.changes(spark).filter("V BETWEEN 650 AND 700").select("_metadata.file_path").distinct()
    assert {r.file_path for r in planned.collect()} == {r.file_path for r in held.collect()}
    assert all("/ranges/" in f for f in planned.inputFiles())
    assert table.planned_files(spark, "V", 5000, 6000).isEmpty()
    with pytest.raises(ValueError):
        table.planned_files(spark, "W", 1, 2)
    assert KeyedTable(f"{folder}/none", SCHEMA, ranges=("V",)).planned_files(spark, "V", 1, 2).isEmpty()


def test_first_fit():
    sizes = {"a": 6, "b": 5, "c": 4, "d": 3, "e": 1, "f": 9}
    bins = keyed_table._first_fit([(("row", 0), s, p) for p, s in sizes.items()] + [(("row", 1), 1, "g")], 10)
    assert bins == [["f", "e"], ["a", "c"], ["b", "d"], ["g"]]


def test_pack_replaces_small_files_only(spark, folder):
    table = filled(spark, folder, ranges=("V",))
    append(spark, table, [(f"big{i}", i, "c", i, i, 0) for i in range(20_000)], 9)
    want = sorted(map(tuple, table.current(spark).collect()))
    before = files(spark, table)
    sizes = {r[0]: r[1] for r in table.changes(spark).select("_metadata.file_path", "_metadata.file_size").distinct().collect()}
    limit = sorted(sizes.values())[-2]  # the two files of the large batch
    large = {f for f, s in sizes.items() if s >= limit}
    replaced = table.pack(spark, target_bytes=limit, writers=2)
    after = files(spark, table)
    assert large <= after and replaced == len(before - after) > 0
    assert len(large) == 2 and len(after - before) <= replaced // 2
    assert sorted(map(tuple, table.current(spark).collect())) == want
    assert {r.file_path for r in table.planned_files(spark, "V", 0, 9999).collect()} == {f for f in after if "/kind=row/" in f}
    # Replaced files are not read, and appends go on.
    assert sum(n for _, n in scanned(spark, table.changes(spark))) == len(after)
    append(spark, table, [("new", 5, "c", 99_999, 1, 0)], 50)
    assert table.current(spark).count() == len(want) + 1
    table.pack(spark, target_bytes=64 << 20)
    assert table.current(spark).count() == len(want) + 1
    assert len(files(spark, table)) <= 4
    assert table.pack(spark, target_bytes=64 << 20) == 0


def test_pack_is_no_news_for_streams(spark, folder):
    table = filled(spark, folder)
    def seen():
        q = table.stream(spark).select(ROW_ID, "scn").writeStream.format("parquet").option("path", f"{folder}-seen")
        q.option("checkpointLocation", f"{folder}-ck").trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(f"{ROW_ID} string, scn bigint").parquet(f"{folder}-seen").count()
    first = seen()
    assert table.pack(spark) > 0
    assert seen() == first == 4 * 300


def test_writers_are_bounded(spark, folder):
    table = filled(spark, folder)
    table.pack(spark, writers=1)
    packed = [f for f in files(spark, table) if f"/run={keyed_table.PACKED}" in f]
    # One task wrote all: the part number of every file is the same.
    assert len({f.rsplit("/part-", 1)[1][:5] for f in packed}) == 1


def test_retired_deletes(spark, folder):
    table = KeyedTable(folder, SCHEMA)
    append(spark, table, [("a", 1, "c", 1, 1, 0), ("b", 2, "c", 2, 2, 0)], 0)
    append(spark, table, [("a", None, "d", 5, 3, 0), ("b", None, "d", 9, 4, 0), ("c", 3, "c", 3, 5, 0)], 1)
    kept = table.rewrite(spark, f"{folder}-kept")
    assert kept.since(spark) is None and kept.changes(spark).count() == 3
    retired = table.rewrite(spark, f"{folder}-next", retire_before=8)
    assert sorted((r[ROW_ID], r.op) for r in retired.changes(spark).collect()) == [("b", "d"), ("c", "c")]
    with pytest.raises(Exception, match="deletes before 8 have retired, a change of 7 is too late"):
        append(spark, retired, [("a", 1, "c", 7, 1, 0)], 2)
    append(spark, retired, [("a", 4, "c", 8, 1, 0)], 3)
    again = retired.rewrite(spark, f"{folder}-third", retire_before=3)
    assert again.since(spark) == 8
    assert {r[ROW_ID] for r in again.current(spark).collect()} == {"a", "c"}
