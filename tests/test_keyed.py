import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import ROW_ID
from tidemark.operators import keyed, split, typed
from tidemark.plans.keyed_table import KeyedTable, bucket_of, write_layout
from tidemark.streaming import jobs

CHANGES = f"{ROW_ID} string, V bigint, op string, scn bigint, pos bigint, seq int"
SCHEMA = T.StructType([T.StructField(ROW_ID, T.StringType()), T.StructField("V", T.LongType())])


def random_changes(n, keys, seed=3):
    rng = random.Random(seed)
    # a third of all changes belong to one key
    pick = lambda: "hot" if rng.random() < 0.33 else f"k{rng.randrange(keys)}"
    return [(pick(), rng.randrange(9), rng.choice("ccd"), i // 3, i, 0) for i in range(n)]


def brute_force(rows):
    state = {}
    for key, value, op, scn, pos, seq in sorted(rows, key=lambda r: r[3:]):
        state[key] = value if op == "c" else None
    return {k: v for k, v in state.items() if v is not None}


def read(df):
    return {r[ROW_ID]: r.V for r in df.collect()}


@pytest.fixture
def rows():
    return random_changes(3000, 200)


def test_current_rows_against_brute_force_in_any_input_order(spark, rows):
    for seed in (1, 2):
        mixed = rows[:]
        random.Random(seed).shuffle(mixed)
        df = spark.createDataFrame(mixed, CHANGES).repartition(7)
        assert read(keyed.current_rows(df)) == brute_force(rows)


def test_rows_are_cut_before_the_shuffle(spark, rows):
    df = spark.createDataFrame(rows, CHANGES)
    plan = keyed.current_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_null_keys_are_dropped_and_counted(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], f"{ROW_ID} string, V bigint")
    seen = Observation("keys")
    assert [r.V for r in keyed.drop_null_keys(df, seen=seen).collect()] == [1]
    assert seen.get == {"rows": 3, "null_keys": 2}


def test_update_without_change(messages):
    c = '{"scn":1,"payload":{"op":"c","after":{"a":1}}}'
    u = '{"scn":2,"payload":{"op":"u","before":{"a":1},"after":{"a":1}}}'
    kept = keyed.current_rows(jobs.row_changes(messages(c, u)))
    gone = keyed.current_rows(jobs.row_changes(messages(c, u), split_order="create_first"))
    assert (kept.count(), gone.count()) == (1, 0)


def test_typed_cells(spark):
    df = spark.createDataFrame(
        [('{"D":"2024-03-03 10:00:00","N":"12.345","B":"aGk=","F":"x","T":"2024-03-03 10:00:01.5"}',)], "image string"
    )
    schema = T.StructType.fromDDL("D date, N decimal(4,1), B binary, F float, T timestamp_ntz, GONE int")
    r = typed.typed_rows(df, schema).collect()[0]
    assert (str(r.D), str(r.N), bytes(r.B), r.F, str(r.T), r.GONE) == (
        "2024-03-03", "12.3", b"hi", None, "2024-03-03 10:00:01.500000", None,
    )
    assert r.bad_cells == 1


def test_unselected_columns_are_not_parsed(spark):
    df = spark.createDataFrame([('{"A":"1","B":"2"}',)], "image string")
    out = typed.typed_rows(df, T.StructType.fromDDL("A int, B int")).select("A")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "StructField(A" in plan and "StructField(B" not in plan


def files(spark, path):
    return spark.read.parquet(path).select(F.input_file_name()).distinct().count()


def apply(spark, table, rows, batches, run="r"):
    for i in range(batches):
        part = [r for n, r in enumerate(rows) if n % batches == i]
        table.append(spark.createDataFrame(part, CHANGES), run=run, batch=i)


def test_keyed_table_lifecycle(spark, folder, rows):
    table = KeyedTable(folder, SCHEMA)
    assert table.current(spark).count() == 0
    want = brute_force(rows)
    apply(spark, table, rows, 4)
    assert read(table.current(spark)) == want

    # the same batches again, and once more under another run: nothing changes
    apply(spark, table, rows, 2 * 2)
    assert read(table.current(spark)) == want
    apply(spark, table, rows, 4, run="replay")
    assert read(table.current(spark)) == want

    before = files(spark, f"{folder}/log")
    new = table.rewrite(spark, f"{folder} new")  # a blank in the path
    assert read(new.current(spark)) == read(table.current(spark)) == want
    assert files(spark, f"{new.path}/log") < before == files(spark, f"{folder}/log")
    assert new.changes(spark).count() == len({r[0] for r in rows})  # one change per key, deletes kept
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        table.rewrite(spark, new.path)
    assert read(new.rewrite(spark, f"{folder}-again").current(spark)) == want
    assert new.files_with(spark, F.col("V") >= 0).count() > 0
    table = new

    # an older insert that arrives late does not bring a deleted row back
    gone = next(k for k in {r[0] for r in rows} if k not in want)
    table.append(spark.createDataFrame([(gone, 1, "c", -1, -1, 0)], CHANGES), run="late", batch=0)
    assert read(table.current(spark)) == want


def test_saved_rows_are_grouped_without_a_shuffle(spark, folder, rows):
    table = KeyedTable(folder, SCHEMA)
    apply(spark, table, rows, 2)
    name = "saved_" + folder.rsplit("-", 1)[1]
    saved = table.save_current(spark, name)
    assert read(saved) == brute_force(rows)
    counted = saved.groupBy(ROW_ID).agg(F.count("*").alias("n"))
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"DROP TABLE {name}")


def test_rewriting_some_buckets_copies_the_others(spark, folder, rows):
    table = KeyedTable(f"{folder}/t", SCHEMA)
    apply(spark, table, rows, 2)
    new = table.rewrite(spark, f"{folder}/new", buckets=[1, 2])
    assert read(new.current(spark)) == brute_force(rows)
    count = lambda t, where: t.changes(spark).filter(where).count()
    assert count(new, "bucket not in (1, 2)") == count(table, "bucket not in (1, 2)")
    assert count(new, "bucket in (1, 2)") == len({r[0] for r in table.changes(spark).filter("bucket in (1, 2)").select(ROW_ID).collect()})


def test_filtered_reads(spark, folder):
    # content decides the key here, as it does for hashed rows
    rows = [(f"k{v % 50}", v % 50, "d" if v % 7 == 0 else "c", v, v, 0) for v in range(400)]
    table = KeyedTable(folder, SCHEMA, content_ids=True)
    apply(spark, table, rows, 2)
    want = brute_force(rows)
    found = table.where(spark, F.col("V") == 23)
    assert read(found) == {k: v for k, v in want.items() if v == 23}
    assert read(table.by_key(spark, "k24")) == {k: v for k, v in want.items() if k == "k24"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    plan = plan.replace(" ", "")
    assert "EqualTo(V,23)" in plan and "Or(EqualTo(V,23)" not in plan
    assert "kind#" in plan and "=gone" in plan and "=row" in plan
    by_key = table.by_key(spark, "k24")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(AUTO_MD5_ID,k24)" in by_key
    # a reader may think of another number of buckets
    assert read(KeyedTable(folder, SCHEMA, buckets=5).by_key(spark, "k24")) == read(table.by_key(spark, "k24"))


def test_filter_on_an_older_version(spark, folder):
    table = KeyedTable(folder, SCHEMA)
    apply(spark, table, [("a", 1, "c", 1, 1, 0), ("a", 2, "c", 2, 2, 0)], 2)
    assert read(table.where(spark, F.col("V") == 1)) == {}
    assert read(table.where(spark, F.col("V") == 2)) == {"a": 2}


def test_listed_files_are_those_that_hold_rows(spark, folder, rows):
    table = KeyedTable(folder, SCHEMA)
    apply(spark, table, rows, 3)
    wanted = (F.col("V") == 4) & (F.col("op") == "c")
    held = table.changes(spark).select("V", "op", F.input_file_name().alias("f")).collect()
    listed = {r.file_path for r in table.files_with(spark, wanted).collect()}
    name = lambda f: f.rsplit("/log/", 1)[1]
    assert {name(f) for f in listed} == {name(r.f) for r in held if r.V == 4 and r.op == "c"}


def test_one_file_per_shuffle_partition_and_bucket(spark, folder, rows):
    table = KeyedTable(folder, SCHEMA, buckets=4)
    apply(spark, table, rows, 1)
    assert files(spark, f"{folder}/log") <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    wrong = table.changes(spark).filter(F.col("bucket") != bucket_of(F.col(ROW_ID), 4))
    assert wrong.count() == 0


def test_layout_is_sorted_inside_files(spark, folder):
    df = spark.createDataFrame([(i if i % 10 else None, i) for i in range(1000, 0, -1)], "id int, v int")
    write_layout(df, folder, "id", buckets=5)
    stored = spark.read.parquet(folder)
    assert stored.count() == 1000 and stored.select("bucket").distinct().count() <= 5
    one = [r.id for r in stored.filter("bucket = 1").select("id").coalesce(1).collect()]
    values = [x for x in one if x is not None]
    assert values == sorted(values)


def test_decode_refuses_incomplete_messages(messages):
    bad = messages('{"op":"u","after":{"a":1}}', '{"op":"x"}', "nonsense")
    with pytest.raises(Exception, match="not a row change"):
        split.decode_changelog(bad).collect()
    assert split.decode_changelog(bad, on_bad="skip").count() == 0


def test_decode_of_all_operations(messages):
    df = messages('{"op":"r","after":{"a":1}}', '{"op":"u","before":{"a":1},"after":{"a":2}}', '{"op":"d","before":{"a":2}}')
    rows = split.decode_changelog(df).orderBy("pos", "seq").collect()
    assert [(r.pos, r.kind, r.image) for r in rows] == [
        (0, "+I", '{"a":1}'), (1, "-U", '{"a":1}'), (1, "+U", '{"a":2}'), (2, "-D", '{"a":2}'),
    ]
