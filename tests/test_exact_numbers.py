import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import typemap
from tidemark.model import ROW_ID
from tidemark.operators import envelope, identity, split, typed
from tidemark.streaming import jobs

DIGITS_38 = "12345678901234567890123456789012345678"


def change(image, op="c", before=None):
    parts = [f'"{k}":{v}' for k, v in (("before", before), ("after", image)) if v]
    return f'{{"scn":1,"payload":{{"op":"{op}","schema":{{"owner":"O","table":"T"}},{",".join(parts)}}}}}'


def typed_of(messages, *values, ddl="A decimal(20,2)", exact=True):
    topic = messages(*values).withColumn("topic", F.lit("t"))
    decoded = split.decode_changelog(jobs.normalise(topic, exact=exact), exact=exact)
    schema = T.StructType([T.StructField(ROW_ID, T.StringType()), *T.StructType.fromDDL(ddl).fields])
    rows = jobs.table_changes(decoded.withColumns({"scn": F.lit(1), "pos": F.lit(1)}), schema, exact=exact)
    return [(str(r.A), r.bad_cells, r.lossy_cells) for r in rows.collect()]


@pytest.mark.parametrize(
    ("number", "kind", "cell", "bad", "lossy"),
    [
        ("12345678901234567.89", "decimal(20,2)", "12345678901234567.89", 0, 0),
        (DIGITS_38, "decimal(38,0)", DIGITS_38, 0, 0),
        ("-0.00000000000000000000000000000000000001", "decimal(38,38)", "-1.0E-38", 0, 0),
        ("1.10", "decimal(20,2)", "1.10", 0, 0),
        ("1.239", "decimal(20,2)", "1.24", 0, 1),
        ("1e3", "decimal(20,2)", "1000.00", 0, 0),
        ("1.2e-5", "decimal(20,2)", "0.00", 0, 1),
        ("12345678901234567890.12345678901234567890", "decimal(38,10)", "12345678901234567000.0000000000", 0, 1),
        (DIGITS_38 + "9", "decimal(38,0)", "None", 1, 0),
        ('"17.5"', "decimal(20,2)", "17.50", 0, 0),
        ('"x"', "decimal(20,2)", "None", 1, 0),
        ("null", "decimal(20,2)", "None", 0, 0),
    ],
)
def test_cells(messages, number, kind, cell, bad, lossy):
    assert typed_of(messages, change(f'{{"A":{number}}}'), ddl=f"A {kind}") == [(cell, bad, lossy)]


def test_without_exact_images_the_loss_is_counted(messages):
    got = typed_of(messages, change('{"A":12345678901234567.89}'), change('{"A":12.5}'), exact=False)
    assert got == [("12345678901234568.00", 0, 1), ("12.50", 0, 0)]


def test_ids_and_other_columns_do_not_change(spark, messages):
    rows = messages(
        change('{"Z":1.10,"A":12345678901234567.89,"N":{"y":1.50,"x":[1e2,null]},"T":"a \\"b\\""}'),
        change('{"B":2.50}', "u", '{"B":12345678901234567.8}'), change(None, "d", '{"B":7}'), change('{}'),
    )
    plain, exact = (jobs.row_changes(rows, exact=e) for e in (False, True))
    columns = [ROW_ID, "op", "seq", "before", "after"]
    assert sorted(map(str, plain.select(columns).collect())) == sorted(map(str, exact.select(columns).collect()))
    keys = [{r.key for r in split.to_messages(x, F.lit("t")).collect()} for x in (plain, exact)]
    assert keys[0] == keys[1] and len(keys[0]) == 5


def test_messages_carry_every_digit(messages):
    out = jobs.normalise(messages(change('{"Z":1.10,"A":12345678901234567.89}')).withColumn("topic", F.lit("t")), exact=True)
    row = out.collect()[0]
    assert f'"after":{{"{ROW_ID}":"{row.key}","A":12345678901234567.89,"Z":1.1}}' in row.value


def test_an_id_of_the_image_stays(messages):
    out = jobs.normalise(messages(change(f'{{"{ROW_ID}":"mine","A":1.5}}')).withColumn("topic", F.lit("t")), exact=True)
    row = out.collect()[0]
    assert row.key == "mine" and row.value.count(ROW_ID) == 1


def test_repeated_keys_fall_back_to_the_double_form(messages):
    parsed = envelope.parse_changes(messages(change('{"A":1,"A":12345678901234567.89}')), exact=True)
    assert parsed.collect()[0].after_exact is None
    assert typed_of(messages, change('{"A":1,"A":12345678901234567.89}')) == [("12345678901234568.00", 0, 1)]


def test_bad_messages_with_exact_images(messages):
    rows = messages("", change('{"A":1}'), '{"scn":1}')
    assert envelope.parse_changes(rows, exact=True).count() == 1
    dummies = envelope.parse_changes(rows, on_bad="dummy", exact=True).collect()
    assert [r.after_exact for r in dummies] == ['{"C1":1}', '{"A":1}']


def test_streamed_tables_keep_the_digits(spark, folder, messages):
    from tidemark.plans.keyed_table import KeyedTable
    from tidemark.plans.tables import TablePlan
    from tidemark.sources import messages as msg

    plan = TablePlan("O", "T", "orcl-o-t", "target-orcl-o-t", "k", "ice", (("A", "DECIMAL(20,2)"), ("B", "DECIMAL(6,2)")))
    feed = messages(change('{"A":12345678901234567.89,"B":1.255}')).withColumn("topic", F.lit(plan.source_topic))
    empty = {f.name: F.lit(None).cast(f.dataType) for f in msg.M.MESSAGE if f.name not in feed.columns}
    msg.write_messages(feed.withColumns(empty), "parquet", path=f"{folder}/source")
    source = msg.read_messages(spark, "parquet", path=f"{folder}/source")
    jobs.start_normaliser(source, "parquet", f"{folder}/ck1", path=f"{folder}/target", quarantine=f"{folder}/bad", exact=True).awaitTermination()
    target = msg.read_messages(spark, "parquet", path=f"{folder}/target")
    jobs.start_table_sync(target, [plan], f"{folder}/tables", f"{folder}/ck2", run="r", exact=True).awaitTermination()
    table = KeyedTable(f"{folder}/tables/ice", plan.schema)
    assert [(str(r.A), str(r.B)) for r in table.current(spark).collect()] == [("12345678901234567.89", "1.26")]
    assert [(r.bad_cells, r.lossy_cells) for r in table.changes(spark).collect()] == [(0, 1)]


def test_cut_digits(spark):
    cases = {"1.25": 2, "1.250": 2, "1.0": 0, "100": -2, "1.5E3": -2, "1.5E-3": 4, "0.0": -400, "12": 0, "1E2": -2, "-0.001": 3}
    df = spark.createDataFrame([(t, p) for t, p in cases.items()], "t string, places int")
    for scale in (0, 2, 3):
        got = df.select("t", "places", typemap.is_cut(F.col("t"), scale).alias("cut")).collect()
        assert [(r.t, r.cut) for r in got] == [(r.t, r.places > scale) for r in got]


def test_identity_is_untouched_by_exact_columns(messages):
    rows = identity.add_row_ids(envelope.parse_changes(messages(change('{"A":1.10}')), exact=True)).collect()
    assert rows[0].after.endswith('"A":1.1}') and rows[0].after_exact == '{"A":1.1}'
    assert typed.SURE_DIGITS == 15


def test_a_hash_is_cut_out_of_an_image_and_other_ids_are_searched(messages):
    own = ('"ab"', '"' + "0f" * 16 + '"', '"' + "0F" * 16 + '"', '"a\\"b"', "17", "null", '{"x":1}')
    rows = messages(change('{"A":1.10}'), change('{"B":"AUTO_MD5_ID"}'), *(change(f'{{"A":1.10,"{ROW_ID}":{i}}}') for i in own))
    changes = jobs.row_changes(rows, exact=True).filter("after_exact is not null")
    got = {r.pos: (r.id, r.image) for r in changes.select("pos", F.col(ROW_ID).alias("id"), split.exact_image("after").alias("image")).collect()}
    assert got[0][1] == f'{{"{ROW_ID}":"{got[0][0]}","A":1.1}}'
    assert got[1][1] == f'{{"{ROW_ID}":"{got[1][0]}","B":"{ROW_ID}"}}'
    assert [got[i + 2][1] for i in range(len(own))] == [f'{{"A":1.1,"{ROW_ID}":{i}}}' for i in own]
    # Only an image without a hash in front is parsed for its id, only one that names an id of its own for its keys.
    plan = str(split.exact_image("after")._jc.toString())
    assert plan.index("rlike") < plan.lower().index("get_json_object")
    assert "contains(after_exact" in plan
