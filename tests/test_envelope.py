import pytest
from pyspark.sql import functions as F

from tidemark import model as M
from tidemark.operators import envelope

CASES = [
    ('{"scn":5,"payload":{"op":"c","after":{"a":1}}}', None),
    ('{"scn":5,"payload":{"op":"c","after":{"a":1}}} trailing', None),
    ('{"scn":5,"payload":{"op":"c","after":{}}}', None),
    ('{"scn":5,"payload":{"op":"C","row":"7","after":{"a":1}}}', None),
    ('{"scn":5,"tms":"[x","payload":{"op":"d","before":{"k":"{"}}}', None),
    ('{"scn":5,"payload":{"op":"ddl","sql":"alter \\"t\\" {x}"}}', None),
    ('{"scn":5,"payload":{"op":"r","after":null}}', None),
    ("", "empty"),
    (None, "empty"),
    ("   ", "bad_json"),
    ("null", "bad_json"),
    ("5", "bad_json"),
    ("{'scn':5}", "bad_json"),
    ('{"scn":NaN}', "bad_json"),
    ('{"scn":5,"payload":{"op":"c"', "bad_json"),
    ('[{"scn":5,"payload":{"op":"c"}}]', "bad_json"),
    ('{"scn":5,"payload":"zz"}', "bad_json"),
    ('{"scn":5,"payload":"{\\"op\\":\\"c\\"}"}', "bad_json"),
    ('{"scn":5,"payload":{"op":"c","schema":"x"}}', "bad_json"),
    ('{"scn":5,"payload":{"op":"c","schema":{"owner":{"a":1}}}}', "bad_json"),
    ('{"scn":5,"payload":{"op":{"a":1}}}', "bad_json"),
    ('{"scn":5,"tms":{"a":1},"payload":{"op":"r"}}', "bad_json"),
    ('{"scn":5,"zz":1}', "unknown_key"),
    ('{"scn":5,"payload":{"op":"r","zz":1}}', "unknown_key"),
    ('{"scn":5,"payload":{"op":"r","schema":{"name":"x"}}}', "unknown_key"),
    ('{"scn":"x","payload":{"op":"r"}}', "bad_number"),
    ('{"scn":5,"payload":{"op":"r","row":"x"}}', "bad_number"),
    ('{"scn":5}', "missing_payload"),
    ('{"scn":5,"payload":{"sql":"x"}}', "missing_op"),
    ('{"scn":5,"payload":{"op":"u","after":{"a":1}}}', "missing_image"),
    ('{"scn":5,"payload":{"op":"D","after":{"a":1}}}', "missing_image"),
    ('{"scn":5,"payload":{"op":"c","after":[1,2]}}', "image_not_object"),
    ('{"scn":5,"payload":{"op":"c","after":"{\\"a\\":1}"}}', "image_not_object"),
    ('{"scn":5,"payload":{"op":"c","after":{"b":[{"x":1,"x":2}]}}}', "repeated_inner_key"),
]


def test_reasons(messages):
    flagged = envelope.parse_changes(messages(*[m for m, _ in CASES]), on_bad="flag")
    got = {r.pos: r.reason for r in flagged.collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(CASES)}


def test_good_and_quarantined_are_a_partition(messages):
    df = messages(*[m for m, _ in CASES])
    good = {r.pos for r in envelope.parse_changes(df).collect()}
    bad = {r.pos for r in envelope.quarantined(df).collect()}
    assert good == {i for i, (_, r) in enumerate(CASES) if r is None}
    assert bad == {i for i, (_, r) in enumerate(CASES) if r is not None}


def test_fields(messages):
    text = (
        '{"scn":"12","tms":"t","xid":"x","row":"o","payload":{"op":"u","schema":{"owner":"O","table":"T"},'
        '"row":3,"rid":"R","before":{"b":1.10,"a":"\\u00e9"},"after":{"b":1e10,"a":null},"sql":null}}'
    )
    row = envelope.parse_changes(messages(text)).collect()[0]
    assert (row.scn, row.tms, row.xid, row.op, row.row, row.rid, row.sql) == (12, "t", "x", "u", 3, "R", None)
    assert tuple(row.schema) == ("O", "T")
    assert row.before == '{"b":1.1,"a":"é"}'
    assert row.after == '{"b":1.0E10,"a":null}'


def test_numbers_default_and_cut(messages):
    rows = envelope.parse_changes(
        messages('{"payload":{"op":"r"}}', '{"scn":7.9,"payload":{"op":"r","row":null}}')
    ).orderBy("pos").collect()
    assert [(r.scn, r.row) for r in rows] == [(0, 0), (7, 0)]


def test_repeated_envelope_key_takes_the_last(messages):
    row = envelope.parse_changes(messages('{"scn":5,"scn":6,"payload":{"op":"x","op":"r"}}')).collect()[0]
    assert (row.scn, row.op) == (6, "r")


def test_dummy(messages):
    df = messages("", '{"scn":1,"zz":2}', '{"scn":5}', '{"scn":5,"payload":{"op":"r"}}')
    rows = {r.pos: r for r in envelope.parse_changes(df, on_bad="dummy").collect()}
    assert set(rows) == {0, 1, 3}
    for i in (0, 1):
        assert rows[i].is_dummy and rows[i].op == "c" and rows[i].after == M.DUMMY_IMAGE
        assert tuple(rows[i].schema) == ("test", "ICE_DEMO")
        assert (rows[i].row, rows[i].rid) == (1, "AAAWAgAAEAAACRmAAB")
    assert not rows[3].is_dummy


def test_fail_stops(messages):
    assert envelope.parse_changes(messages('{"scn":5,"payload":{"op":"r"}}'), on_bad="fail").count() == 1
    with pytest.raises(Exception, match="bad change message: unknown_key"):
        envelope.parse_changes(messages('{"zz":5}'), on_bad="fail").collect()
    with pytest.raises(ValueError):
        envelope.parse_changes(messages(""), on_bad="ignore")


def test_strict_ops(messages):
    df = messages('{"payload":{"op":"r"}}', '{"payload":{"op":"DDL"}}', '{"payload":{"op":"ddl"}}')
    bad = {r.pos: r.reason for r in envelope.quarantined(df, strict_ops=True).collect()}
    assert bad == {0: "unknown_op", 1: "unknown_op"}


def test_ddl_filter_minds_case(messages):
    df = envelope.parse_changes(messages('{"payload":{"op":"DDL"}}', '{"payload":{"op":"ddl"}}'))
    assert [r.op for r in envelope.drop_ddl(df).collect()] == ["DDL"]


def test_text_is_parsed_once_whatever_is_filtered(messages):
    df = envelope.parse_changes(messages(CASES[0][0]))
    plan = df.filter(F.col("op") == "c").filter("scn > 1 and rid is null")._jdf.queryExecution().optimizedPlan().toString()
    # envelope, payload, address, the typed check, and the rare inner checks; none twice
    assert plan.count("from_json(MapType(StringType,StringType,true)") == 5


def test_texts_that_look_like_objects(messages):
    base = '{"scn":1,%s"payload":{"op":"c",%s"after":{"a":1}}}'
    df = messages(
        base % ("", r'"rid":"{\"k\":1}",'),
        base % ("", r'"rid":"[a\\b]",'),
        base % ('"tms":[1],', '"rid":"[1]",'),
        base % ("", '"sql":{"x":1},'),
        base % ("", '"sql":"{\\"x\\":1}",'),
        '{"scn":1,"payload":{"op":"c","after":"{}"}}',
    )
    rows = envelope.parse_changes(df, on_bad="flag").orderBy("pos").collect()
    assert [r.reason for r in rows] == [None, None, "bad_json", "bad_json", None, "image_not_object"]
    assert (rows[0].rid, rows[1].rid) == ('{"k":1}', "[a\\b]")
