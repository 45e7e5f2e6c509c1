import hashlib
import json
import random

from pyspark.sql import functions as F

from tidemark.operators import envelope, identity
from tidemark.operators.split import split_updates, target_value

GOLDEN = (
    '{"CHAR1":"%s","CHAR2":"3","CHAR3":"3tt","DATE_1":"2024-03-03 00:00:00","CHAR4":null,"REAL1":null,'
    '"NUM1":null,"NUM2":null,"INT1":null,"FLOAT1":null}'
)


def with_ids(messages, *texts, **how):
    return identity.add_row_ids(envelope.parse_changes(messages(*texts), **how))


def insert(image):
    return '{"scn":1,"payload":{"op":"c","after":%s}}' % image


def map_text(value):
    """The printed form of a parsed image, written out by hand."""
    if isinstance(value, dict):
        return "{" + ", ".join(f"{k}={map_text(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ", ".join(map_text(v) for v in value) + "]"
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


def test_golden_messages(messages):
    update = '{"scn":88127297,"payload":{"op":"u","schema":{"owner":"DDS","table":"TEST2"},"row":1,"before":%s,"after":%s}}'
    rows = with_ids(messages, insert(GOLDEN % 3), update % (GOLDEN % 3, GOLDEN % 4)).orderBy("pos").collect()
    assert rows[0].after_id == "c31a67fe7f4a7ca8d79672f717d3cf29"
    assert rows[0].before_id is None
    assert rows[1].before_id == "c31a67fe7f4a7ca8d79672f717d3cf29"
    assert rows[1].after_id == "8c9c4c51c66c70133db773769e76e897"
    assert list(json.loads(rows[0].after))[0] == "AUTO_MD5_ID"


def test_random_images_against_brute_force(messages):
    rng = random.Random(7)
    letters = 'ab"\\,:{}[]= ->é\n\t'

    def scalar():
        return rng.choice(
            [None, True, False, rng.randint(-(10**12), 10**12), "".join(rng.choices(letters, k=rng.randint(0, 9))), 10**20]
        )

    def value(depth):
        if depth and rng.random() < 0.25:
            if rng.random() < 0.5:
                return [value(depth - 1) for _ in range(rng.randint(0, 3))]
            return {f"k{i}": value(depth - 1) for i in range(rng.randint(0, 3))}
        return scalar()

    images = [
        {f"{rng.choice(['A', 'b -> ', 'C:', 'é,'])}{i}": value(3) for i in range(rng.randint(0, 6))} for _ in range(300)
    ]
    texts = [insert(json.dumps(i, ensure_ascii=rng.random() < 0.5)) for i in images]
    rows = with_ids(messages, *texts).orderBy("pos").collect()
    assert len(rows) == len(images)
    for image, row in zip(images, rows):
        want = hashlib.md5(map_text(image).encode()).hexdigest()
        assert row.after_id == want, (image, row.after)
        assert json.loads(row.after) == {"AUTO_MD5_ID": want, **image}


def test_number_forms(messages):
    row = with_ids(messages, insert('{"a":1.10,"b":1e10,"c":12345678.9,"d":-0.0,"e":100,"f":1E400}')).collect()[0]
    text = "{a=1.1, b=1.0E10, c=1.23456789E7, d=-0.0, e=100, f=Infinity}"
    assert row.after_id == hashlib.md5(text.encode()).hexdigest()


def test_repeated_keys_keep_first_place_and_last_value(messages):
    row = with_ids(messages, insert('{"a":1,"b":"2","a":"3"}')).collect()[0]
    assert row.after_id == hashlib.md5(b"{a=3, b=2}").hexdigest()
    assert row.after == '{"AUTO_MD5_ID":"%s","a":"3","b":"2"}' % row.after_id


def test_present_id_wins(messages):
    rows = with_ids(
        messages, insert('{"a":1,"AUTO_MD5_ID":"zz","b":"c"}'), insert('{"a":1,"AUTO_MD5_ID":null}')
    ).orderBy("pos").collect()
    assert (rows[0].after_id, rows[0].after) == ("zz", '{"AUTO_MD5_ID":"zz","a":1,"b":"c"}')
    assert (rows[1].after_id, rows[1].after) == (None, '{"AUTO_MD5_ID":null,"a":1}')


def test_key_order_matters(messages):
    rows = with_ids(messages, insert('{"a":1,"b":2}'), insert('{"b":2,"a":1}')).collect()
    assert len({r.after_id for r in rows}) == 2


def test_other_operations_pass(messages):
    row = with_ids(messages, '{"payload":{"op":"r","before":{"a":1},"after":{"a":2}}}').collect()[0]
    assert (row.before, row.after, row.before_id, row.after_id) == ('{"a":1}', '{"a":2}', None, None)


def test_upper_case_update_is_identified_but_not_split(messages):
    both = '{"payload":{"op":"%s","before":{"a":1},"after":{"a":2}}}'
    changes = with_ids(messages, both % "U", both % "u")
    split = split_updates(changes)
    ops = {}
    for r in split.collect():
        ops.setdefault(r.pos, []).append((r.seq, r.op))
    assert ops[0] == [(0, "U")]
    assert sorted(ops[1]) == [(0, "d"), (1, "c")]
    flipped = split_updates(changes, order="create_first")
    assert [(r.seq, r.op) for r in flipped.filter("pos = 1").orderBy("seq").collect()] == [(0, "c"), (1, "d")]


def test_target_text_is_complete_json_in_order(messages):
    text = '{"payload":{"op":"r","schema":{"owner":"O\\"x","table":null},"rid":"r/1","sql":"a\\n[b]","after":{"k":"é"}}}'
    changes = split_updates(with_ids(messages, text))
    value = changes.select(target_value().alias("v")).collect()[0].v
    assert value == (
        '{"op":"r","schema":{"owner":"O\\"x","table":null},"row":0,"rid":"r/1","before":null,'
        '"after":{"k":"é"},"sql":"a\\n[b]"}'
    )


def test_stand_ins_get_no_id(messages):
    rows = split_updates(with_ids(messages, "", insert('{"a":1}'), on_bad="dummy")).select("pos", F.col("AUTO_MD5_ID").alias("i")).collect()
    assert {r.pos: r.i is None for r in rows} == {0: True, 1: False}
