import pytest

from tidemark.llm import decontaminate

ITEM = "A train leaves Paris at 9 and travels 120 km in 2 hours toward the city of Lyon while Anna waits. How many km does it travel in 5 hours?"
PLAIN = "the quick brown fox jumps over the lazy dog and then runs far away into the dark wood"
ITEMS = [(1, ITEM), (2, PLAIN), (3, PLAIN), (4, "two words"), (5, None), (6, "one two three four five six"), (7, "1 2 3 4 5 6 7 8 9 10")]


def found(spark, texts, items=ITEMS, **how):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, items string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    return {r.id: list(r.items) for r in decontaminate.contaminated(docs, "doc_id", "text", bench, "item_id", "text", **how).collect()}


@pytest.mark.parametrize("how", [{}, {"broadcast_windows": 0}])
def test_copies_and_new_parameters(spark, how):
    other = ITEM.replace("Paris", "Berlin").replace("Lyon", "Munich").replace("Anna", "Otto").replace("120", "345.5").replace("2 hours", "7 hours").replace("5 hours", "8 hours")
    mixed = ITEM.replace("km in 2 hours", "km in 7 hours").replace("in 5 hours", "in 2 hours")
    texts = [
        ITEM, f"Some words. {other} And more.", "clean text of its own, with nothing to find in it at all, really", None, "",
        f"before\n{PLAIN.upper()}!\nafter", " ".join(w + "###" for w in PLAIN.split()), " ".join(PLAIN.split()[:9]), mixed,
        "one, two, three: four five six", "one two three four five", "1 2 3 4 5 6 7 8 9 10", "word " * 50_000 + PLAIN,
    ]
    assert found(spark, texts + texts[:1], **how) == {0: [1], 1: [1], 5: [2, 3], 6: [2, 3], 7: [2, 3], 8: [1], 9: [6], 12: [2, 3], 13: [1]}


def test_slots_must_agree(spark):
    item = "if x costs 3 coins and y costs 3 coins then both together cost as much as 6 coins here"
    same = item.replace("3", "4").replace("6", "8")
    broken = item.replace("3", "4", 1)
    assert found(spark, [same, broken, item], [(1, item)], width=16) == {0: [1], 2: [1]}


@pytest.mark.parametrize("how", [{}, {"broadcast_windows": 0}])
def test_disagreeing_slots_drop_only_their_windows(spark, how):
    name = "last week the teacher told Anna that the library opens early and then she asked whether all of the other children in the class would help Anna to bring her old books"
    pears = "Tom has 3 apples and 3 pears. How many pieces of fruit does he have when his sister gives him one more of each?"
    texts = [name.replace("Anna", "Otto", 1), name, pears.replace("3 apples", "4 apples").replace("3 pears", "7 pears"),
             "Tom has 4 apples and 7 pears. How long do they keep if nobody eats one of them before the end of the month?"]
    assert found(spark, texts, [(1, name), (2, pears)], **how) == {0: [1], 1: [1], 2: [2]}


def test_a_text_that_repeats_a_word_is_no_product(spark):
    """Windows without placeholders are there once, however often a text and an item repeat them."""
    docs = spark.createDataFrame([(1, "word " * 20_000), (2, "7 word " * 300)], "doc_id bigint, text string")
    made = decontaminate.windows(decontaminate.templates(docs, "doc_id", "text"), [8])
    assert {r.id: r["count"] for r in made.groupBy("id").count().collect()} == {1: 1, 2: 593}
    assert found(spark, ["word " * 20_000], [(1, "word " * 50)]) == {0: [1]}


def test_query_and_sql_drop_only_windows_that_disagree(spark, tmp_path):
    """Of three equal numbers one is changed: the other windows count, in the code and in the SQL."""
    import duckdb

    from tidemark.llm import queries

    item = "a box holds 3 red balls and another box near the old wooden door holds 3 green balls while the last one under the long table by the window has room for 3 blue balls of the same size"
    texts = [(1, item.replace("3 blue", "5 blue")), (2, item), (3, item.replace("3", "8")), (4, "nothing to see"), (5, None)]
    spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(9, item)], "item_id bigint, text string").coalesce(1).write.parquet(f"file://{tmp_path}/benchmark.parquet")
    df = queries.op9_decontamination(spark, f"file://{tmp_path}")
    got = sorted(tuple(r) for r in df.collect())
    assert [(r[0], r[4]) for r in got] == [(1, True), (2, True), (3, True), (4, False), (5, False)]
    assert 18 < got[0][3] < got[1][3] == got[2][3] == len(item.split())
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    columns = ", ".join(df.columns)
    assert sorted(db.execute(f"SELECT {columns} FROM ({queries.ORACLE['op9_decontamination']})").fetchall()) == got


def test_empty_tables_ties_and_null_ids(spark):
    assert found(spark, [], ITEMS) == {}
    assert found(spark, [PLAIN], []) == {}
    docs = spark.createDataFrame([(None, PLAIN), (5, PLAIN), (5, PLAIN), (6, "x")], "doc_id bigint, text string")
    bench = spark.createDataFrame(ITEMS + ITEMS, "item_id bigint, text string")
    rows = decontaminate.contaminated(docs, "doc_id", "text", bench, "item_id", "text").collect()
    assert sorted((r.id or 0, list(r.items), r.covered) for r in rows) == [(0, [2, 3], 18), (5, [2, 3], 18)]


def test_main_path_has_no_python(spark):
    docs = spark.createDataFrame([(1, PLAIN)], "doc_id bigint, text string")
    plan = decontaminate.windows(decontaminate.templates(docs, "doc_id", "text"), [5, 8])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
