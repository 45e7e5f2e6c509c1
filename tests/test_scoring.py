import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.redact import RULES, Rule, redact, rules_from
from tidemark.streaming import scoring


def scorer():
    def ask(body):
        if body["sentence"] == "boom":
            raise RuntimeError("model is gone")
        if body["sentence"] == "busy":
            return 503, "later"
        return 200, json.dumps(body)

    return scoring.one_by_one(ask)


def sentence(i, text):
    return json.dumps({"sentenceId": i, "content": text})


def test_failures_are_results(messages):
    df = messages(sentence(1, "hi"), sentence(2, "boom"), sentence(3, "busy"), sentence(None, "hi"), "junk",
                  '{"sentenceId":1,"content":"x","more":2}')
    rows = scoring.score(scoring.parse_sentences(df), scorer).orderBy("pos").collect()
    assert [r.output for r in rows] == [
        '{"sentence": "hi", "sentence_id": "1"}',
        "Request failed: model is gone",
        "Error: 503",
        "Request failed: sentence id is null",
        "Request failed: not a sentence object",
        "Request failed: unknown field",
    ]
    assert [r.status for r in rows] == [200, None, 503, None, None, None]


def test_one_scorer_per_task(spark):
    import os

    def counting():
        marker = os.urandom(4).hex()
        return lambda requests: [(200, marker)] * len(requests)

    df = spark.range(2000).select(F.col("id").alias("sentence_id"), F.lit("x").alias("content")).coalesce(1)
    assert scoring.score(df, counting).select("result").distinct().count() == 1


def test_a_failing_batch_is_asked_row_by_row(messages):
    def factory():
        def ask(requests):
            if any(r["sentence"] == "boom" for r in requests):
                raise RuntimeError("no")
            return [(200, f"{r['sentence']} {len(requests)}") for r in requests]

        return ask

    df = messages(sentence(1, "a"), sentence(2, "boom"), sentence(3, "b")).coalesce(1)
    rows = scoring.score(scoring.parse_sentences(df), factory).orderBy("pos").collect()
    assert [r.output for r in rows] == ["a 1", "Request failed: no", "b 1"]
    whole = scoring.score(scoring.parse_sentences(df.filter("pos <> 1")), factory).orderBy("pos").collect()
    assert [r.output for r in whole] == ["a 2", "b 2"]


def test_spellings_of_sentence_ids(messages):
    df = messages('{"sentenceId":"12","content":"x"}', '{"sentenceId":12.0,"content":"x"}', '{"sentenceId":"a","content":"x"}')
    rows = scoring.parse_sentences(df).orderBy("pos").collect()
    assert [(r.sentence_id, r.parse_error) for r in rows] == [(12, None), (12, None), (None, "sentence id is null")]


def test_tag_counts_stream_equals_batch(spark, folder):
    df = spark.range(3000).select(
        F.timestamp_seconds(F.col("id") * 7).alias("ts"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("tag_source")
    )
    df.write.parquet(f"{folder}/in")
    batch = {tuple(r) for r in scoring.tag_counts(df, "ts", F.col("tag_source")).collect()}
    stream = spark.readStream.schema(df.schema).parquet(f"{folder}/in")
    query = (
        scoring.tag_counts(stream, "ts", F.col("tag_source")).writeStream.format("memory").queryName("tags")
        .outputMode("complete").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert {tuple(r) for r in spark.table("tags").collect()} == batch
    assert sum(r[3] for r in batch) == 3000


def test_redaction(spark):
    cases = [
        ('{"Password" : "a b"}', '{"password": "LOG-REDACTED"}'),
        ("PASSWORD=abc def", "password=LOG-REDACTED def"),
        ("passwd:abc", "passwd=LOG-REDACTED"),
        ("pass=abc", "pass=LOG-REDACTED"),
        ('by password,abc def" x', 'by PASSWORD, LOG-REDACTED" x'),
        ("SECRET:abc", "secret=LOG-REDACTED"),
        ("card 1234-5678 9012.3456.", "card XXXX-XXXX-XXXX-XXXX."),
        ("ssn 123-45-6789", "ssn XXX-XX-XXXX"),
        ("1234:5678:9012:3456 and $1 \\", "1234:5678:9012:3456 and $1 \\"),
        ("nothing", "nothing"),
    ]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)] + [(99, None)], "i int, line string")
    got = {r.i: r.line for r in redact(df, "line").collect()}
    assert got == {**{i: b for i, (_, b) in enumerate(cases)}, 99: None}


def _rows(spark, n):
    return spark.range(n).select(F.col("id").alias("pos"), F.col("id").alias("sentence_id"), F.concat(F.lit("s"), "id").alias("content")).coalesce(1)


def test_never_more_in_flight_than_allowed(spark):
    def factory():
        import threading
        import time

        lock, now, most = threading.Lock(), [0], [0]

        def ask(requests):
            with lock:
                now[0] += 1
                most[0] = max(most[0], now[0])
                seen = most[0]
            time.sleep(0.02)
            with lock:
                now[0] -= 1
            return [(200, f"{r['sentence_id']} {seen}") for r in requests]

        return ask

    for limit in (1, 3):
        rows = scoring.score(_rows(spark, 40), factory, in_flight=limit, ask_rows=2).orderBy("pos").collect()
        assert [int(r.output.split()[0]) for r in rows] == list(range(40))  # in order, each once
        assert max(int(r.output.split()[1]) for r in rows) == limit


def test_failures_are_asked_again_up_to_a_limit(spark):
    def factory():
        asks = {}

        def ask(requests):
            out = []
            for r in requests:
                i = int(r["sentence_id"])
                asks[i] = asks.get(i, 0) + 1
                if i % 5 == 0:  # recovers at the third ask
                    out.append((200, f"asks {asks[i]}") if asks[i] == 3 else (503, "busy"))
                elif i % 5 == 1:  # never recovers
                    out.append(ValueError(f"broken {asks[i]}"))
                elif i % 5 == 2:  # an answer, though no good one
                    out.append((404, "gone"))
                else:
                    out.append((200, f"asks {asks[i]}"))
            return out

        return ask

    rows = scoring.score(_rows(spark, 10), factory, in_flight=2, ask_rows=3, attempts=3, pause_s=0.001).orderBy("pos").collect()
    want = ["asks 3", "Request failed: broken 3", "Error: 404", "asks 1", "asks 1"] * 2
    assert [r.output for r in rows] == want
    rows = scoring.score(_rows(spark, 10), factory, attempts=2, pause_s=0.001).orderBy("pos").collect()
    assert [r.output for r in rows[:2]] == ["Error: 503", "Request failed: broken 2"]


def test_an_ask_that_fails_as_a_whole(spark):
    def factory():
        def ask(requests):
            if len(requests) > 1 or requests[0]["sentence_id"] == "3":
                raise RuntimeError("too much")
            return [(200, requests[0]["sentence"])]

        return ask

    rows = scoring.score(_rows(spark, 6), factory, in_flight=2, ask_rows=4, attempts=2, pause_s=0.001).orderBy("pos").collect()
    assert [r.output for r in rows] == ["s0", "s1", "s2", "Request failed: too much", "s4", "s5"]


def test_limits_must_be_positive(spark):
    for how in ({"in_flight": 0}, {"attempts": 0}, {"ask_rows": -1}):
        with pytest.raises(ValueError):
            scoring.score(_rows(spark, 1), lambda: None, **how)


def test_rules_from_a_file(spark, tmp_path):
    file = tmp_path / "rules.json"

    def read(rules):
        file.write_text(json.dumps({"version": 1, "rules": rules}))
        return rules_from(spark, f"file://{file}")

    listed = [{"trigger": r.trigger, "search": r.search, "replace": r.replace, "caseSensitive": r.case_sensitive} for r in RULES]
    assert read(listed) == RULES
    rules = read([{"description": "digits", "search": r"\d+", "replace": "$N"}, {"search": "X", "replace": "", "caseSensitive": True}])
    assert rules == (Rule(None, r"\d+", "$N"), Rule(None, "X", "", True))
    df = spark.createDataFrame([("a1 xX 22",), (None,)], "line string")
    assert [r.line for r in redact(df, "line", rules).collect()] == ["a$N x $N", None]
    for bad in ([{"search": "a"}], [{"replace": "a"}], ["a"], [{"search": "(", "replace": ""}]):
        with pytest.raises(Exception, match="rule 0|regex|pattern|PATTERN|REGEX"):
            read(bad)
    file.write_text("{}")
    with pytest.raises(ValueError):
        rules_from(spark, f"file://{file}")
