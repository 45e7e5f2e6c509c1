"""Scoring a stream of sentences with a pluggable model."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import model as M
from tidemark.functions import jsontext

# A scorer takes a batch of requests, ``{"sentence": …, "sentence_id": …}`` each, and gives an answer
# for each: (status, body), or an exception. A factory makes one per task, so that a model loads once.
Answer = tuple[int, str] | Exception
Scorer = Callable[[list[dict]], list[Answer]]
ScorerFactory = Callable[[], Scorer]

_RESULT = "result string, status int, error string"


def parse_sentences(messages: DataFrame) -> DataFrame:
    """Sentences out of the ``value`` column; ``parse_error`` says why one is not usable."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in M.SENTENCE])
    parsed = messages.withColumn("_s", F.from_json("value", as_text, jsontext.STRICT))
    sentence_id = F.expr(jsontext.whole_number("_s.sentenceId", "bigint"))
    known = F.array(*[F.lit(f.name) for f in M.SENTENCE])
    keys = F.json_object_keys("value")
    error = (
        F.when(keys.isNull(), "not a sentence object")
        .when(F.size(F.array_except(keys, known)) > 0, "unknown field")
        .when(sentence_id.isNull(), "sentence id is null")
    )
    return parsed.select(
        "*",
        sentence_id.alias("sentence_id"),
        F.col("_s.content").alias("content"),
        error.alias("parse_error"),
    ).drop("_s")


def request(sentence_id: Column, content: Column) -> Column:
    """The request for a sentence. The id goes as text."""
    return F.struct(
        content.alias("sentence"),
        sentence_id.cast("string").alias("sentence_id"),
    )


# Statuses that say: later.
LATER = (429, 503)


def score(
    sentences: DataFrame,
    factory: ScorerFactory,
    *,
    in_flight: int = 1,
    ask_rows: int | None = None,
    attempts: int = 1,
    pause_s: float = 0.5,
    later: Sequence[int] = LATER,
) -> DataFrame:
    """Add ``result``, ``status`` and ``error`` of the model, and ``output``, the message text.

    No row is dropped and no failure stops the job: ``output`` is the body, ``Error: <status>`` for
    another status than 200, or ``Request failed: <cause>``. Rows that could not be read are not
    sent; other columns stay behind.

    Requests go to the model ``ask_rows`` at a time, by default an Arrow batch. A task has at most ``in_flight``
    asks out at once, more than one only for a scorer that several threads may call; answers come back in order,
    and no request waits in memory but those of one Arrow batch. A request that failed, or whose status is in
    ``later``, is asked again until it has had ``attempts`` asks, after a pause that doubles; the last answer
    counts. If an ask of several requests fails as a whole, each of them is asked alone within the same attempt,
    also those that the model had answered before it failed: a scorer that must not be asked twice returns
    failures by request, as exceptions among its answers.
    """
    if min(in_flight, attempts, ask_rows or 1) < 1:
        raise ValueError("in_flight, attempts and ask_rows are at least one")

    @F.pandas_udf(_RESULT)
    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = factory()

        def ask(requests: list[dict]) -> list[Answer]:
            return _insisted(scorer, requests, attempts, pause_s, later)

        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                asked = batch[batch["asked"]]
                requests = asked[["sentence", "sentence_id"]].astype(object).where(asked.notna(), None).to_dict("records")
                size = ask_rows or max(1, len(requests))
                parts = [requests[i : i + size] for i in range(0, len(requests), size)]
                given = [a for part in _in_order(pool, ask, parts, in_flight) for a in part]
                rows = pd.DataFrame([_row(a) for a in given], columns=["result", "status", "error"], index=asked.index)
                yield rows.reindex(batch.index).astype({"status": "Int32"})

    problem = F.col("parse_error") if "parse_error" in sentences.columns else F.lit(None).cast("string")
    body = request(F.col("sentence_id"), F.col("content"))
    # Of a row that could not be read, nothing but a mark goes to Python.
    asked = F.struct(
        F.when(problem.isNull(), body["sentence"]).alias("sentence"),
        F.when(problem.isNull(), body["sentence_id"]).alias("sentence_id"),
        problem.isNull().alias("asked"),
    )
    flat = sentences.withColumn("_a", answers(asked))
    flat = flat.withColumn("_a", F.col("_a").withField("error", F.coalesce(problem, F.col("_a.error"))))
    return flat.select(
        *sentences.columns,
        F.col("_a.result").alias("result"),
        F.col("_a.status").alias("status"),
        F.col("_a.error").alias("error"),
        output_text(F.col("_a")).alias("output"),
    )


def output_text(answer: Column) -> Column:
    """The message text for an answer."""
    status, error = answer.getField("status"), answer.getField("error")
    return (
        F.when(error.isNotNull(), F.concat(F.lit("Request failed: "), error))
        .when(status != 200, F.concat(F.lit("Error: "), status.cast("string")))
        .otherwise(answer.getField("result"))
    )


def tag_counts(scored: DataFrame, ts: str, tag: Column, *, width: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Messages per tag and time window. An addition: the studied jobs only state the wish for it."""
    tagged = scored.withColumn("tag", tag)
    if scored.isStreaming:
        tagged = tagged.withWatermark(ts, late)
    counted = tagged.groupBy(F.window(ts, width).alias("w"), "tag").agg(F.count(F.lit(1)).alias("messages"))
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "tag", "messages"
    )


def one_by_one(ask: Callable[[dict], tuple[int, str]]) -> Scorer:
    """A scorer from a model that takes one request at a time."""

    def answer(body: dict) -> Answer:
        try:
            return ask(body)
        except Exception as e:  # a failure is an answer here
            return e

    return lambda requests: [answer(body) for body in requests]


def _in_order(pool: ThreadPoolExecutor, ask: Callable, parts: list, window: int) -> Iterator:
    """``ask(part)`` of all parts in their order, at most ``window`` of them begun and not yet given out."""
    begun: deque = deque()
    for part in parts:
        if len(begun) == window:
            yield begun.popleft().result()
        begun.append(pool.submit(ask, part))
    while begun:
        yield begun.popleft().result()


def _insisted(scorer: Scorer, requests: list[dict], attempts: int, pause_s: float, later: Sequence[int]) -> list[Answer]:
    """An answer per request; those that failed or were put off are asked again."""
    answers = _asked(scorer, requests)
    for attempt in range(1, attempts):
        again = [i for i, a in enumerate(answers) if isinstance(a, Exception) or a[0] in later]
        if not again:
            break
        time.sleep(pause_s * 2 ** (attempt - 1))
        for i, answer in zip(again, _asked(scorer, [requests[i] for i in again]), strict=True):
            answers[i] = answer
    return answers


def _asked(scorer: Scorer, requests: list[dict]) -> list[Answer]:
    """An answer per request. If the model fails on a batch, each request is asked alone."""
    if not requests:
        return []
    try:
        answers = scorer(requests)
        if len(answers) != len(requests):
            raise ValueError(f"{len(answers)} answers to {len(requests)} requests")
        return list(answers)
    except Exception as e:
        return [e] if len(requests) == 1 else [a for r in requests for a in _asked(scorer, [r])]


def _row(answer: Answer) -> tuple[str | None, int | None, str | None]:
    if isinstance(answer, Exception):
        return None, None, str(answer)
    status, body = answer
    return (body if status == 200 else None), status, None
