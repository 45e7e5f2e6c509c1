"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Statistics of a text are columns; a rule rejects a text by a condition on them. The cascade measures each
rule on a sample: its cost in seconds and the share of texts it rejects. Rules are then tried in the
order of rejection per cost, and the first that rejects ends the cascade. The order changes what is
computed, never whether a text is kept.

Words are runs of characters other than the six ASCII white space characters. Null text has no words;
an empty text has none either. Repeated rows give repeated results, a very long text is one row
like any other, an empty table gives an empty result. Other columns are not returned; columns that
share a name with a statistic do no harm, since only id and text are read.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rows import emit

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A text is rejected if ``rejects``, a SQL condition on ``id, text`` and the base statistics, is true."""

    name: str
    rejects: str


# Fixed values of the default rules.
RULES = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("shouting", "2 * length(regexp_replace(text, '[^\\\\p{Lu}]+', '')) > length(regexp_replace(text, '[^\\\\p{L}]+', ''))"),
    Rule("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("few_letters", "2 * length(regexp_replace(text, '[^\\\\p{L}]+', '')) < word_chars"),
    Rule("few_distinct_words", "10 * size(array_distinct(split(text, '[ \\\\t-\\\\r]+'))) < n_words"),
)


def statistics(df: DataFrame, record_id: str, text: str, *, window: int = 8) -> DataFrame:
    """Id, text and base statistics of every row.

    ``n_repeat_words`` are the words inside a window of ``window`` words found twice or more in the text.
    Windows are compared by a 64-bit hash inside the row; only a text that repeats one sorts them.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(record_id).alias("id"), plain.alias("text"))
    trimmed = F.btrim("text", F.lit(BLANKS))
    words = F.when(trimmed != "", F.split(trimmed, "[ \\t-\\r]+")).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    rows = emit(
        rows,
        [
            F.col("id"),
            F.col("text"),
            F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
            (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            lines.alias("lines"),
            F.transform(words, lambda w: F.xxhash64(w)).alias("words"),
        ],
    )
    starts = F.when(F.size("words") >= window, F.sequence(F.lit(1), F.size("words") - (window - 1))).otherwise(
        F.array().cast("array<int>")
    )
    first = ["id", "text", "word_chars", "n_symbols"]
    rows = emit(
        rows,
        [
            *map(F.col, first),
            F.size("words").cast("long").alias("n_words"),
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, window))).alias("windows"),
        ],
    )
    first += ["n_words", "n_lines", "n_dup_lines"]
    numbered = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = emit(rows, [*map(F.col, first), F.when(repeats, F.sort_array(numbered)).alias("order")])

    def near(k: Column, by: int) -> Column:
        return F.coalesce(F.get("order", k + by)["h"] == F.get("order", k)["h"], F.lit(False))

    twice = F.filter("order", lambda _, k: near(k, -1) | near(k, 1))
    rows = emit(rows, [*map(F.col, first), F.sort_array(F.transform(twice, lambda x: x["i"])).alias("places")])
    gained = F.transform(
        "places", lambda p, k: F.least(F.lit(window), F.coalesce(F.get("places", k + 1) - p, F.lit(window)))
    )
    covered = F.aggregate(gained, F.lit(0).cast("long"), lambda total, x: total + x)
    return rows.select(*first, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def sampled(df: DataFrame, rows: int, *, seed: int = 3) -> DataFrame:
    """About ``rows`` rows drawn from all of ``df``; narrow, and of the same size whatever the input's."""
    share = min(1.0, rows / max(1, df.count()))
    return df.filter(F.rand(seed) < share)


def measured(sample: DataFrame, rules: tuple[Rule, ...]) -> list[tuple[Rule, float, float]]:
    """Each rule with its seconds and its share of rejections on a sample of statistics.

    The sample only decides the order of the rules. The statistics are taken once, then each rule is
    timed on its own.
    """
    sample = sample.persist()
    try:
        rows = max(1, sample.count())
        out = []
        for rule in rules:
            begin = time.perf_counter()
            rejected = sample.filter(rule.rejects).count()
            out.append((rule, time.perf_counter() - begin, rejected / rows))
        return out
    finally:
        sample.unpersist()


def ordered(measures: list[tuple[Rule, float, float]]) -> list[Rule]:
    """The rules by rejection per cost, the best first."""
    return [rule for rule, cost, share in sorted(measures, key=lambda m: -m[2] / max(m[1], 1e-6))]


def cascade(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """The statistics with ``base_failed``, ``kept`` and ``rejected_by``, the first rule that rejects."""
    verdict = F.when(base_failed(), F.lit("base"))
    for rule in rules:
        verdict = verdict.when(F.expr(rule.rejects), F.lit(rule.name))
    return stats.withColumns({"base_failed": base_failed(), "rejected_by": verdict}).withColumn("kept", F.col("rejected_by").isNull())


def apply_rules(df: DataFrame, record_id: str, text: str, rules: tuple[Rule, ...] = RULES, *, sample_rows: int = 2000) -> DataFrame:
    sample = statistics(sampled(df, sample_rows), record_id, text)
    return cascade(statistics(df, record_id, text), ordered(measured(sample, rules)))
