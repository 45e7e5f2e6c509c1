"""Benchmark decontamination by template windows, in DataFrame expressions only.

A text is reduced to a template: numbers, units behind numbers and names (capitalised words inside a
sentence) become typed placeholders, other words are lower-cased, punctuation only separates words.
Windows of template words are hash-joined with those of the benchmark, and matches that lie on one
diagonal form an alignment. An alignment is consistent if every value of the benchmark's placeholders
always stands for the same value in the document; so a question with other numbers or names is found,
and a text that merely shares the pattern is not. Where what stands for a value disagrees, only the
windows that hold that value are dropped; windows without placeholders always count. A document is
contaminated by an item if what is left covers at least ``percent`` of the item's words.

Items of fewer than ``least_words`` words say too little and match nothing; other items shorter than a
window are one window of their own length. A window of placeholders alone matches nothing. Benchmark items of
one text are one item for the join. Null and empty texts are clean. Rows with one id are one document; a null id
counts as an id. Empty tables: nothing is contaminated. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rows import emit
from tidemark.llm.common import stored

# Markers of placeholders, from the private use area; they are taken out of texts first.
NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"
MARKS = NAME + NUMBER + UNIT
# Units.
UNITS = (
    "kilometers kilometres kilometer kilometre kilograms kilogram centimeters centimeter percent dollars dollar euros euro "
    "pounds pound cents cent meters metres meter metre grams gram liters litres liter litre miles mile inches inch feet foot "
    "hours hour minutes minute seconds second days day weeks week months month years year kg mg km cm mm ml lb oz kwh mph usd eur"
).split()


def marked(text: Column) -> Column:
    """The text with placeholders marked, their values still there."""
    plain = F.translate(F.coalesce(text, F.lit("")), MARKS, "")
    plain = F.regexp_replace(plain, r"(\p{N})[.,:](\p{N})", "$1$2")
    plain = F.regexp_replace(plain, r"([\p{Ll}\p{N},;] )(\p{Lu}\p{L}*)", f"$1{NAME}$2")
    for _ in range(2):  # names of up to three words
        plain = F.regexp_replace(plain, rf"({NAME}\p{{L}}+ )(\p{{Lu}}\p{{L}}*)", f"$1{NAME}$2")
    plain = F.regexp_replace(plain, r"(\p{N}+)", f" {NUMBER}$1 ")
    plain = F.lower(plain)
    return F.regexp_replace(plain, rf"({NUMBER}\p{{N}}+ +)({'|'.join(UNITS)})\b", f"$1{UNIT}$2")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, rf"[^\p{{L}}\p{{N}}{MARKS}]+"), lambda w: w != "")


def templates(df: DataFrame, record_id: str, text: str) -> DataFrame:
    """``(id, words, values)``: template words, and the words they stand for where there are placeholders."""
    rows = emit(df, [F.col(record_id).cast("long").alias("id"), marked(F.col(text)).alias("marked")])
    template = F.regexp_replace("marked", rf"([{MARKS}])[\p{{L}}\p{{N}}]*", "$1")
    has = F.col("marked").rlike(f"[{MARKS}]")
    return emit(rows, [F.col("id"), _words(template).alias("words"), F.when(has, _words(F.col("marked"))).alias("values")])


def windows(rows: DataFrame, widths: Sequence[int]) -> DataFrame:
    """``(id, at, width, key, values)``: a row per window of ``widths`` words that is not of placeholders alone.

    Where a window stands matters only to its values: a window without placeholders has neither place nor values, and
    is there once however often its text repeats it.
    """
    # Every word is hashed, and looked at for a placeholder, once; windows are slices of that.
    open_ = F.when(F.col("values").isNotNull(), _open(F.col("words")))
    named = emit(rows, [F.col("id"), _names(F.col("words")).alias("names"), open_.alias("open"), F.col("values")])
    each = [part for width in widths for part in _windows_of(width)]
    return named.select("id", F.inline(F.concat(*(F.coalesce(x, F.array().cast(f"array<{WINDOW}>")) for x in each))))


WINDOW = "struct<at:int,width:int,key:bigint,values:array<string>>"


def _open(words: Column) -> Column:
    """Which words are placeholders."""
    return F.transform(words, lambda w: (w >= NAME) & (w < chr(ord(UNIT) + 1)))


def _names(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows_of(width: int) -> tuple[Column, Column]:
    """Windows without placeholders, each once, and those with some, with places and values."""
    starts = F.when(F.size("names") >= width, F.sequence(F.lit(1), F.size("names") - (width - 1)))

    def key(i: Column) -> Column:
        return F.xxhash64(F.slice("names", i, width))

    def holds(i: Column, placeholder: bool) -> Column:
        return F.array_contains(F.slice("open", i, width), placeholder)

    def plain(k: Column) -> Column:
        nothing = F.lit(None)
        return F.struct(nothing.cast("int").alias("at"), F.lit(width).alias("width"), k.alias("key"), nothing.cast("array<string>").alias("values"))

    def slotted(i: Column) -> Column:
        return F.struct(i.alias("at"), F.lit(width).alias("width"), key(i).alias("key"), F.slice("values", i, width).alias("values"))

    without = F.when(F.col("open").isNull(), starts).otherwise(F.filter(starts, lambda i: ~holds(i, True)))
    mixed = F.when(F.col("open").isNotNull(), F.filter(starts, lambda i: holds(i, True) & holds(i, False)))
    return F.transform(F.array_distinct(F.transform(without, key)), plain), F.transform(mixed, slotted)


def _item_windows(items: DataFrame, widths: Sequence[int], width: int) -> DataFrame:
    """``(item, item_at, width, key, item_values)`` of every window of an item: of ``width`` words, or the whole of a shorter one."""
    named = items.select("id", "size", _names(F.col("words")).alias("names"), _open(F.col("words")).alias("open"), "values")
    own = F.least("size", F.lit(width))
    starts = F.explode(F.sequence(F.lit(1), F.col("size") - own + 1)).alias("item_at")
    spread = named.select(F.col("id").alias("item"), own.alias("width"), "names", "open", "values", starts)
    part = lambda c: F.slice(c, F.col("item_at"), F.col("width"))
    spread = spread.filter(F.array_contains(part("open"), False))
    values = F.when(F.array_contains(part("open"), True), part("values"))
    return spread.select("item", "item_at", "width", F.xxhash64(part("names")).alias("key"), values.alias("item_values"))


def contaminated(
    docs: DataFrame,
    record_id: str,
    text: str,
    benchmark: DataFrame,
    item_id: str,
    item_text: str,
    *,
    width: int = 8,
    least_words: int = 5,
    percent: int = 50,
    broadcast_windows: int = 300_000,
) -> DataFrame:
    """``(id, items, covered)`` of contaminated documents: the items and the most words covered of one.

    The benchmark's windows are broadcast if they number ``broadcast_windows`` at most (about 20 MB),
    else both sides are shuffled by window.
    """
    items = templates(benchmark, item_id, item_text).withColumn("size", F.size("words")).filter(F.col("size") >= least_words)
    text_key = F.coalesce("values", "words")
    items = items.groupBy(text_key.alias("text")).agg(
        F.min("id").alias("id"), F.first("words").alias("words"), F.first("values").alias("values"),
        F.first("size").alias("size"), F.sort_array(F.collect_set("id")).alias("ids"),
    )
    items = stored(items.select("id", "ids", "size", "words", "values"), "items")
    rows = templates(docs, record_id, text)
    # One width, and one more for each length below it: at most width - least_words + 1.
    widths = sorted(r[0] for r in items.select(F.least("size", F.lit(width))).distinct().collect())
    if not widths:
        return docs.sparkSession.createDataFrame([], "id bigint, items array<bigint>, covered bigint")
    keys = stored(_item_windows(items, widths, width), "keys")
    if keys.count() <= broadcast_windows:
        keys = F.broadcast(keys)
    matches = windows(rows, widths).join(keys, ["width", "key"])
    # What a window's placeholders stand for; null without any, and then the place in the text is null too.
    pairs = F.filter(F.arrays_zip(F.col("item_values").alias("of"), F.col("values").alias("value")), lambda p: p["of"].rlike(f"^[{MARKS}]"))
    pairs = F.when(F.col("item_values").isNotNull(), F.array_sort(F.array_distinct(pairs)))
    matches = matches.select("id", "item", "item_at", (F.col("at") - F.col("item_at")).alias("shift"), "width", pairs.alias("pairs"))
    matches = stored(matches.distinct(), "matches")

    line = ["id", "item", "shift"]

    def apart(rows: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
        """A semi or anti join by ``keys``, of which only the id may be null."""
        other = other.select(*(F.col(k).alias(f"b_{k}") for k in keys))
        same = F.col("id").eqNullSafe(F.col("b_id"))
        for k in keys[1:]:
            same &= F.col(k) == F.col(f"b_{k}")
        return rows.join(other, same, how)

    slots = matches.filter("pairs IS NOT NULL").select(*line, F.inline("pairs"))
    broken = slots.groupBy(*line, "of").agg(F.min("value").alias("low"), F.max("value").alias("high")).filter("low != high")
    held = matches.filter("pairs IS NOT NULL").select(*line, "item_at", "pairs", F.inline("pairs"))
    lost = apart(held, broken.select(*line, "of"), [*line, "of"], "left_semi").select(*line, "item_at", "pairs").distinct()
    good = apart(matches, lost, [*line, "item_at", "pairs"], "left_anti")

    places = good.groupBy("id", "item").agg(F.sort_array(F.collect_set("item_at")).alias("places"), F.max("width").alias("width"))
    gained = F.transform("places", lambda p, k: F.least("width", F.coalesce(F.get("places", k + 1) - p, F.col("width"))))
    covered = F.aggregate(gained, F.lit(0).cast("long"), lambda total, x: total + x)
    sized = items.select(F.col("id").alias("item"), "size", "ids")
    hits = places.withColumn("covered", covered).join(sized, "item").filter(100 * F.col("covered") >= percent * F.col("size"))
    return hits.groupBy("id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items"), F.max("covered").alias("covered")
    )
