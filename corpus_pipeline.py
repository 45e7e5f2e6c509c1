"""The corpus pipeline: from documents to token ids, in five stages.

Each stage is a function of (spark, docs, sf_dir) and works on what the stage before it has kept. All but the
last return the columns of ``documents``. Between stages rows are written as Parquet and read again, so
a lost executor costs no finished stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, minhash, sentencepiece, suffix
from tidemark.llm.common import read_table, stored, with_text_key

#: Below this cosine a text of enough letters has next to no letter groups in common with any language. Of fewer
#: letters, counted over its distinct words, nothing is said: chance moves a cosine by 0.03, and a few groups are no more.
LEAST_SCORE, LEAST_LETTERS = 0.05, 200


def _rest(docs: DataFrame) -> Column:
    """All columns but the text in one, out of the way of columns that an operator adds."""
    return F.struct(*(c for c in docs.columns if c != "text")).alias("rest")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those without a letter, or long and like none of them, go."""
    profiles = language.learn(docs, "text", "lang")
    found = language.predict(docs.select(_rest(docs), "text"), "text", profiles)
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    letters = F.aggregate(words, F.lit(0), lambda total, w: total + F.length(w))
    like = (F.col("score") >= LEAST_SCORE) | (letters < LEAST_LETTERS)
    kept = found.filter((F.col("lang_pred") != language.UNKNOWN) & like)
    return kept.select(*(F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, 80 %; and one row of each id and text."""
    found = stored(minhash.near_duplicates(docs, "doc_id", "text"), "groups")
    which = ["doc_id", "text_hash"]
    named = found.select(F.col("id").alias("doc_id"), "text_hash", "kept")
    rows = docs.withColumn("text_hash", F.xxhash64("text"))
    again = stored(named.filter("doc_id IS NOT NULL").groupBy(which).count().filter("count > 1").select(which), "again")
    rows = rows.join(named.filter("NOT kept").select(which), which, "left_anti")
    if not again.isEmpty():
        once = rows.join(again, which, "left_semi").dropDuplicates(which)
        rows = rows.join(again, which, "left_anti").unionByName(once)
    return rows.select(docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 200 bytes and more that occur elsewhere."""
    rows = docs.select(_rest(docs), "doc_id", "text")
    left = suffix.remove_repeats(rows, "doc_id", "text", decode=True)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return left.select(*(new[c].alias(c) if c in new else F.col("rest")[c].alias(c) for c in docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, nor one with other numbers or names."""
    items = read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    keyed, _ = with_text_key(docs, "doc_id", "text", "text_key")
    keyed = keyed.withColumn("text_key", F.coalesce("text_key", F.xxhash64("text")))
    found = stored(decontaminate.contaminated(keyed, "text_key", "text", items, "item_id", "text"), "leaks")
    return keyed.join(found, keyed["text_key"] == found["id"], "left_anti").select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = sentencepiece.encode(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", model, decode=True)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.col("text")).alias("same_text")
    )


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("repeated_passages", without_repeats),
    ("decontamination", without_benchmark),
    ("encoding", encoded),
]

#: No SQL expresses the MinHash, suffix and SentencePiece stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
