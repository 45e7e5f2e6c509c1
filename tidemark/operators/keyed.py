"""The current rows of a keyed table out of its changes."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark import model as M
from tidemark.model import ORDER, ROW_ID


def drop_null_keys(df: DataFrame, *, key: str = ROW_ID, seen: Observation | None = None) -> DataFrame:
    """Leave out rows without a key; ``seen`` counts ``rows`` and ``null_keys`` on the way."""
    if seen is not None:
        df = df.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("null_keys")
        )
    return df.filter(F.col(key).isNotNull())


def latest_changes(
    changes: DataFrame, *, key: Sequence[str] = (ROW_ID,), order: Sequence[str] = ORDER
) -> DataFrame:
    """The last change of every key.

    A rank filter rather than ``max_by``: Spark cuts each map task's rows to one per key before
    the shuffle, so a key with a third of all changes sends one row per task, and columns nobody
    asks for are not read.
    """
    newest_first = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order])
    ranked = changes.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


COPIES = "copies"
#: Equal rows that one task makes out of a count at once.
COPIES_PER_TASK = 10_000


def copies_as_rows(counted: DataFrame, copies: str) -> DataFrame:
    """Every row as often as its count says, not at all below one.

    A row that occurs very often is cut into shares that go to different tasks, so none makes more than
    ``COPIES_PER_TASK`` of it.
    """
    share = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(copies) - 1) / COPIES_PER_TASK)))
    shares = counted.filter(F.col(copies) > 0).withColumn("_share", share)
    size = F.least(F.lit(COPIES_PER_TASK).cast("bigint"), F.col(copies) - F.col("_share") * COPIES_PER_TASK)
    spread = shares.withColumn("_size", size).hint("rebalance")
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size"))).alias("_copy")
    return spread.select(*[c for c in counted.columns if c != copies], each).drop("_copy")


def current_multiset(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows that exist now, equal rows as often as they were inserted and not deleted: an id's inserts less its deletes."""
    return copies_as_rows(signed_counts(changes, columns), COPIES)


def signed_counts(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per id: ``columns`` of an insert, or null if there is none, and the inserts less the deletes."""
    deleted = F.col("op") == M.DELETE
    image = F.when(~deleted, F.struct(*columns))
    sign = F.when(deleted, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    # A row's columns travel as one: a sum by sorting handles each column of its own at several times the cost. Few changes are
    # there twice, so they are dealt by the whole key without being sorted first, and come out in the order of ids for the next sum.
    rows = changes.select(ROW_ID, *ORDER, image.alias("_row"), sign.alias(COPIES))
    once = rows.repartition(ROW_ID, *ORDER).dropDuplicates([ROW_ID, *ORDER])
    return _summed(once).select(ROW_ID, "_row.*", COPIES)


def merged_counts(counted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per id out of the signed counts of several batches."""
    known = functools.reduce(Column.__or__, (F.col(c).isNotNull() for c in columns))
    rows = counted.select(ROW_ID, F.when(known, F.struct(*columns)).alias("_row"), COPIES)
    return _summed(rows).select(ROW_ID, "_row.*", COPIES)


def _summed(rows: DataFrame) -> DataFrame:
    # Rows of one id are equal, so any insert's columns will do.
    return rows.groupBy(ROW_ID).agg(F.first("_row", ignorenulls=True).alias("_row"), F.sum(COPIES).alias(COPIES))


def current_rows(
    changes: DataFrame, *, key: Sequence[str] = (ROW_ID,), order: Sequence[str] = ORDER
) -> DataFrame:
    """The rows that exist now: the last change of every key, unless it is a delete."""
    return latest_changes(changes, key=key, order=order).filter(F.col("op") != M.DELETE)
