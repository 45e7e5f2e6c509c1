"""The jobs: normalise change messages, keep tables in sync, relay messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import model as M
from tidemark.model import ROW_ID
from tidemark.operators import envelope, identity, keyed, split, typed
from tidemark.plans.keyed_table import KeyedTable
from tidemark.plans.table_log import TableLog
from tidemark.plans.tables import TablePlan
from tidemark.sources import messages as msg
from tidemark.streaming import counters

Trigger = Mapping[str, object]
# Runs what has arrived and stops; for continuous runs pass for example {"processingTime": "1 second"}.
AVAILABLE_NOW: Trigger = {"availableNow": True}


def row_changes(
    messages: DataFrame,
    *,
    on_bad: str = "quarantine",
    split_order: str = "delete_first",
    strict_ops: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Messages to row changes: read, identify, drop schema changes, split updates. No shuffle."""
    changes = envelope.parse_changes(messages, on_bad=on_bad, strict_ops=strict_ops, exact=exact)
    return split.split_updates(identity.add_row_ids(envelope.drop_ddl(changes)), order=split_order)


def normalise(messages: DataFrame, **how) -> DataFrame:
    """Source messages to target messages, topic ``x`` to ``target-x``."""
    topic = F.concat_ws("-", F.lit(M.TARGET_PREFIX), "topic")
    return split.to_messages(row_changes(messages, **how), topic)


def start_normaliser(
    source: DataFrame,
    fmt: str,
    checkpoint: str,
    *,
    path: str | None = None,
    quarantine: str | None = None,
    options: Mapping[str, str] | None = None,
    trigger: Trigger = AVAILABLE_NOW,
    topics: Sequence[str] = (),
    on_bad: str = "quarantine",
    split_order: str = "delete_first",
    strict_ops: bool = False,
    exact: bool = False,
) -> StreamingQuery:
    """Normalise a stream of many topics in one query. An empty topic list means all.

    With ``exact`` the images that go out have all digits of their numbers; ids are the same either way.

    Messages that cannot be used go to the ``quarantine`` folder, a folder per batch, with the cause:
    both outputs come from one reading of the batch, which also counts what was read and what was bad, by cause
    (see ``counters``). Without such a folder, choose another ``on_bad``. A batch that is run again writes its messages again, at least once.
    """
    chosen = source.filter(F.col("topic").isin(*topics)) if topics else source
    if on_bad != "quarantine":
        rows = normalise(chosen, on_bad=on_bad, split_order=split_order, strict_ops=strict_ops, exact=exact)
        return msg.stream_messages(rows, fmt, checkpoint, path=path, options=options, trigger=trigger)
    if quarantine is None:
        raise ValueError("name a folder for messages that cannot be used, or choose on_bad")
    flagged = envelope.parse_changes(chosen, on_bad="flag", strict_ops=strict_ops, exact=exact)
    bad = {f"bad_{r}": F.count_if(F.col("reason") == r) for r in envelope.REASONS}
    flagged = counters.counted(flagged, "messages", read=F.count(F.lit(1)), **bad)
    # The text of a good message is not held beside its images.
    flagged = flagged.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = envelope.drop_ddl(held.filter("reason IS NULL").drop("reason", "value"))
            split_rows = split.split_updates(identity.add_row_ids(good), order=split_order)
            topic = F.concat_ws("-", F.lit(M.TARGET_PREFIX), "topic")
            msg.write_messages(split.to_messages(split_rows, topic), fmt, path=path, options=options)
            bad = held.filter("reason IS NOT NULL").select("topic", "pos", "value", "reason")
            bad.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        finally:
            held.unpersist()

    writer = flagged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def start_quarantine(
    source: DataFrame, path: str, checkpoint: str, *, trigger: Trigger = AVAILABLE_NOW
) -> StreamingQuery:
    """Keep only the messages that cannot be used, with the cause, as Parquet."""
    bad = envelope.quarantined(source)
    writer = bad.writeStream.format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_relay(
    source: DataFrame,
    topic: str,
    fmt: str,
    checkpoint: str,
    *,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Copy messages unchanged to another topic."""
    copied = source.withColumn("topic", F.lit(topic))
    return msg.stream_messages(copied, fmt, checkpoint, path=path, options=options, trigger=trigger)


def with_order(rows: DataFrame) -> DataFrame:
    """``rows``, stopped at one without its place in the order: the last of two changes could not be told."""
    lost = {c: F.raise_error(F.lit(f"a change without {c}: this source does not keep the order")) for c in M.ORDER}
    return rows.withColumns({c: F.coalesce(F.col(c), lost[c].cast(rows.schema[c].dataType)) for c in M.ORDER})


def row_key() -> Column:
    """The row id of a decoded change: the message key, and only without one the image is searched for it."""
    return F.coalesce("key", F.get_json_object("image", f"$.{ROW_ID}"))


def table_changes(decoded: DataFrame, schema: T.StructType, *, exact: bool = False) -> DataFrame:
    """Decoded row changes of one table as typed changes, without those that have no key.

    ``exact`` says that the images were decoded with all digits. ``bad_cells`` counts the cells of a row that
    did not fit, ``lossy_cells`` those that lost digits. A change without its place in the order stops
    the job: the last of two changes could not be told.
    """
    ops = F.when(F.col("kind").startswith("+"), M.INSERT).otherwise(M.DELETE)
    keyed_rows = keyed.drop_null_keys(decoded.withColumns({ROW_ID: row_key(), "op": ops}))
    # A delete needs no more than its key, so only inserts have an image to parse.
    keyed_rows = keyed_rows.withColumn("image", F.when(F.col("op") == M.INSERT, F.col("image")))
    return typed.typed_rows(with_order(keyed_rows), schema, keep=(ROW_ID, "op", *M.ORDER), exact="image" if exact else None)


def start_log_sync(
    source: DataFrame,
    log: TableLog,
    checkpoint: str,
    *,
    run: str,
    topics: Sequence[str] = (),
    trigger: Trigger = AVAILABLE_NOW,
    on_bad: str = "fail",
) -> StreamingQuery:
    """Keep one log in step with the target messages of any number of tables; an empty topic list means all.

    A batch is decoded once, held, and written by two jobs: the changes of all tables to the log, and those without
    a row id or, with ``on_bad="keep"``, that are no row change, as they came, to ``rejected/run=/batch=`` beside
    it. Neither grows with the number of tables. What was read and rejected is counted (see ``counters``). ``run`` is as in :func:`start_table_sync`.
    """
    mine = source.filter(F.col("topic").isin(*topics)) if topics else source
    decoded = split.decode_changelog(mine, on_bad=on_bad, exact=True)
    known = F.col("kind").isNotNull()
    decoded = counters.counted(
        decoded, "changes", read=F.count(F.lit(1)), no_change=F.count_if(~known), null_keys=F.count_if(known & row_key().isNull())
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        held = batch.withColumn(ROW_ID, F.when(F.col("kind").isNotNull(), row_key())).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rejected = held.filter(F.col(ROW_ID).isNull()).select("topic", "key", "kind", "image", *M.ORDER)
            rejected.write.mode("overwrite").parquet(f"{log.path}/rejected/run={run}/batch={batch_id}")
            op = F.when(F.col("kind").startswith("+"), M.INSERT).otherwise(M.DELETE)
            placed = with_order(held.filter(F.col(ROW_ID).isNotNull()).withColumn("op", op))
            log.append(placed, run=run, batch=batch_id)
        finally:
            held.unpersist()

    writer = decoded.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def start_table_sync(
    source: DataFrame,
    plans: Sequence[TablePlan],
    warehouse: str,
    checkpoint: str,
    *,
    run: str,
    trigger: Trigger = AVAILABLE_NOW,
    on_bad: str = "fail",
    buckets: int = 8,
    writers: int = 4,
    exact: bool = False,
) -> StreamingQuery:
    """Keep the keyed tables of all plans in step with one stream of target messages.

    A batch is decoded once and held in the partitions it came in, so a topic with most of the batch is
    as spread as the batch; each table then reads its part, several tables at a time. ``run`` names this
    checkpoint's batches: keep it for as long as the checkpoint lives, take a new one with a new checkpoint.

    Changes without a row id, and with ``on_bad="keep"`` messages that are no row change, are kept as they
    came in ``rejected/run=/batch=`` of the warehouse. Cells that did not fit are counted in the tables.
    """
    topics = [p.target_topic for p in plans]
    mine = source.filter(F.col("topic").isin(*topics))
    decoded = split.decode_changelog(mine, on_bad=on_bad, exact=exact)

    def apply(batch: DataFrame, batch_id: int) -> None:
        held = batch.withColumn("_usable", F.col("kind").isNotNull() & row_key().isNotNull())
        held = held.persist(StorageLevel.MEMORY_AND_DISK)

        def write(plan: TablePlan) -> None:
            part = held.filter(F.col("_usable") & (F.col("topic") == plan.target_topic))
            table = KeyedTable(f"{warehouse}/{plan.keyed_table}", plan.schema, buckets)
            table.append(table_changes(part, plan.schema, exact=exact), run=run, batch=batch_id)

        try:
            present = {r.topic for r in held.select("topic").distinct().collect()}
            rejected = held.filter("NOT _usable").select("topic", "key", "kind", "image", *M.ORDER)
            rejected.write.mode("overwrite").parquet(f"{warehouse}/rejected/run={run}/batch={batch_id}")
            with ThreadPoolExecutor(writers) as pool:
                list(pool.map(write, [p for p in plans if p.target_topic in present]))
        finally:
            held.unpersist()

    writer = decoded.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()
