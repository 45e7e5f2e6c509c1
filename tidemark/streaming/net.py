"""Net changes: of many changes per key and batch, what they come to.

Per key the stream remembers the order of its last change and the row it has shown. What a batch brings for a
key is put in order; the last change decides, and only the difference to what was shown goes out: ``+I``
for a new row, ``-U`` and ``+U`` for another one, ``-D`` for one that went, nothing if all is as before. Rows
sent so far, applied in order, are the current view after each batch.

A change older than the key's last one is ``late``: it changes nothing, and is passed on as such, with its own
image. The last change again is a replay and left out.

What is remembered lies in Parquet files beside the checkpoint: a batch adds the keys it has moved on, every
``SNAPSHOT_EVERY`` th batch all that is known. A batch is joined with them by key, in Spark's own operators: a Python
call per key, as grouped state in Python needs, takes milliseconds for each.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import model as M
from tidemark.model import ORDER, ROW_ID
from tidemark.session import unsorted_folders
from tidemark.streaming.jobs import AVAILABLE_NOW, Trigger, row_key, with_order

#: ``late`` beside the usual kinds of a changelog.
LATE = "late"
NET = T.StructType(
    [
        T.StructField(ROW_ID, T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("image", T.StringType()),
        *[f for f in M.MESSAGE.fields if f.name in ORDER],
    ]
)
#: A week.
KEEP_MS = 7 * 24 * 3600 * 1000
#: Batches from one list of all keys to the next.
SNAPSHOT_EVERY = 10
_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
#: What a batch stores: net rows, and per key its last change, with an image unless it is a delete.
_SENT, _LAST = "sent", "last"
_PLACE = T.StructType([T.StructField("batch", T.LongType()), T.StructField("what", T.StringType())])
_STORED = T.StructType([*NET.fields, T.StructField("at_ms", T.LongType()), *_PLACE.fields])


def net_changes(decoded: DataFrame, last: DataFrame, now_ms: int) -> DataFrame:
    """What a batch of decoded row changes (``key``, ``kind``, ``image`` and the order columns) comes to.

    ``last`` has the last change per key so far (``AUTO_MD5_ID``, ``image``, order). The result has the net rows, ``what``
    being ``sent``, and the last change of every key that the batch has moved on, ``what`` being ``last``. Changes
    without a row id are left out; the sync job keeps those. Batch and keys are put together by one shuffle each.
    """
    image = F.when(F.col("kind").startswith("+"), F.col("image"))
    rows = with_order(decoded).select(row_key().alias(ROW_ID), image.alias("image"), *ORDER).filter(F.col(ROW_ID).isNotNull())
    known = last.select(F.col(ROW_ID).alias("_id"), F.struct(*ORDER).alias("_at"), F.col("image").alias("_shown"))
    newest_first = Window.partitionBy(ROW_ID).orderBy(*[F.desc(c) for c in ORDER])
    met = rows.join(known, F.col(ROW_ID) == F.col("_id"), "left").withColumn("_rank", F.row_number().over(newest_first))
    place, at, shown = F.struct(*ORDER), F.col("_at"), F.col("_shown")

    def row(what: str, kind: Column, image: Column) -> Column:
        return F.struct(F.lit(what).alias("what"), kind.cast("string").alias("kind"), image.alias("image"))

    gone, new = F.col("image").isNull(), shown.isNull()
    moved = ~F.col("image").eqNullSafe(shown)
    decided = F.array_compact(
        F.array(
            row(_LAST, F.lit(None), F.col("image")),
            F.when(moved & ~new, row(_SENT, F.when(gone, "-D").otherwise("-U"), shown)),
            F.when(moved & ~gone, row(_SENT, F.when(new, "+I").otherwise("+U"), F.col("image"))),
        )
    )
    late = F.array(row(_SENT, F.lit(LATE), F.col("image")))
    found = F.when(at.isNotNull() & (place < at), late).when((F.col("_rank") == 1) & (at.isNull() | (place > at)), decided)
    out = met.select(F.col(ROW_ID), *ORDER, found.alias("_found")).select(ROW_ID, *ORDER, F.inline("_found"))
    return out.select(*NET.names, F.lit(now_ms).cast("bigint").alias("at_ms"), "what")


def _last_changes(spark: SparkSession, store: str, before: int, now_ms: int, keep_ms: int) -> DataFrame:
    """The last change per key of the batches before one, without deletes that are gone long enough."""
    if before == 0:
        return spark.createDataFrame([], _STORED)
    start = (before - 1) // SNAPSHOT_EVERY * SNAPSHOT_EVERY
    rows = spark.read.schema(_STORED).parquet(f"{store}/batches")
    rows = rows.filter((F.col("what") == _LAST) & F.col("batch").between(start, before - 1))
    if start:  # what was known when that batch began
        keys = spark.read.schema(_STORED).parquet(f"{store}/keys").filter(F.col("batch") == start)
        rows = rows.unionByName(keys.withColumn("batch", F.lit(-1).cast("bigint")))
    newest = Window.partitionBy(ROW_ID).orderBy(F.desc("batch"))
    rows = rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
    return rows.filter(F.col("image").isNotNull() | (F.col("at_ms") > now_ms - keep_ms))


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(_STORED).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def start_net_changes(
    decoded: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: Trigger = AVAILABLE_NOW,
    keep_deletes_ms: int = KEEP_MS,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Write the net changes of a stream of decoded row changes as Parquet, exactly once.

    A delete is remembered for ``keep_deletes_ms`` of processing time: a change that is later still is taken for a new row.

    A batch is stored in ``checkpoint/net`` in one write, replaced if it is run again before it was whole, and not
    computed again after: from there a file stream with its own checkpoint brings it to ``path``.
    """
    store = f"{checkpoint}/net"

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now_ms = int(time.time() * 1000)
        if not _exists(spark, f"{store}/whole/batch={batch_id}"):
            last = _last_changes(spark, store, batch_id, now_ms, keep_deletes_ms)
            with unsorted_folders(spark):
                net_changes(batch, last, now_ms).write.mode("overwrite").partitionBy("what").parquet(f"{store}/batches/batch={batch_id}")
            if batch_id and batch_id % SNAPSHOT_EVERY == 0:
                last.select(*NET.names, "at_ms", F.lit(_LAST).alias("what")).write.mode("overwrite").parquet(f"{store}/keys/batch={batch_id}")
            spark.createDataFrame([(batch_id,)], "batch_id bigint").coalesce(1).write.mode("overwrite").parquet(f"{store}/whole/batch={batch_id}")
        stored = spark.readStream.schema(_STORED).parquet(f"{store}/batches").filter(F.col("what") == _SENT).select(*NET.names)
        copy = stored.writeStream.format("parquet").option("path", path).options(**(options or {}))
        copy.option("checkpointLocation", f"{store}/copy").trigger(availableNow=True).start().awaitTermination()

    return decoded.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**trigger).start()
