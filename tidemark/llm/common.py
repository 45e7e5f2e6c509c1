"""Helpers shared by the operators: tables, stored intermediate results, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there.

    A lost executor then costs no more than the tasks it ran: what was written stays. The write's shuffle
    files go as soon as it is done, since nothing reads them again.
    """
    spark = df.sparkSession
    folder = work_dir(spark, purpose)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(folder)
    out._stored_in = folder
    return out


def dropped(df: DataFrame) -> None:
    """Remove what :func:`stored` wrote, once all that is computed from it is stored itself."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(df._stored_in)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(df: DataFrame, rows: int = 500) -> DataFrame:
    """``df``, in a session that sends at most ``rows`` rows to Python at once.

    Spark's batches are bounded by rows alone; ten thousand long texts at once would not fit beside
    others in an executor. A smaller setting of the session stays.
    """
    conf = df.sparkSession.conf
    now = int(conf.get(BATCH_ROWS, "10000"))
    if not 0 < now <= rows:
        conf.set(BATCH_ROWS, str(rows))
    return df


def text_of(column: str) -> Column:
    """A text column, null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def id_part(column: str, parts: int) -> Column:
    """The remainder that splits rows for learning and holding out: crc32 of the id as text. A null id gives -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts, F.lit(-1))


def with_text_key(df: DataFrame, record_id: str, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with the column ``key``, a long of every document, and the ids that several texts share.

    The key is the id; where rows share an id but not the text, a hash of both. Null where the id is null.
    """
    own, other = F.col(record_id).cast("long"), f"{key}_shared"
    found = df.select(own.alias(other), F.xxhash64(text).alias("hash")).filter(F.col(other).isNotNull())
    found = found.groupBy(other).agg(F.min("hash").alias("low"), F.max("hash").alias("high"))
    shared = stored(found.filter("low != high").select(other), "shared-ids")
    rows = df.join(shared, own == F.col(other), "left")
    return rows.withColumn(key, F.when(F.col(other).isNull(), own).otherwise(F.xxhash64(own, text))).drop(other), shared


def parts_of(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``most`` bytes of a text column; a longer row is a slice of its own."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        begin = size = 0
        for i in range(batch.num_rows):
            more = len(texts[i].as_buffer() or b"") if texts[i].is_valid else 0
            if i > begin and size + more > most:
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += more
        if batch.num_rows > begin:
            yield batch.slice(begin)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]
