"""One log for all tables: row changes as variants, written by one job per batch however many tables there are.

The log lies in ``path/table=/bucket=/run=/batch=``, a table being named by its topic. A row keeps what its image
said, each number with up to 38 digits, and gets its column types when it is read: a table can be read under a
new type map without being written again, and a table nobody has planned yet loses nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import model as M
from tidemark.model import ORDER, ROW_ID
from tidemark.operators import keyed, typed
from tidemark.plans.keyed_table import bucket_of

_PLACE = ("table", "bucket", "run", "batch")


@dataclass(frozen=True)
class TableLog:
    """Row changes of many tables; every read takes the last change per table and key."""

    path: str
    buckets: int = 8

    @property
    def stored(self) -> T.StructType:
        order = [f for f in M.MESSAGE.fields if f.name in ORDER]
        return T.StructType(
            [
                T.StructField(ROW_ID, T.StringType()),
                T.StructField("op", T.StringType()),
                *order,
                T.StructField("row", T.VariantType()),
                T.StructField("table", T.StringType()),
                T.StructField("bucket", T.IntegerType()),
                T.StructField("run", T.StringType()),
                T.StructField("batch", T.LongType()),
            ]
        )

    def append(self, changes: DataFrame, *, run: str, batch: int) -> None:
        """Add a batch of changes ``(topic, AUTO_MD5_ID, op, order, image)``; the same ``run`` and ``batch`` again replaces it.

        The batch is cut to one change per table and key before the shuffle. Then tables and buckets are put together,
        where Spark splits a table with most of the rows and merges small ones, so a batch makes about one file for
        each table and bucket that it touches.
        """
        latest = keyed.latest_changes(changes, key=("topic", ROW_ID))
        row = F.when(F.col("op") != M.DELETE, F.try_parse_json("image"))
        placed = latest.select(
            ROW_ID, "op", *ORDER, row.alias("row"), F.col("topic").alias("table"),
            bucket_of(F.col(ROW_ID), self.buckets).alias("bucket"),
            F.lit(run).alias("run"), F.lit(batch).cast("bigint").alias("batch"),
        )
        ordered = placed.hint("rebalance", "table", "bucket").sortWithinPartitions(*_PLACE, ROW_ID)
        writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*_PLACE).parquet(f"{self.path}/log")

    def changes(self, spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
        """All change rows of a table, typed; deletes have their key only. Other tables' files are not read."""
        try:
            log = spark.read.schema(self.stored).parquet(f"{self.path}/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            log = spark.createDataFrame([], self.stored)
        return typed.typed_variants(log.filter(F.col("table") == table), schema, keep=(ROW_ID, "op", *ORDER))

    def current(self, spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
        """The rows of a table that exist now."""
        return keyed.current_rows(self.changes(spark, table, schema)).select(*schema.names)
