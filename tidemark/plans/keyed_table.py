"""A keyed table on plain Parquet: a log of typed changes, read as the last change per key.

Every read takes the last change of each key, so a change that is there twice does no harm: a batch that
is written again replaces itself, a replayed one changes nothing. Nothing is ever deleted. A table that
has grown too long is rewritten into a new folder, which the caller then opens instead; readers of the
old folder, batch or stream, are not disturbed. Small files are packed into larger ones beside them; the list of
replaced files then hides those from batch readers, in one step.

Deletes lie in folders of their own, so a filter on columns skips row groups of the other files, and files have
Bloom filters on the id.

Where a table format with row-level changes is installed, use :func:`merge_into` instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import model as M
from tidemark.model import ROW_ID
from tidemark.operators import keyed

_CHANGE_FIELDS = T.StructType(
    [
        T.StructField("op", T.StringType()),
        T.StructField("scn", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("bad_cells", T.IntegerType()),
        T.StructField("lossy_cells", T.IntegerType()),
    ]
)
_COUNTERS = ("bad_cells", "lossy_cells")
_PLACE = ("kind", "bucket", "run", "batch")
#: Folders of rows, and of deletes.
ROWS, GONE = "row", "gone"
#: Runs that repack what others have written.
PACKED = "pack-"


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key. Same function as Spark's hash partitioning, see ``KeyedTable``."""
    return F.pmod(F.hash(key), F.lit(buckets))


@dataclass(frozen=True)
class KeyedTable:
    """A keyed table in a folder.

    ``log/`` has what the batches wrote, as ``kind=/bucket=/run=/batch=``. ``buckets`` says how a batch is
    laid out and should divide ``spark.sql.shuffle.partitions``: then a partition shuffled by key belongs
    to one bucket, and a batch writes one file per partition. Reads do not depend on it.

    ``content_ids`` promises that every row id is a hash of the row. Leave it out where images may bring
    an id of their own.

    ``ranges`` names columns whose smallest and largest value in each file are kept in ``ranges/``, so that
    :meth:`planned_files` knows which files a range can concern without opening any. ``cluster_by`` sorts rows inside a
    batch's files by columns before the id, so that their ranges and those of row groups are narrow.
    """

    path: str
    schema: T.StructType
    buckets: int = 8
    content_ids: bool = False
    ranges: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()

    @property
    def stored(self) -> T.StructType:
        """Columns of the files, folders included."""
        place = [
            T.StructField("kind", T.StringType()),
            T.StructField("bucket", T.IntegerType()),
            T.StructField("run", T.StringType()),
            T.StructField("batch", T.LongType()),
        ]
        return T.StructType([*self.schema.fields, *_CHANGE_FIELDS.fields, *place])

    def append(self, changes: DataFrame, *, run: str, batch: int) -> None:
        """Add a batch of typed changes; the same ``run`` and ``batch`` again replaces it.

        Only the last change per key of the batch is kept, cut down before the shuffle. A delete
        needs no more than its key. ``bad_cells`` and ``lossy_cells``, if there, are kept with the row.
        Rows without a key must be gone before.

        A table whose old deletes have retired (see :meth:`rewrite`) refuses a batch with an older change: it could
        bring back a row that a forgotten delete had removed.
        """
        since = self.since(changes.sparkSession)
        if since is not None:
            said = F.concat(F.lit(f"deletes before {since} have retired, a change of "), F.col("scn"), F.lit(" is too late"))
            changes = changes.withColumn("scn", F.when(F.col("scn") < since, F.raise_error(said).cast("bigint")).otherwise(F.col("scn")))
        latest = keyed.latest_changes(_with_counters(changes))
        tombstone = F.col("op") == M.DELETE
        columns = [
            F.when(~tombstone, F.col(f.name)).alias(f.name) if f.name != ROW_ID else F.col(ROW_ID)
            for f in self.schema.fields
        ]
        placed = latest.select(
            *columns,
            *_CHANGE_FIELDS.names,
            F.when(tombstone, GONE).otherwise(ROWS).alias("kind"),
            bucket_of(F.col(ROW_ID), self.buckets).alias("bucket"),
            F.lit(run).alias("run"),
            F.lit(batch).cast("bigint").alias("batch"),
        )
        writer = self._ordered(placed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        self._indexed(writer).partitionBy(*_PLACE).parquet(f"{self.path}/log")
        if self.ranges:
            written = self._log(changes.sparkSession).filter((F.col("run") == run) & (F.col("batch") == batch))
            self._keep_ranges(written, f"{run}-{batch}")

    def changes(self, spark: SparkSession) -> DataFrame:
        """All change rows, deletes included."""
        replaced = self.replaced(spark)
        rows = self._log(spark)
        # A condition on the path alone: Spark leaves such files out of the scan.
        return rows.filter(~F.col("_metadata.file_path").isin(*replaced)) if replaced else rows

    def _log(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(self.stored).parquet(f"{self.path}/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self.stored)

    def _beside(self, spark: SparkSession, folder: str, schema: str) -> DataFrame | None:
        try:
            return spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def replaced(self, spark: SparkSession) -> list[str]:
        """Files whose rows packed files hold: nothing reads them but streams, and they may go once no reader is left."""
        found = self._beside(spark, "replaced", "file_path string")
        return sorted(r.file_path for r in found.collect()) if found else []

    def since(self, spark: SparkSession) -> int | None:
        """The commit number before which deletes have retired."""
        found = self._beside(spark, "since", "scn bigint")
        return found.agg(F.max("scn")).first()[0] if found else None

    def _ordered(self, placed: DataFrame) -> DataFrame:
        # Sorted by key inside a file, so key statistics of row groups are narrow.
        return placed.sortWithinPartitions(*_PLACE, *self.cluster_by, ROW_ID)

    @staticmethod
    def _indexed(writer: DataFrameWriter) -> DataFrameWriter:
        # As large as a file's ids need, not the largest size for any.
        return writer.option(f"parquet.bloom.filter.enabled#{ROW_ID}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")

    def _keep_ranges(self, written: DataFrame, name: str) -> None:
        ends = [f(c).cast("string").alias(f"{n}_{c}") for c in self.ranges for n, f in (("min", F.min), ("max", F.max))]
        by_file = written.filter(F.col("kind") == ROWS).groupBy(F.col("_metadata.file_path").alias("file_path"))
        found = by_file.agg(F.count("*").alias("rows"), *ends)
        found.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ranges/of={name}")

    def planned_files(self, spark: SparkSession, column: str, low: object, high: object) -> DataFrame:
        """Files that may hold rows whose ``column`` is from ``low`` to ``high``, from the kept ranges: no file of rows is opened.

        Nulls are in no range. Needs ``column`` in ``ranges`` from the first batch on.
        """
        if column not in self.ranges:
            raise ValueError(f"no ranges of {column} are kept")
        kind = self.schema[column].dataType
        ends = ", ".join(f"min_{c} string, max_{c} string" for c in self.ranges)
        found = self._beside(spark, "ranges", f"file_path string, rows bigint, {ends}")
        if found is None:
            return spark.createDataFrame([], "file_path string, rows bigint")
        least, most = F.col(f"min_{column}").cast(kind), F.col(f"max_{column}").cast(kind)
        replaced = self.replaced(spark)
        meets = found.filter((most >= F.lit(low).cast(kind)) & (least <= F.lit(high).cast(kind)))
        meets = meets.filter(~F.col("file_path").isin(*replaced)) if replaced else meets
        return meets.select("file_path", "rows")

    def current(self, spark: SparkSession) -> DataFrame:
        """The rows that exist now."""
        return keyed.current_rows(self.changes(spark)).select(*self.schema.names)

    def save_current(self, spark: SparkSession, name: str) -> DataFrame:
        """The current rows as a new table of Spark's own, bucketed and sorted by id.

        Joins and aggregations by id over it need no shuffle.
        """
        writer = self.current(spark).write.bucketBy(self.buckets, ROW_ID).sortBy(ROW_ID)
        writer.mode("errorifexists").saveAsTable(name)
        return spark.table(name)

    def where(self, spark: SparkSession, predicate: Column) -> DataFrame:
        """The rows that exist now and meet a predicate.

        With ``content_ids`` all versions of an id agree on the predicate, so it reaches the file scan:
        it runs before the last change is chosen, as long as the deletes stay. Otherwise an id may have
        met it in an older version only, and it runs after.
        """
        versions = self.changes(spark)
        if self.content_ids:
            # Two scans: the one of the rows has nothing but the predicate to meet, so row groups are skipped.
            rows = versions.filter((F.col("kind") == ROWS) & predicate)
            versions = rows.unionByName(versions.filter(F.col("kind") == GONE))
        return keyed.current_rows(versions).filter(predicate).select(*self.schema.names)

    def by_key(self, spark: SparkSession, key: str) -> DataFrame:
        """The row with a given id. Statistics and Bloom filters of the id skip all but a few row groups."""
        rows = self.changes(spark).filter(F.col(ROW_ID) == key)
        return keyed.current_rows(rows).select(*self.schema.names)

    def files_with(self, spark: SparkSession, predicate: Column) -> DataFrame:
        """Files that hold rows meeting a predicate."""
        found = self.changes(spark).filter(predicate)
        return found.select(F.col("_metadata.file_path").alias("file_path")).distinct()

    def stream(self, spark: SparkSession, **options: str) -> DataFrame:
        """New change rows as batches land. Deletes come as rows with ``op`` d and only the key.

        A reader that starts on a rewritten table gets the last change of every key first. Packed files bring
        nothing new and are left out.
        """
        reader = spark.readStream.schema(self.stored).options(**options)
        return reader.parquet(f"{self.path}/log").filter(~F.col("run").startswith(PACKED))

    def pack(self, spark: SparkSession, *, target_bytes: int = 256 << 20, writers: int = 5) -> int:
        """Put small files together into files of about ``target_bytes``; returns how many were replaced.

        Only files smaller than that are read, bin by bin: first fit, largest first, inside each folder of rows or deletes
        and bucket. At most ``writers`` tasks write. A packed file has one change per key, the last of its bin, so
        nothing that other files hold is decided here, and deletes stay. Readers see the old files until the list of
        replaced files is written, then the new ones; a run that breaks off before has changed nothing they see.
        The driver holds the names and sizes of the files.
        """
        place = ("kind", "bucket")
        meta = [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("size")]
        files = self.changes(spark).select(*place, *meta).distinct().collect()
        bins = [b for b in _first_fit([((r.kind, r.bucket), r.size, r.file_path) for r in files if r.size < target_bytes], target_bytes) if len(b) > 1]
        if not bins:
            return 0
        of = [(path, i) for i, b in enumerate(bins) for path in b]
        paths = [path for path, _ in of]
        packing = spark.createDataFrame(of, "packed_path string, bin bigint")
        read = spark.read.schema(self.stored).option("basePath", f"{self.path}/log").parquet(*paths)
        rows = read.withColumn("packed_path", F.col("_metadata.file_path")).join(F.broadcast(packing), "packed_path")
        run = f"{PACKED}{uuid.uuid4().hex}"
        latest = keyed.latest_changes(rows, key=("bin", ROW_ID))
        placed = latest.withColumns({"run": F.lit(run), "batch": F.col("bin")}).select(*self.stored.names)
        spread = placed.repartition(min(writers, len(bins)), "batch")
        self._indexed(self._ordered(spread).write.mode("append")).partitionBy(*_PLACE).parquet(f"{self.path}/log")
        if self.ranges:
            self._keep_ranges(self._log(spark).filter(F.col("run") == run), run)
        spark.createDataFrame([(p,) for p in paths], "file_path string").coalesce(1).write.mode("append").parquet(f"{self.path}/replaced")
        return len(paths)

    def rewrite(
        self, spark: SparkSession, target: str, *, buckets: Sequence[int] | None = None, retire_before: int | None = None
    ) -> KeyedTable:
        """The table with one change per key, in a new folder that must not exist; nothing is deleted.

        With ``buckets`` only those are cut to one change per key, the others are copied as they are.
        Deletes are kept, since a late batch may hold an older insert of the key, but for those of a commit
        number below ``retire_before``: they go, in the buckets that are rewritten, and the new table refuses changes
        older than that. The folder is complete when Spark has committed it; a run that broke off left none or
        an uncommitted one, and its target is not used again.
        """
        rows = self.changes(spark)
        retired = [x for x in (self.since(spark), retire_before) if x is not None]
        if retired:
            # First of all: a table that has lost deletes must know it.
            spark.createDataFrame([(max(retired),)], "scn bigint").coalesce(1).write.mode("errorifexists").parquet(f"{target}/since")
        latest, others = rows, None
        if buckets is not None:
            latest, others = rows.filter(F.col("bucket").isin(*buckets)), rows.filter(~F.col("bucket").isin(*buckets))
        latest = keyed.latest_changes(latest)
        if retire_before is not None:
            latest = latest.filter((F.col("op") != M.DELETE) | (F.col("scn") >= retire_before))
        latest = latest if others is None else latest.unionByName(others)
        placed = latest.withColumns({"run": F.lit("rewrite"), "batch": F.lit(0).cast("bigint")})
        self._indexed(self._ordered(placed).write.mode("errorifexists")).partitionBy(*_PLACE).parquet(f"{target}/log")
        table = replace(self, path=target)
        if self.ranges:
            table._keep_ranges(table._log(spark), "rewrite")
        return table


def _first_fit(files: Iterable[tuple[tuple, int, str]], most: int) -> list[list[str]]:
    """Bins of files ``(place, size, path)``: each file, largest first, goes to the first bin of its place with room."""
    bins: dict[tuple, list[list]] = {}
    for place, size, path in sorted(files, key=lambda f: (-f[1], f[2])):
        own = bins.setdefault(place, [])
        room = next((b for b in own if b[0] + size <= most), None)
        if room is None:
            own.append(room := [0])
        room[0] += size
        room.append(path)
    return [b[1:] for own in bins.values() for b in own]


def _with_counters(changes: DataFrame) -> DataFrame:
    return changes.withColumns({c: F.lit(0) for c in _COUNTERS if c not in changes.columns})


def write_layout(
    df: DataFrame, path: str, key: str, *, buckets: int = 5, partition_by: Sequence[str] = ()
) -> None:
    """Write rows partitioned by columns or, without any, by a hash bucket of the key.

    Rows are sorted by key inside each file, nulls last. Rebalancing lets Spark split a partition
    value that holds most of the rows and merge small ones.
    """
    places = list(partition_by) or ["bucket"]
    placed = df if partition_by else df.withColumn("bucket", bucket_of(F.col(key), buckets))
    balanced = placed.hint("rebalance", *places)
    balanced.sortWithinPartitions(*places, F.asc_nulls_last(key)).write.mode("overwrite").partitionBy(
        *places
    ).parquet(path)


def merge_into(changes: DataFrame, table: str, columns: Sequence[str]) -> None:
    """Apply a batch to a table of a format with row-level changes, such as Iceberg."""
    latest = keyed.latest_changes(keyed.drop_null_keys(changes)).alias("s")
    values = {c: F.col(f"s.{c}") for c in columns}
    deleted = F.col("s.op") == M.DELETE
    (
        latest.mergeInto(table, F.col(f"{table}.{ROW_ID}") == F.col(f"s.{ROW_ID}"))
        .whenMatched(deleted)
        .delete()
        .whenMatched()
        .update(values)
        .whenNotMatched(~deleted)
        .insert(values)
        .merge()
    )
