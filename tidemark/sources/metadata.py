"""The source database's dictionary: its tables and their columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One row per source column, the form every plan is made from.
COLUMN_METADATA = T.StructType(
    [
        T.StructField("owner", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("class_name", T.StringType()),
        T.StructField("precision", T.IntegerType()),
        T.StructField("scale", T.IntegerType()),
    ]
)

# The dictionary views that list tables and columns.
TABLES_VIEW = "DBA_TABLES"
COLUMNS_VIEW = "DBA_TAB_COLUMNS"

# Pattern of a column type in that view, and the class its driver reports.
CLASS_OF_TYPE = (
    ("^TIMESTAMP.* WITH LOCAL TIME ZONE$", "oracle.sql.TIMESTAMPLTZ"),
    ("^TIMESTAMP.* WITH TIME ZONE$", "oracle.sql.TIMESTAMPTZ"),
    ("^TIMESTAMP", "oracle.sql.TIMESTAMP"),
    ("^DATE$", "java.sql.Timestamp"),
    ("^(NUMBER|FLOAT)$", "java.math.BigDecimal"),
    ("^BINARY_FLOAT$", "java.lang.Float"),
    ("^BINARY_DOUBLE$", "java.lang.Double"),
    ("^NCLOB$", "oracle.jdbc.OracleNClob"),
    ("^CLOB$", "oracle.jdbc.OracleClob"),
    ("^BLOB$", "oracle.jdbc.OracleBlob"),
    ("^INTERVAL YEAR", "oracle.sql.INTERVALYM"),
    ("^INTERVAL DAY", "oracle.sql.INTERVALDS"),
    ("^(RAW|LONG RAW)$", "[B"),
)
OTHER_CLASS = "java.lang.String"


def jdbc_tables(spark: SparkSession, options: Mapping[str, str], owners: Sequence[str]) -> DataFrame:
    """Tables of the given owners from the database. The owner filter runs in the database."""
    listing = spark.read.format("jdbc").options(**options).option("dbtable", TABLES_VIEW).load()
    renamed = listing.select(F.col("OWNER").alias("owner"), F.col("TABLE_NAME").alias("table_name"))
    return list_tables(renamed, owners)


def jdbc_columns(spark: SparkSession, options: Mapping[str, str], owners: Sequence[str]) -> DataFrame:
    """Column metadata of the given owners' tables from the database. The owner filter runs there."""
    view = spark.read.format("jdbc").options(**options).option("dbtable", COLUMNS_VIEW).load()
    return column_metadata(view.filter(F.col("OWNER").isin(*owners)))


def column_metadata(view: DataFrame) -> DataFrame:
    """The dictionary's column view as ``COLUMN_METADATA``, from which plans are made.

    The class is the one the database's driver reports for a column type. A number without precision is
    reported with precision 0 and scale -127, a float with its binary precision and that scale.
    """
    kind = F.upper(F.trim("DATA_TYPE"))
    name = F.lit(OTHER_CLASS)
    for pattern, class_name in reversed(CLASS_OF_TYPE):
        name = F.when(kind.rlike(pattern), class_name).otherwise(name)
    unscaled = F.when(kind.isin("NUMBER", "FLOAT"), F.lit(-127)).otherwise(F.lit(0))
    return view.select(
        F.col("OWNER").alias("owner"),
        F.col("TABLE_NAME").alias("table_name"),
        F.col("COLUMN_ID").cast("int").alias("pos"),
        F.col("COLUMN_NAME").alias("column_name"),
        name.alias("class_name"),
        F.coalesce(F.col("DATA_PRECISION").cast("int"), F.lit(0)).alias("precision"),
        F.coalesce(F.col("DATA_SCALE").cast("int"), unscaled).alias("scale"),
    )


def list_tables(dictionary: DataFrame, owners: Sequence[str] | None = None) -> DataFrame:
    """Tables of the given owners, or of all, ordered by owner and name. Owner names match exactly."""
    mine = dictionary if owners is None else dictionary.filter(F.col("owner").isin(*owners))
    return mine.select("owner", "table_name").distinct().orderBy("owner", "table_name")


def probe_columns(
    dictionary: DataFrame, owner: str | None = None, table: str | None = None
) -> DataFrame:
    """Columns of one table, or of all tables, in their order."""
    rows = dictionary.select(*COLUMN_METADATA.names)
    for column, wanted in (("owner", owner), ("table_name", table)):
        if wanted is not None:
            rows = rows.filter(F.col(column) == wanted)
    return rows.orderBy("owner", "table_name", "pos")
