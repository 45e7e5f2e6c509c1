"""Names and shapes shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# Message field names, operation codes and the row-id column.
ROW_ID = "AUTO_MD5_ID"
INSERT, UPDATE, DELETE, DDL = "c", "u", "d", "ddl"
SNAPSHOT_READ = "r"
ENVELOPE_KEYS = ("scn", "tms", "xid", "row", "payload")
PAYLOAD_KEYS = ("op", "schema", "row", "rid", "before", "after", "sql")
ADDRESS_KEYS = ("owner", "table")

# The stand-in row for unreadable messages.
DUMMY_OWNER = "test"
DUMMY_TABLE = "ICE_DEMO"
DUMMY_ROW = 1
DUMMY_RID = "AAAWAgAAEAAACRmAAB"
DUMMY_IMAGE = '{"C1":1}'

# Prefixes of derived topic and table names.
TARGET_PREFIX = "target"
CHANGE_TABLE_PREFIX = "kafka"
KEYED_TABLE_PREFIX = "ice"

# Columns that put changes of one row in order: commit number, position in the source, side of a
# split update.
ORDER = ("scn", "pos", "seq")

ADDRESS = T.StructType([T.StructField(k, T.StringType()) for k in ADDRESS_KEYS])

# What a message frame looks like whether it came from a broker or from files.
MESSAGE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("scn", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("seq", T.IntegerType()),
    ]
)

SENTENCE = T.StructType(
    [T.StructField("sentenceId", T.LongType()), T.StructField("content", T.StringType())]
)
