"""Change messages and metadata that Spark derives from the given tables, every row of them.

Which rows are updated, deleted or damaged follows from their values, so the same choice can be
written in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.envelopes import envelope, row_image

OWNER = "DDS"
DATABASE = "ORCL"

# Column classes a source database may report, spread over the part table by p_size.
CLASSES = (
    "java.lang.String",
    "java.math.BigDecimal",
    "java.sql.Timestamp",
    "oracle.sql.TIMESTAMP",
    "oracle.sql.TIMESTAMPTZ",
    "java.lang.Float",
    "java.lang.Double",
    "oracle.jdbc.OracleClob",
    "oracle.jdbc.OracleBlob",
    "oracle.jdbc.OracleNClob",
    "oracle.sql.INTERVALYM",
    "oracle.sql.INTERVALDS",
    "[B",
    "java.lang.Long",
    "vendor.TimestampLike",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, as its files are split."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Column types as that database's dictionary spells them.
VIEW_TYPES = (
    "VARCHAR2", "NUMBER", "DATE", "TIMESTAMP(6)", "TIMESTAMP(6) WITH TIME ZONE", "BINARY_FLOAT", "BINARY_DOUBLE",
    "CLOB", "BLOB", "NCLOB", "INTERVAL YEAR(2) TO MONTH", "INTERVAL DAY(2) TO SECOND(6)", "RAW", "FLOAT", "ROWID",
)


#: Rows whose messages one task makes. Few, since tasks are dealt out in rounds: of 9 equal tasks on 8 cores, the last runs alone.
ROWS_PER_PARTITION = 100_000


def _messages(df: DataFrame, *messages: Column, prepared: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per message that applies; each is a struct of pos and value, or null. ``prepared`` adds columns that they share.

    The messages of a row lie in one of as many partitions as there are cores, as in a topic that is dealt by key: a table's
    single row group would else be one task. A larger table has more partitions, none more than about ``ROWS_PER_PARTITION``.
    """
    partitions = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_PER_PARTITION))
    dealt = df.repartition(partitions, df.columns[0])
    return (prepared(dealt) if prepared else dealt).select(F.inline(F.array_compact(F.array(*messages))))


def _at(pos: Column, value: Column) -> Column:
    return F.struct(pos.alias("pos"), value.alias("value"))


def _day_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def orders(spark: SparkSession, sf_dir: str, *, damaged: bool = False) -> DataFrame:
    """Changes of ORDERS: ``pos`` and ``value``.

    Every row is inserted. Status F is updated to X, and deleted again at top priority. Status O at
    low priority gets an update that changes nothing. Orders of a first of the month come with a
    schema change. ``damaged`` adds one unusable message to every order of status P and to some of
    status O.
    """
    df = table(spark, sf_dir, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = {"o_orderdate": _day_text("o_orderdate")}
    row = row_image(df, **day)
    shipped = row_image(df, **day, o_orderstatus=F.lit("X"))
    scn = F.col("o_orderkey") * 10
    rid = F.concat(F.lit("R"), "o_orderkey")
    tms = _day_text("o_orderdate")

    def change(op: str, step: int, **images: Column) -> Column:
        at = scn + step
        return _at(at, envelope(op, OWNER, "ORDERS", at, rid=rid, tms=tms, xid=F.lit("1.2.3"), **images))

    no_change = (status == "O") & (priority == "5-LOW")
    ddl_text = F.concat(F.lit('ALTER TABLE "ORDERS" ADD C'), "o_orderkey")
    parts = [
        change("c", 0, after=row),
        F.when(status == "F", change("u", 1, before=row, after=shipped)),
        F.when(no_change, change("u", 1, before=row, after=row)),
        F.when((status == "F") & (priority == "1-URGENT"), change("d", 2, before=shipped)),
        F.when(F.dayofmonth("o_orderdate") == 1, change("ddl", 3, sql=ddl_text)),
    ]
    if damaged:
        at = scn + 5
        good = envelope("c", OWNER, "ORDERS", at, after=row)
        text = F.to_json(row)
        as_string = F.replace(
            envelope("c", OWNER, "ORDERS", at, after=F.lit("@")),
            F.lit('"@"'),
            F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('\\"')), F.lit('"')),
        )
        no_op = F.replace(good, F.lit('"op":"c"'), F.lit('"op":null'))
        damages = {
            ("P", "1-URGENT"): F.substring(good, F.lit(1), F.length(good) - 10),
            ("P", "2-HIGH"): F.lit(""),
            ("P", "3-MEDIUM"): F.replace(good, F.lit('{"scn"'), F.lit('{"zz":1,"scn"')),
            ("P", "4-NOT SPECIFIED"): envelope("c", OWNER, "ORDERS", at),
            ("P", "5-LOW"): F.replace(good, F.lit('"row":1'), F.lit('"row":"x"')),
            ("O", "1-URGENT"): F.to_json(F.struct(at.alias("scn"))),
            ("O", "2-HIGH"): no_op,
            ("O", "3-MEDIUM"): as_string,
        }
        for (s, p), value in damages.items():
            parts.append(F.when((status == s) & (priority == p), _at(at, value)))
    return _messages(df, *parts)


def orders_own_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of ORDERS whose images bring an id of their own, the order number; status F becomes X."""
    df = table(spark, sf_dir, "orders").withColumn("auto_md5_id", F.col("o_orderkey").cast("string"))
    day = {"o_orderdate": _day_text("o_orderdate")}
    row, shipped = row_image(df, **day), row_image(df, **day, o_orderstatus=F.lit("X"))
    scn = F.col("o_orderkey") * 10
    return _messages(
        df,
        _at(scn, envelope("c", OWNER, "ORDERS", scn, after=row)),
        F.when(
            F.col("o_orderstatus") == "F",
            _at(scn + 1, envelope("u", OWNER, "ORDERS", scn + 1, before=row, after=shipped)),
        ),
    )


def orders_in_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of ORDERS under ids of their own, ``stage`` 1 and then 2.

    Stage 1 inserts all orders but those of high priority. Stage 2 brings those, moves status F to X and deletes the
    urgent ones of them, updates low priority ones of status O without a change, repeats the inserts of medium priority,
    and for status P brings an older insert that was late.
    """
    df = table(spark, sf_dir, "orders").withColumn("auto_md5_id", F.col("o_orderkey").cast("string"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = {"o_orderdate": _day_text("o_orderdate")}
    row, shipped = row_image(df, **day), row_image(df, **day, o_orderstatus=F.lit("X"))
    older = row_image(df, **day, o_orderstatus=F.lit("N"))
    scn = F.col("o_orderkey") * 10
    high = priority == "2-HIGH"

    def change(stage: Column | int, op: str, step: int, **images: Column) -> Column:
        value = envelope(op, OWNER, "ORDERS", scn + step, **images)
        stage = F.lit(stage) if isinstance(stage, int) else stage
        return F.struct(stage.alias("stage"), (scn + step).alias("pos"), value.alias("value"))

    return _messages(
        df,
        change(F.when(high, 2).otherwise(1), "c", 0, after=row),
        F.when(status == "F", change(2, "u", 1, before=row, after=shipped)),
        F.when((status == "F") & (priority == "1-URGENT"), change(2, "d", 2, before=shipped)),
        F.when((status == "O") & (priority == "5-LOW"), change(2, "u", 1, before=row, after=row)),
        F.when(priority == "3-MEDIUM", change(2, "c", 0, after=row)),
        F.when(status == "P", change(2, "c", -5, after=older)),
    )


def orders_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One insert per order with numbers that no double holds: 38 digits, 18 before and 2 behind the point, 9 and 18,
    one with more places than its column has, and one of 45 digits."""
    df = table(spark, sf_dir, "orders")
    key, customer_key = (F.lpad(F.col(c).cast("string"), 9, d) for c, d in (("o_orderkey", "7"), ("o_custkey", "3")))
    big = F.concat(F.lit("1"), key, customer_key, key, customer_key, F.lit("1"))
    numbers = {
        "O_ORDERKEY": F.col("o_orderkey").cast("string"),
        "BIG": big,
        "MONEY": F.concat(key, customer_key, F.lit("."), F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0")),
        "FINE": F.concat(F.lit("-"), key, F.lit("."), customer_key, F.lit("123456789")),
        "CUT": F.concat(F.lit("5"), customer_key, F.lit("."), key),
        "HUGE": F.concat(big, F.lit("9999999")),
    }
    members = [F.concat(F.lit(f'{"," if i else ""}"{name}":'), text) for i, (name, text) in enumerate(numbers.items())]
    image = F.concat(F.lit("{"), *members, F.lit("}"))
    scn = F.col("o_orderkey") * 10
    message = F.replace(envelope("c", OWNER, "NUMBERS", scn, after=F.lit("@")), F.lit('"@"'), image)
    return _messages(df, _at(scn, message))


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of CUSTOMER: all inserted, BUILDING moved to GARDEN, AUTOMOBILE deleted."""
    df = table(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    row, moved = row_image(df), row_image(df, c_mktsegment=F.lit("GARDEN"))
    scn = F.col("c_custkey") * 10

    def change(op: str, step: int, **images: Column) -> Column:
        return _at(scn + step, envelope(op, OWNER, "CUSTOMER", scn + step, **images))

    return _messages(
        df,
        change("c", 0, after=row),
        F.when(segment == "BUILDING", change("u", 1, before=row, after=moved)),
        F.when(segment == "AUTOMOBILE", change("d", 1, before=row)),
    )


def supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full load of SUPPLIER."""
    df = table(spark, sf_dir, "supplier")
    scn = F.col("s_suppkey") * 10
    return _messages(df, _at(scn, envelope("c", OWNER, "SUPPLIER", scn, after=row_image(df))))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of EVENTS with a nested value: all inserted, errors deleted, views counted twice as much."""
    df = table(spark, sf_dir, "events")
    shown = {
        "ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "props": F.from_json("props", "k bigint"),
    }
    row = row_image(df, **shown)
    twice = row_image(df, **shown, value=F.col("value") * 2)
    scn = F.col("event_id") * 10
    kind = F.col("event_type")

    def change(op: str, step: int, **images: Column) -> Column:
        return _at(scn + step, envelope(op, OWNER, "EVENTS", scn + step, **images))

    return _messages(
        df,
        change("c", 0, after=row),
        F.when(kind == "view", change("u", 1, before=row, after=twice)),
        F.when(kind == "error", change("d", 1, before=row)),
    )


def _line_change(op: str, step: int, **images: str) -> Column:
    """A change of LINEITEM whose images are columns of JSON text: they stand between parts that are the same for all rows."""
    frame = envelope(op, OWNER, "LINEITEM", F.lit(step).cast("bigint"), **dict.fromkeys(images, F.lit("@")))
    pieces = [F.split_part(frame, F.lit('"@"'), F.lit(i + 1)) for i in range(len(images) + 1)]
    texts = [F.col(images[side]) for side in ("before", "after") if side in images]
    return F.concat(pieces[0], *[x for pair in zip(texts, pieces[1:], strict=True) for x in pair])


def _line_texts(df: DataFrame) -> DataFrame:
    """``df`` with each row's image as JSON text, ``_row``, and ``_closed`` of returned lines: written once for all messages of a row."""
    day = {"l_shipdate": _day_text("l_shipdate")}
    keep_nulls = {"ignoreNullFields": "false"}
    closed = F.to_json(row_image(df, **day, l_linestatus=F.lit("X")), keep_nulls)
    return df.withColumns({"_row": F.to_json(row_image(df, **day), keep_nulls), "_closed": F.when(F.col("l_returnflag") == "R", closed)})


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of LINEITEM, equal rows included: full load, returned lines closed, accepted ones deleted."""
    df = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    pos = F.col("l_orderkey") * 10 + F.col("l_linenumber")

    def change(op: str, step: int, **images: str) -> Column:
        return _at(pos, _line_change(op, step, **images))

    return _messages(
        df,
        change("c", 1, after="_row"),
        F.when(flag == "R", change("u", 2, before="_row", after="_closed")),
        F.when(flag == "A", change("d", 3, before="_row")),
        prepared=_line_texts,
    )


def lineitem_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of LINEITEM where each line is loaded as often as its tax's last digit says, once to three times;
    one copy of every returned line is closed, one of every accepted line is deleted."""
    df = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    pos = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 10
    times = F.round(F.col("l_tax") * 100).cast("bigint") % 3

    def change(op: str, step: int, **images: str) -> Column:
        return _at(pos + step, _line_change(op, step, **images))

    return _messages(
        df,
        change("c", 1, after="_row"),
        F.when(times > 0, change("c", 2, after="_row")),
        F.when(times > 1, change("c", 3, after="_row")),
        F.when(flag == "R", change("u", 4, before="_row", after="_closed")),
        F.when(flag == "A", change("d", 5, before="_row")),
        prepared=_line_texts,
    )


def as_topic(feed: DataFrame, topic: str) -> DataFrame:
    """A feed as messages of a topic."""
    return feed.select(
        F.lit(topic).alias("topic"),
        F.lit(None).cast("string").alias("key"),
        "value",
        F.lit(None).cast("bigint").alias("scn"),
        "pos",
        F.lit(None).cast("int").alias("seq"),
    )


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column metadata from the part table: sixteen parts make a table, a hundred tables an owner."""
    part = table(spark, sf_dir, "part")
    number = F.col("p_partkey")
    classes = F.array(*[F.lit(c) for c in CLASSES])
    return part.select(
        F.concat(F.lit("OWN"), F.floor(number / 1600)).alias("owner"),
        F.concat(F.lit("T_"), F.floor(number / 16)).alias("table_name"),
        (number - F.floor(number / 16) * 16 + 1).cast("int").alias("pos"),
        F.upper(F.concat_ws("_", F.replace("p_name", F.lit(" "), F.lit("_")), number)).alias("column_name"),
        F.get(classes, F.floor(F.col("p_size") * len(CLASSES) / 51).cast("int")).alias("class_name"),
        (F.col("p_size") - 5).cast("int").alias("precision"),
        (F.length("p_name") - 9).cast("int").alias("scale"),
    )


def columns_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same parts as the column view of a source database's dictionary."""
    part = table(spark, sf_dir, "part")
    number = F.col("p_partkey")
    kinds = F.array(*[F.lit(k) for k in VIEW_TYPES])
    kind = F.get(kinds, F.floor(F.col("p_size") * len(VIEW_TYPES) / 51).cast("int"))
    sized = kind == "NUMBER"
    return part.select(
        F.concat(F.lit("OWN"), F.floor(number / 1600)).alias("OWNER"),
        F.concat(F.lit("T_"), F.floor(number / 16)).alias("TABLE_NAME"),
        (number - F.floor(number / 16) * 16 + 1).cast("decimal(10,0)").alias("COLUMN_ID"),
        F.upper(F.concat_ws("_", F.replace("p_name", F.lit(" "), F.lit("_")), number)).alias("COLUMN_NAME"),
        kind.alias("DATA_TYPE"),
        F.when(sized & (F.col("p_size") > 5), F.col("p_size") - 5).cast("decimal(10,0)").alias("DATA_PRECISION"),
        F.when(sized & (F.col("p_size") > 5), F.lit(2)).cast("decimal(10,0)").alias("DATA_SCALE"),
    )


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sentence messages; the German ones have no id."""
    docs = table(spark, sf_dir, "documents")
    sentence_id = F.when(F.col("lang") != "de", F.col("doc_id"))
    body = F.struct(sentence_id.alias("sentenceId"), F.col("text").alias("content"))
    return docs.select(
        F.col("doc_id").alias("pos"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value")
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log line with secrets per customer: ``c_custkey`` and ``line``."""
    name, key = F.col("c_name"), F.col("c_custkey")
    digits = F.lpad(key.cast("string"), 16, "7")
    card = F.concat_ws("-", *[F.substring(digits, i, 4) for i in (1, 5, 9, 13)])
    ssn = F.concat_ws("-", F.substring(digits, 8, 3), F.substring(digits, 11, 2), F.substring(digits, 13, 4))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(
            F.lit("login "), name, F.lit(" PassWord="), F.col("c_mktsegment"), F.lit(' {"password" : "'),
            name, F.lit('"} passwd:'), key, F.lit(" pass="), name, F.lit(" Secret="), F.col("c_acctbal").cast("string"),
            F.lit(" card "), card, F.lit(" ssn "), ssn, F.lit(" IDENTIFIED BY password,"), name, F.lit('" done'),
        ).alias("line"),
    )
