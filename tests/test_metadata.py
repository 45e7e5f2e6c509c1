import pytest
from pyspark.sql import functions as F

from tidemark.functions import typemap
from tidemark.operators import routing
from tidemark.plans import tables as plans
from tidemark.sources import metadata

RULES = [
    ("java.lang.String", 0, 0, "STRING", "STRING"),
    ("java.math.BigDecimal", 10, 2, "DECIMAL(10,2)", "DECIMAL(10,2)"),
    ("java.math.BigDecimal", 38, 0, "DECIMAL(38,0)", "DECIMAL(38,0)"),
    ("java.math.BigDecimal", 0, -127, "DECIMAL(38,10)", "DECIMAL(38,10)"),
    ("java.math.BigDecimal", 39, 0, "DECIMAL(38,10)", "DECIMAL(38,10)"),
    ("java.math.BigDecimal", 2, 5, "DECIMAL(38,10)", "DECIMAL(38,10)"),
    ("java.sql.Timestamp", 0, 0, "DATE", "TIMESTAMP_NTZ"),
    ("oracle.sql.TIMESTAMPTZ", 0, 0, "TIMESTAMP_NTZ", "TIMESTAMP_NTZ"),
    ("x.timeStamp", 0, 0, "TIMESTAMP_NTZ", "TIMESTAMP_NTZ"),
    ("java.lang.Float", 0, 0, "FLOAT", "FLOAT"),
    ("java.lang.Double", 0, 0, "DOUBLE", "DOUBLE"),
    ("oracle.jdbc.OracleClob", 0, 0, "STRING", "STRING"),
    ("oracle.jdbc.OracleBlob", 0, 0, "STRING", "BINARY"),
    ("oracle.jdbc.OracleNClob", 0, 0, "STRING", "STRING"),
    ("oracle.sql.INTERVALYM", 0, 0, "TIMESTAMP_NTZ", "INTERVAL YEAR TO MONTH"),
    ("oracle.sql.INTERVALDS", 0, 0, "TIMESTAMP_NTZ", "INTERVAL DAY TO SECOND"),
    ("[B", 0, 0, "BINARY", "BINARY"),
    ("java.lang.Long", 0, 0, "STRING", "STRING"),
    ("java.lang.float", 0, 0, "STRING", "STRING"),
]


@pytest.fixture
def dictionary(spark):
    rows = [("DDS", "T_ZHJ2", i + 1, f"C{i}", c, p, s) for i, (c, p, s, _, _) in enumerate(RULES)]
    rows += [("DDS", "Other", 2, "B", "java.lang.String", 0, 0), ("DDS", "Other", 1, "A", "java.math.BigDecimal", 5, 1)]
    rows += [("dbmgr", "T_ZHJ2", 1, "A", "java.lang.String", 0, 0)]
    return spark.createDataFrame(rows, metadata.COLUMN_METADATA)


def test_type_rules(dictionary):
    one = dictionary.filter("owner = 'DDS' and table_name = 'T_ZHJ2'")
    for native, at in ((False, 3), (True, 4)):
        got = [r.spark_type for r in plans.typed_columns(one, native=native).orderBy("pos").collect()]
        assert got == [r[at] for r in RULES]
        for text in got:
            typemap.parse_type(text)


def test_names_and_order(dictionary):
    made = plans.collect_plans(plans.table_plans(dictionary, "orcl"))
    assert [(p.owner, p.table) for p in made] == [("DDS", "Other"), ("DDS", "T_ZHJ2"), ("dbmgr", "T_ZHJ2")]
    p = made[1]
    assert (p.source_topic, p.target_topic) == ("orcl-dds-t_zhj2", "target-orcl-dds-t_zhj2")
    assert (p.change_table, p.keyed_table) == ("kafka_orcl_dds_t_zhj2", "ice_orcl_dds_t_zhj2")
    assert made[0].columns == (("A", "DECIMAL(5,1)"), ("B", "STRING"))
    assert made[0].schema.names == ["AUTO_MD5_ID", "A", "B"]


def test_tables_are_created_once(spark, dictionary):
    database = "tidemark_test_db"
    plans.create_database(spark, database)
    made = plans.table_plans(dictionary, database)
    for _ in range(2):
        assert plans.create_tables(spark, made) == 3
    found = dict(spark.table(f"{database}.ice_{database}_dds_other").dtypes)
    assert found == {"AUTO_MD5_ID": "string", "A": "decimal(5,1)", "B": "string"}
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_iceberg_ddl_and_catalog(dictionary):
    made = plans.table_plans(dictionary, "ORCL", catalog="lake", fmt="iceberg", tables=["OTHER"])
    ddl = made.collect()[0].ddl
    assert ddl == (
        "CREATE TABLE IF NOT EXISTS lake.orcl.ice_orcl_dds_other (`AUTO_MD5_ID` STRING, `A` DECIMAL(5,1), "
        "`B` STRING) USING iceberg TBLPROPERTIES ('format-version'='2', 'write.upsert.enabled'='true')"
    )
    conf = plans.iceberg_catalog_conf("lake", "hdfs:///w")
    assert conf["spark.sql.catalog.lake.type"] == "hadoop" and conf["spark.sql.catalog.lake.warehouse"] == "hdfs:///w"


def test_listing_and_probing(dictionary):
    assert [tuple(r) for r in metadata.list_tables(dictionary, ["DDS"]).collect()] == [("DDS", "Other"), ("DDS", "T_ZHJ2")]
    assert metadata.list_tables(dictionary).count() == 3
    assert [r.column_name for r in metadata.probe_columns(dictionary, "DDS", "Other").collect()] == ["A", "B"]


def test_allow_lists(spark, dictionary):
    tables = dictionary.select("owner", "table_name").distinct()
    count = lambda names: routing.allowed(tables, "table_name", names).count()
    assert (count(None), count([]), count(["t_zhj2"]), count(["Other", "none"])) == (3, 3, 2, 1)
    listed = spark.createDataFrame([("t_ZHJ2",), ("t_zhj2",)], "n string")
    assert count(listed) == 2
    topics = tables.select(routing.source_topic(F.lit("Orcl"), F.col("owner"), F.col("table_name")).alias("topic"))
    pick = lambda d: sorted(r.topic for r in routing.allowed_topics(topics, "topic", "ORCL", d).collect())
    assert pick({"DDS": ["other"], "DBMGR": ["t_zhj2"]}) == ["orcl-dbmgr-t_zhj2", "orcl-dds-other"]
    assert len(pick({})) == len(pick({"DDS": []})) == 3
    assert pick({"DDS": [], "DBMGR": ["none"]}) == ["orcl-dds-other", "orcl-dds-t_zhj2"]


def test_columns_of_a_live_dictionary(spark):
    view = spark.createDataFrame(
        [("DDS", "T", 2, "N", "NUMBER", None, None), ("DDS", "T", 1, "ID", "NUMBER", 10, 0), ("DDS", "T", 3, "D", "DATE", None, None),
         ("DDS", "T", 4, "Z", "TIMESTAMP(6) WITH TIME ZONE", None, 6), ("DDS", "T", 5, "V", "VARCHAR2", None, None),
         ("DDS", "T", 6, "F", "FLOAT", 126, None)],
        "OWNER string, TABLE_NAME string, COLUMN_ID int, COLUMN_NAME string, DATA_TYPE string, DATA_PRECISION int, DATA_SCALE int",
    )
    columns = metadata.column_metadata(view)
    assert columns.schema.simpleString() == metadata.COLUMN_METADATA.simpleString()
    plan = plans.collect_plans(plans.table_plans(columns, "orcl"))[0]
    assert plan.columns == (
        ("ID", "DECIMAL(10,0)"), ("N", "DECIMAL(38,10)"), ("D", "DATE"), ("Z", "TIMESTAMP_NTZ"), ("V", "STRING"),
        ("F", "DECIMAL(38,10)"),
    )
