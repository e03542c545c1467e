import pytest
from pyspark.sql import functions as F

from loadkit.operators import metadata as M
from tests.conftest import rows

META = (
    "table_name string, column_name string, data_type string, data_length int, data_precision int, data_scale int, "
    "nullable string, identity_column string, comments string, column_id int"
)


@pytest.fixture
def meta(spark):
    return spark.createDataFrame(
        [
            ("PARCELS", "WEIGHED_AT", "DATE", 7, None, None, "YES", "NO", None, 3),
            ("PARCELS", "TRACK_NO", "NUMBER", 22, 12, 0, "N", "YES", "printed on the label", 1),
            ("PARCELS", "ROUTE", "VARCHAR2", 40, None, None, "Y", "NO", "by way of", 4),
            ("PARCELS", "DEPOT", "NUMBER", 22, 5, 0, "no", "yes", None, 2),
            ("DEPOTS", "DEPOT", "NUMBER", 22, None, None, "NO", "NO", None, 1),
        ],
        META,
    )


# Type, precision, scale and result.
ORACLE = [
    ("NUMBER", 10, 2, "DECIMAL(10,2)"),
    ("NUMBER", 10, None, "DECIMAL(10,0)"),
    ("number", None, None, "BIGINT"),
    ("VARCHAR2", None, None, "STRING"),
    ("CHAR", None, None, "STRING"),
    ("CLOB", None, None, "STRING"),
    ("LONG", None, None, "STRING"),
    ("DATE", None, None, "TIMESTAMP"),
    ("TIMESTAMP", None, None, "TIMESTAMP"),
    ("TIMESTAMP WITH TIME ZONE", None, None, "TIMESTAMP"),
    ("TIMESTAMP WITH LOCAL TIME ZONE", None, None, "TIMESTAMP"),
    ("FLOAT", 5, 2, "DOUBLE"),
    ("BINARY_FLOAT", None, None, "FLOAT"),
    ("BINARY_DOUBLE", None, None, "DOUBLE"),
    ("BLOB", None, None, "BINARY"),
    ("RAW", None, None, "BINARY"),
    ("BOOLEAN", None, None, "BOOLEAN"),
    ("INTERVAL YEAR TO MONTH", None, None, "STRING"),
    ("INTERVAL DAY TO SECOND", None, None, "STRING"),
    ("XMLTYPE", None, None, "Unsupported data type: XMLTYPE"),
]
SQL_SERVER = [
    ("INT", None, None, "INT"),
    ("BIGINT", None, None, "BIGINT"),
    ("SMALLINT", None, None, "SMALLINT"),
    ("TINYINT", None, None, "TINYINT"),
    ("DECIMAL", 12, 3, "DECIMAL(12,3)"),
    ("DECIMAL", None, None, "DECIMAL(10,0)"),
    ("NUMERIC", 12, 3, "DECIMAL(12,3)"),
    ("NUMERIC", None, None, "BIGINT"),
    ("NVARCHAR", None, None, "STRING"),
    ("NTEXT", None, None, "STRING"),
    ("DATETIME2", None, None, "TIMESTAMP"),
    ("TIME", None, None, "TIMESTAMP"),
    ("BIT", None, None, "BOOLEAN"),
    ("REAL", None, None, "DOUBLE"),
    ("image", None, None, "BINARY"),
    ("NUMBER", None, None, "Unsupported data type: NUMBER"),
]


@pytest.mark.parametrize("system, cases", [("oracle", ORACLE), ("sqlserver", SQL_SERVER)])
def test_types(spark, system, cases):
    df = spark.createDataFrame(
        [(i, *case[:3]) for i, case in enumerate(cases)], "i int, data_type string, data_precision int, data_scale int"
    )
    result = M.map_source_types(df, system).orderBy("i").collect()
    assert [r.target_type or r.type_error for r in result] == [case[3] for case in cases]
    assert len(M.ORACLE_TYPES) == 17 and len(M.SQL_SERVER_TYPES) == 23


def test_unknown_system(meta):
    with pytest.raises(ValueError, match="unknown system"):
        M.map_source_types(meta, "db2")


def test_oracle_metadata(spark, meta):
    columns = meta.drop("comments").selectExpr("*", "'OPS' AS owner")
    comments = spark.createDataFrame(
        [("OPS", "PARCELS", "TRACK_NO", "key"), ("XX", "PARCELS", "ROUTE", "other owner")],
        "owner string, table_name string, column_name string, comments string",
    )
    df = M.column_metadata_oracle(columns, comments, "OPS", ["parcels"])
    assert [(r.column_name, r.comments, r.column_id) for r in df.collect()] == [
        ("TRACK_NO", "key", 1), ("DEPOT", None, 2), ("WEIGHED_AT", None, 3), ("ROUTE", None, 4),
    ]
    assert df.columns == META.replace(",", "").split()[::2]
    assert M.column_metadata_oracle(columns, comments, "XX").isEmpty()


def test_sql_server_metadata(spark):
    columns = spark.createDataFrame(
        [(s, t, c, "INT", None, 10, 0, "NO", i) for s in ("dbo", "hr") for t in ("A", "B") for i, c in ((1, "ID"), (2, "V"))],
        "table_schema string, table_name string, column_name string, data_type string, character_maximum_length int, "
        "numeric_precision int, numeric_scale int, is_nullable string, ordinal_position int",
    )
    pair = "table_schema string, table_name string"
    tables = columns.select("table_schema", "table_name").distinct()
    identity = spark.createDataFrame([("dbo", "A", "ID"), ("hr", "B", "ID")], f"{pair}, name string")
    notes = spark.createDataFrame([("dbo", "A", 2, "value"), ("hr", "A", 1, "no")], f"{pair}, minor_id int, value string")
    df = M.column_metadata_sqlserver(columns, tables, identity, notes, "dbo")
    assert rows(df.select("table_name", "column_name", "identity_column", "comments")) == [
        ("A", "ID", "YES", None), ("A", "V", "NO", "value"), ("B", "ID", "NO", None), ("B", "V", "NO", None),
    ]
    assert M.column_metadata_sqlserver(columns, tables, identity, notes, "dbo", ["b"]).count() == 2
    mixed = [f.withColumn("table_name", F.replace("table_name", F.lit("B"), F.lit("Bills"))) for f in (columns, tables)]
    assert M.column_metadata_sqlserver(*mixed, identity, notes, "dbo", ["BILLS"]).count() == 2


def test_columns_by_table(meta):
    listed = M.columns_by_table(meta)
    assert rows(listed.drop("data_type")) == [
        ("DEPOTS", 1, "DEPOT", False, False),
        ("PARCELS", 1, "TRACK_NO", False, True),
        ("PARCELS", 2, "DEPOT", False, True),
        ("PARCELS", 3, "WEIGHED_AT", True, False),
        ("PARCELS", 4, "ROUTE", True, False),
    ]


def test_load_rules(spark, meta):
    rules = M.load_rules_from_metadata(meta)
    assert rows(rules.drop("column_id")) == [
        ("DEPOTS", "null_check", "DEPOT", "WARNING"),
        ("DEPOTS", "schema_check", None, "ERROR"),
        ("PARCELS", "hash_of", "DEPOT", None),
        ("PARCELS", "hash_of", "TRACK_NO", None),
        ("PARCELS", "null_check", "DEPOT", "WARNING"),
        ("PARCELS", "null_check", "TRACK_NO", "WARNING"),
        ("PARCELS", "schema_check", None, "ERROR"),
    ]
    # names stand in the order of the table's columns
    assert M.table_settings(rules, "PARCELS") == {
        "validations": [
            {"name": "schema_check", "action_on_unexpected": "ERROR"},
            {"name": "null_check", "action_on_unexpected": "WARNING", "columns": ["TRACK_NO", "DEPOT"]},
        ],
        "table_columns_to_be_added": [{"column_name": "hash_key", "data_type": "string", "hash_of": ["TRACK_NO", "DEPOT"]}],
    }
    assert M.table_settings(rules, "DEPOTS")["table_columns_to_be_added"] == []


def test_conform_to_metadata(spark, meta):
    raw = spark.createDataFrame(
        [("north", "7", "3", "2024-01-02"), ("south", "x", "4", "?")], "ROUTE string, TRACK_NO string, DEPOT string, WEIGHED_AT string"
    )
    parcels = meta.where("table_name = 'PARCELS'")
    df = M.conform_to_metadata(raw, parcels, "oracle", on_error="null")
    assert df.dtypes == [("TRACK_NO", "decimal(12,0)"), ("DEPOT", "decimal(5,0)"), ("WEIGHED_AT", "timestamp"), ("ROUTE", "string")]
    assert [(str(r.TRACK_NO), str(r.WEIGHED_AT)) for r in df.orderBy("ROUTE").collect()] == [
        ("7", "2024-01-02 00:00:00"), ("None", "None"),
    ]
    assert M.conform_to_metadata(raw, parcels.drop("column_id"), "oracle", on_error="null").columns == raw.columns
    with pytest.raises(ValueError, match="Unsupported"):
        M.conform_to_metadata(raw, parcels, "sqlserver")
