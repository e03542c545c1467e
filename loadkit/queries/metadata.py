"""Source metadata: every part stands for a source column, fifty to a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.operators import metadata as M
from loadkit.queries.registry import query, table

# The source types of each system, and one that neither has.
ORACLE = [*M.ORACLE_TYPES, "XMLTYPE"]
SQL_SERVER = [*M.SQL_SERVER_TYPES, "GEOGRAPHY"]


def _pick(types: list[str]) -> Column:
    """A type by part size, so that all occur."""
    return F.element_at(F.array(*[F.lit(t) for t in types]), (F.col("p_size") % len(types) + 1).cast("int"))


def _pick_sql(types: list[str]) -> str:
    listed = ", ".join(f"'{t}'" for t in types)
    return f"list_extract([{listed}], p_size % {len(types)} + 1)"



def _table_name(number: str) -> Column:
    return F.concat(F.lit("T_"), F.floor(F.col(number) / 50).cast("string"))


META_SQL = """SELECT 'T_' || CAST(p_partkey // 50 AS VARCHAR) AS table_name, 'C_' || CAST(p_partkey AS VARCHAR) AS column_name,
  {pick} AS data_type, p_size AS data_length,
  CASE WHEN p_brand <> 'Brand#1' THEN p_size % 38 + 1 END AS data_precision,
  CASE WHEN p_type <> 'ECONOMY' THEN p_size % 5 END AS data_scale,
  CASE WHEN p_retailprice > 950 THEN 'Y' ELSE 'N' END AS nullable,
  CASE WHEN p_size = 1 THEN 'YES' ELSE 'NO' END AS identity_column,
  p_partkey AS column_id FROM part"""
META_CTE = f"WITH meta AS ({META_SQL.format(pick=_pick_sql(ORACLE))})\n"
MS_META_CTE = f"WITH meta AS ({META_SQL.format(pick=_pick_sql(SQL_SERVER))})\n"


def _columns(spark: SparkSession, sf: str, types: list[str]) -> DataFrame:
    return table(spark, sf, "part").select(
        _table_name("p_partkey").alias("table_name"),
        F.concat(F.lit("C_"), "p_partkey").alias("column_name"),
        _pick(types).alias("data_type"),
        F.col("p_size").alias("data_length"),
        F.when(F.col("p_brand") != "Brand#1", F.col("p_size") % 38 + 1).alias("data_precision"),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_size") % 5).alias("data_scale"),
        F.when(F.col("p_retailprice") > 950, "Y").otherwise("N").alias("nullable"),
        F.when(F.col("p_size") == 1, "YES").otherwise("NO").alias("identity_column"),
        F.col("p_partkey").alias("column_id"),
    )


def _texts(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols})


def _text_sql(*cols: str) -> str:
    return ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '-') AS {c}" for c in cols)


@query(META_CTE + f"""SELECT table_name, column_name, data_type, {_text_sql('data_precision', 'data_scale', 'comments')},
  nullable, identity_column, column_id
FROM meta LEFT JOIN (SELECT 'C_' || CAST(s_suppkey AS VARCHAR) AS column_name, s_name AS comments FROM supplier) c
  USING (column_name) WHERE table_name <> 'T_0'""")
def column_metadata_oracle(spark, sf):
    columns = _columns(spark, sf, ORACLE).withColumn("owner", F.lit("SALES"))
    comments = table(spark, sf, "supplier").select(
        F.lit("SALES").alias("owner"),
        _table_name("s_suppkey").alias("table_name"),
        F.concat(F.lit("C_"), "s_suppkey").alias("column_name"),
        F.col("s_name").alias("comments"),
    )
    every = [r["table_name"].lower() for r in columns.select("table_name").distinct().where("table_name != 'T_0'").collect()]
    df = M.column_metadata_oracle(columns, comments, "SALES", every).drop("data_length")
    return _texts(df, "data_precision", "data_scale", "comments")


@query(MS_META_CTE + f"""SELECT table_name, column_name, data_type, {_text_sql('data_precision', 'data_scale', 'comments')},
  nullable, identity_column
FROM meta LEFT JOIN (SELECT s_suppkey AS column_id, s_name AS comments FROM supplier) c USING (column_id)
WHERE table_name <> 'T_0'""")
def column_metadata_sqlserver(spark, sf):
    schema = F.lit("dbo").alias("table_schema")
    columns = _columns(spark, sf, SQL_SERVER).select(
        schema,
        "table_name",
        "column_name",
        "data_type",
        F.col("data_length").alias("character_maximum_length"),
        F.col("data_precision").alias("numeric_precision"),
        F.col("data_scale").alias("numeric_scale"),
        F.col("nullable").alias("is_nullable"),
        F.col("column_id").alias("ordinal_position"),
        "identity_column",
    )
    tables = columns.select("table_schema", "table_name").distinct()
    identity = columns.where("identity_column = 'YES'").select(
        "table_schema", "table_name", F.col("column_name").alias("name")
    )
    properties = table(spark, sf, "supplier").select(
        schema,
        _table_name("s_suppkey").alias("table_name"),
        F.col("s_suppkey").alias("minor_id"),
        F.col("s_name").alias("value"),
    )
    every = [r["table_name"].lower() for r in tables.where("table_name != 'T_0'").collect()]
    df = M.column_metadata_sqlserver(columns.drop("identity_column"), tables, identity, properties, "dbo", every)
    return _texts(df.drop("data_length"), "data_precision", "data_scale", "comments")


DECIMAL_SQL = """'DECIMAL(' || COALESCE(CAST(data_precision AS VARCHAR), '10') || ',' ||
  COALESCE(CAST(data_scale AS VARCHAR), '0') || ')'"""


@query(META_CTE + f"""SELECT column_name, CASE
  WHEN data_type = 'NUMBER' THEN CASE WHEN data_precision IS NULL THEN 'BIGINT' ELSE {DECIMAL_SQL} END
  WHEN data_type IN ('VARCHAR2', 'CHAR', 'CLOB', 'LONG', 'INTERVAL YEAR TO MONTH', 'INTERVAL DAY TO SECOND') THEN 'STRING'
  WHEN data_type IN ('DATE', 'TIMESTAMP', 'TIMESTAMP WITH TIME ZONE', 'TIMESTAMP WITH LOCAL TIME ZONE') THEN 'TIMESTAMP'
  WHEN data_type IN ('FLOAT', 'BINARY_DOUBLE') THEN 'DOUBLE' WHEN data_type = 'BINARY_FLOAT' THEN 'FLOAT'
  WHEN data_type IN ('BLOB', 'RAW') THEN 'BINARY' WHEN data_type = 'BOOLEAN' THEN 'BOOLEAN'
  ELSE 'Unsupported data type: ' || data_type END AS target_type FROM meta""")
def map_types_oracle(spark, sf):
    df = M.map_source_types(_columns(spark, sf, ORACLE), "oracle")
    return df.select("column_name", F.coalesce("target_type", "type_error").alias("target_type"))


@query(MS_META_CTE + f"""SELECT column_name, CASE
  WHEN data_type = 'NUMERIC' THEN CASE WHEN data_precision IS NULL THEN 'BIGINT' ELSE {DECIMAL_SQL} END
  WHEN data_type = 'DECIMAL' THEN {DECIMAL_SQL}
  WHEN data_type IN ('INT', 'BIGINT', 'SMALLINT', 'TINYINT') THEN data_type
  WHEN data_type IN ('VARCHAR', 'NVARCHAR', 'CHAR', 'NCHAR', 'TEXT', 'NTEXT') THEN 'STRING'
  WHEN data_type IN ('DATETIME', 'SMALLDATETIME', 'DATE', 'TIME', 'DATETIME2') THEN 'TIMESTAMP'
  WHEN data_type = 'BIT' THEN 'BOOLEAN' WHEN data_type IN ('FLOAT', 'REAL') THEN 'DOUBLE'
  WHEN data_type IN ('VARBINARY', 'BINARY', 'IMAGE') THEN 'BINARY'
  ELSE 'Unsupported data type: ' || data_type END AS target_type FROM meta""")
def map_types_sqlserver(spark, sf):
    df = M.map_source_types(_columns(spark, sf, SQL_SERVER), "sqlserver")
    return df.select("column_name", F.coalesce("target_type", "type_error").alias("target_type"))


@query(META_CTE + """SELECT table_name, CAST(ROW_NUMBER() OVER (PARTITION BY table_name ORDER BY column_id) AS BIGINT) AS pos,
  column_name, CASE WHEN nullable = 'Y' THEN 1 ELSE 0 END AS nullable,
  CASE WHEN identity_column = 'YES' THEN 1 ELSE 0 END AS identity FROM meta""")
def columns_by_table(spark, sf):
    return M.columns_by_table(_columns(spark, sf, ORACLE)).select(
        "table_name",
        F.col("position").cast("bigint").alias("pos"),
        "column_name",
        F.col("nullable").cast("int").alias("nullable"),
        F.col("identity_column").cast("int").alias("identity"),
    )


@query(META_CTE + """SELECT DISTINCT table_name, 'schema_check' AS setting, '-' AS column_name, 'ERROR' AS action FROM meta
UNION ALL SELECT table_name, 'null_check', column_name, 'WARNING' FROM meta WHERE nullable = 'N'
UNION ALL SELECT table_name, 'hash_of', column_name, '-' FROM meta WHERE identity_column = 'YES'""")
def rules_from_metadata(spark, sf):
    rules = M.load_rules_from_metadata(_columns(spark, sf, ORACLE))
    return _texts(rules.drop("column_id"), "column_name", "action")


@query("""SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus,
  CAST(floor(o_totalprice) AS BIGINT) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders""")
def conform_to_metadata(spark, sf):
    orders = table(spark, sf, "orders")
    raw = orders.withColumn("o_totalprice", F.floor("o_totalprice")).select(
        *[F.col(c).cast("string").alias(c) for c in orders.columns]
    )
    # The metadata of the orders table, as its source would describe it.
    meta = spark.createDataFrame(
        [
            ("o_orderkey", "NUMBER", None, None),
            ("o_custkey", "NUMBER", 18, None),
            ("o_orderstatus", "VARCHAR2", None, None),
            ("o_totalprice", "NUMBER", 15, 2),
            ("o_orderdate", "DATE", None, None),
        ],
        "column_name string, data_type string, data_precision int, data_scale int",
    )
    df = M.conform_to_metadata(raw, meta, "oracle")
    return df.select(
        "o_orderkey",
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("bigint").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
    )
