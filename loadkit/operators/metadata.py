"""Source-column metadata: assembling it, mapping its types, and what a load derives from it.

Metadata frames have one row per source column: table_name, column_name,
data_type, data_length, data_precision, data_scale, nullable, identity_column,
comments and, from Oracle, column_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.operators.keyed import join_per_key
from loadkit.operators.shape import conform

# Source types and the Spark types they become. DECIMAL stands for DECIMAL(precision, scale).
ORACLE_TYPES = {
    "NUMBER": "DECIMAL",
    "VARCHAR2": "STRING",
    "CHAR": "STRING",
    "CLOB": "STRING",
    "LONG": "STRING",
    "DATE": "TIMESTAMP",
    "TIMESTAMP": "TIMESTAMP",
    "TIMESTAMP WITH TIME ZONE": "TIMESTAMP",
    "TIMESTAMP WITH LOCAL TIME ZONE": "TIMESTAMP",
    "FLOAT": "DOUBLE",
    "BINARY_FLOAT": "FLOAT",
    "BINARY_DOUBLE": "DOUBLE",
    "BLOB": "BINARY",
    "RAW": "BINARY",
    "BOOLEAN": "BOOLEAN",
    "INTERVAL YEAR TO MONTH": "STRING",
    "INTERVAL DAY TO SECOND": "STRING",
}
SQL_SERVER_TYPES = {
    "INT": "INT",
    "BIGINT": "BIGINT",
    "SMALLINT": "SMALLINT",
    "TINYINT": "TINYINT",
    "DECIMAL": "DECIMAL",
    "NUMERIC": "DECIMAL",
    "VARCHAR": "STRING",
    "NVARCHAR": "STRING",
    "CHAR": "STRING",
    "NCHAR": "STRING",
    "TEXT": "STRING",
    "NTEXT": "STRING",
    "DATETIME": "TIMESTAMP",
    "SMALLDATETIME": "TIMESTAMP",
    "DATE": "TIMESTAMP",
    "TIME": "TIMESTAMP",
    "DATETIME2": "TIMESTAMP",
    "BIT": "BOOLEAN",
    "FLOAT": "DOUBLE",
    "REAL": "DOUBLE",
    "VARBINARY": "BINARY",
    "BINARY": "BINARY",
    "IMAGE": "BINARY",
}
SYSTEMS = {"oracle": ORACLE_TYPES, "sqlserver": SQL_SERVER_TYPES}
# Fixed value: types that become BIGINT when the source gives no precision.
BIGINT_WITHOUT_PRECISION = ("NUMBER", "NUMERIC")


def _named(column: str, names: list[str] | None) -> Column:
    """Names in any letters, as catalogs differ in theirs."""
    return F.lit(True) if names is None else F.upper(column).isin([n.upper() for n in names])


def column_metadata_oracle(
    columns: DataFrame, comments: DataFrame, owner: str, tables: list[str] | None = None
) -> DataFrame:
    """Columns of an owner's tables, all or the named ones, with their comments, in column order."""
    wanted = columns.where((F.col("owner") == owner) & _named("table_name", tables))
    key = ["owner", "table_name", "column_name"]
    return (
        join_per_key(wanted, comments.select(*key, "comments"), key, "left")
        # The columns of source metadata, here and below.
        .select(
            "table_name",
            "column_name",
            "data_type",
            "data_length",
            "data_precision",
            "data_scale",
            "nullable",
            "identity_column",
            "comments",
            "column_id",
        )
        .orderBy("table_name", "column_id")
    )


def column_metadata_sqlserver(
    columns: DataFrame,
    tables: DataFrame,
    identity_columns: DataFrame,
    properties: DataFrame,
    owner: str,
    table_names: list[str] | None = None,
) -> DataFrame:
    """The same from SQL Server's catalog views; every join is by schema and table."""
    table = ["table_schema", "table_name"]
    wanted = columns.where((F.col("table_schema") == owner) & _named("table_name", table_names))
    identity = identity_columns.select(*table, F.col("name").alias("column_name"), F.lit("YES").alias("_identity"))
    noted = properties.select(*table, F.col("minor_id").alias("ordinal_position"), F.col("value").alias("comments"))
    listed = join_per_key(wanted, tables.select(*table), table, "inner")
    flagged = join_per_key(listed, identity, [*table, "column_name"], "left")
    return join_per_key(flagged, noted, [*table, "ordinal_position"], "left").select(
        "table_name",
        "column_name",
        "data_type",
        F.col("character_maximum_length").alias("data_length"),
        F.col("numeric_precision").alias("data_precision"),
        F.col("numeric_scale").alias("data_scale"),
        F.col("is_nullable").alias("nullable"),
        F.coalesce("_identity", F.lit("NO")).alias("identity_column"),
        "comments",
    )


def map_source_types(meta: DataFrame, system: str) -> DataFrame:
    """Add ``target_type``, and ``type_error`` where the source type is unknown."""
    if system not in SYSTEMS:
        raise ValueError(f"unknown system {system!r}, expected one of {sorted(SYSTEMS)}")
    source = F.upper("data_type")
    pairs = [F.lit(text) for pair in SYSTEMS[system].items() for text in pair]
    mapped = F.try_element_at(F.create_map(*pairs), source)
    precision = F.col("data_precision").cast("string")
    scale = F.coalesce(F.col("data_scale").cast("string"), F.lit("0"))
    decimal = F.concat(F.lit("DECIMAL("), F.coalesce(precision, F.lit("10")), F.lit(","), scale, F.lit(")"))
    target = (
        F.when(source.isin(*BIGINT_WITHOUT_PRECISION) & precision.isNull() & mapped.isNotNull(), "BIGINT")
        .when(mapped == "DECIMAL", decimal)
        .otherwise(mapped)
    )
    error = F.when(mapped.isNull(), F.concat(F.lit("Unsupported data type: "), F.coalesce(source, F.lit("null"))))
    return meta.withColumns({"target_type": target, "type_error": error})


def _yes(column: str) -> Column:
    return F.upper(column).isin("Y", "YES", "TRUE")


def columns_by_table(meta: DataFrame) -> DataFrame:
    """The columns of each table with their position from 1, one row per column."""
    order = Window.partitionBy("table_name").orderBy("column_id", "column_name")
    return meta.select(
        "table_name",
        F.row_number().over(order).alias("position"),
        "column_name",
        "data_type",
        _yes("nullable").alias("nullable"),
        _yes("identity_column").alias("identity_column"),
    )


def load_rules_from_metadata(meta: DataFrame) -> DataFrame:
    """What a load of each table should do, one row per setting and column.

    Every table has a schema check, each column that is not nullable a null
    check, and each identity column takes part in the hash key.
    """

    def setting(name: str, action: str | None) -> Column:
        return F.struct(F.lit(name).alias("setting"), F.lit(action).cast("string").alias("action"))

    wanted = F.array_compact(
        F.array(
            F.when(~_yes("nullable"), setting("null_check", "WARNING")),
            F.when(_yes("identity_column"), setting("hash_of", None)),
        )
    )
    per_column = meta.select("table_name", "column_name", "column_id", F.explode(wanted).alias("s")).select(
        "table_name", "s.setting", "column_name", "column_id", "s.action"
    )
    per_table = meta.select("table_name").distinct().select(
        "table_name",
        F.lit("schema_check").alias("setting"),
        F.lit(None).cast("string").alias("column_name"),
        F.lit(None).cast(meta.schema["column_id"].dataType).alias("column_id"),
        F.lit("ERROR").alias("action"),
    )
    return per_table.unionByName(per_column)


def table_settings(rules: DataFrame, table: str, hash_column: str = "hash_key") -> dict[str, list[dict]]:
    """Settings for one table's load, from the rows of ``load_rules_from_metadata``."""
    rows = rules.where(F.col("table_name") == table).orderBy("column_id", "column_name").collect()  # one table's columns
    by_setting = {s: [r["column_name"] for r in rows if r["setting"] == s] for s in ("null_check", "hash_of")}
    validations: list[dict] = [{"name": "schema_check", "action_on_unexpected": "ERROR"}]
    if by_setting["null_check"]:
        validations.append(
            {"name": "null_check", "action_on_unexpected": "WARNING", "columns": by_setting["null_check"]}
        )
    hashed = [{"column_name": hash_column, "data_type": "string", "hash_of": by_setting["hash_of"]}]
    return {
        "validations": validations,
        "table_columns_to_be_added": hashed if by_setting["hash_of"] else [],
    }


def conform_to_metadata(df: DataFrame, meta: DataFrame, system: str, on_error: str = "raise") -> DataFrame:
    """Project and cast a raw table to the types its metadata maps to, in the order of ``column_id``.

    ``meta`` describes that one table. Without ``column_id`` columns keep the table's order.
    """
    mapped = map_source_types(meta, system)
    ordered = mapped.orderBy("column_id", "column_name") if "column_id" in meta.columns else mapped
    rows = ordered.select("column_name", "target_type", "type_error").collect()  # one table's columns
    if "column_id" not in meta.columns:
        place = {c.lower(): i for i, c in enumerate(df.columns)}
        rows.sort(key=lambda r: place.get(r["column_name"].lower(), len(place)))
    errors = [f"{r['column_name']}: {r['type_error']}" for r in rows if r["type_error"]]
    if errors:
        raise ValueError("; ".join(errors))
    return conform(df, {r["column_name"]: {"data_type": r["target_type"]} for r in rows}, on_error)
