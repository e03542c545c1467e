"""Projection, filter, rename, cast, derived columns, deduplication, SQL over frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadkit.functions import columns as C
from loadkit.operators import shape
from loadkit.queries.registry import query, table
from loadkit.sources import sql


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def select_columns(spark, sf):
    return shape.select_columns(table(spark, sf, "orders"), ["o_orderkey", "o_orderstatus"])


@query("SELECT o_orderkey, o_custkey FROM orders")
def select_existing(spark, sf):
    return shape.select_existing(table(spark, sf, "orders"), ["o_orderkey", "updated_at", "o_custkey"])


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def drop_columns(spark, sf):
    return shape.drop_columns(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey", "no_such_column"])


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 25")
def where_clause(spark, sf):
    lines = table(spark, sf, "lineitem")
    return shape.where(lines, "l_returnflag = 'R' AND l_quantity > 25").select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01'")
def where_template(spark, sf):
    orders = shape.select_existing(table(spark, sf, "orders"), ["o_orderkey", "o_totalprice", "o_orderdate"])
    kept = shape.where_template(orders, "o_orderdate >= TIMESTAMP_NTZ '{run_date}'", {"run_date": "1997-06-01"})
    return kept.drop("o_orderdate")


@query("SELECT p_partkey AS part_id, p_name AS name, p_brand, p_type, p_size FROM part")
def rename_columns(spark, sf):
    part = table(spark, sf, "part").drop("p_retailprice")
    return shape.rename_columns(part, {"p_partkey": "part_id", "p_name": "name", "absent": "x", "p_size": "p_size"})


@query(
    "SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS order_ref, o_orderstatus AS status, "
    "CAST(o_custkey AS DOUBLE) AS cust FROM orders"
)
def transform_columns(spark, sf):
    mapping = [
        {"source_column": "o_orderkey", "target_column": "order_ref", "target_data_type": "string"},
        {"source_column": "o_orderstatus", "target_column": "status"},
        {"source_column": "o_custkey", "target_column": "cust", "target_data_type": "double"},
    ]
    df = shape.transform_columns(table(spark, sf, "orders"), mapping)
    return df.select("o_orderkey", "order_ref", "status", "cust")


@query(
    "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey AS customer, "
    "CASE WHEN o_orderpriority = '1-URGENT' THEN -1 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS price FROM orders"
)
def conform_schema(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ORDER_NO"),
        F.col("o_custkey").cast("string").alias("CUST"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "n/a")
        .otherwise(F.floor("o_totalprice").cast("string"))
        .alias("PRICE"),
    )
    schema = {
        "id": {"data_type": "string", "source_column_name": "ORDER_NO"},
        "customer": {"data_type": "long", "source_column_name": "CUST"},
        "price": {"data_type": "decimal", "precision": 18, "scale": 0, "source_column_name": "PRICE"},
        "row_hash": {"data_type": "string", "derived_column": "True"},
    }
    df = shape.conform(raw, schema, on_error="null")
    return df.withColumn("price", F.coalesce(F.col("price").cast("bigint"), F.lit(-1).cast("bigint")))


@query("SELECT c_custkey, c_name, 'obs' AS source_system, CAST(7 AS BIGINT) AS batch FROM customer")
def add_literal(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name")
    return C.add_literal(C.add_literal(df, "source_system", "obs"), "batch", "7", "long")


@query("SELECT COUNT(*) AS stamped, CAST(1 AS BIGINT) AS stamps, TRUE AS is_now FROM customer")
def add_timestamp(spark, sf):
    """Every row has the time of its statement, the same for all."""
    stamped = C.add_current_timestamp(table(spark, sf, "customer").select("c_custkey"), "inserted_time")
    return stamped.agg(
        F.count("inserted_time").alias("stamped"),
        F.countDistinct("inserted_time").alias("stamps"),
        (F.abs(F.unix_timestamp(F.max("inserted_time")) - F.unix_timestamp(F.current_timestamp())) < 3600).alias("is_now"),
    )


@query(
    "SELECT o_orderkey, sha256(concat_ws('_', CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority)) "
    "AS row_hash FROM orders"
)
def add_hash(spark, sf):
    df = C.add_hash(table(spark, sf, "orders"), "row_hash", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    return df.select("o_orderkey", "row_hash")


@query(
    "SELECT c_custkey, 'crm' AS source_system, sha256(concat_ws('_', c_name, c_mktsegment)) AS name_hash, "
    "sha256(concat_ws('_', sha256(concat_ws('_', c_name, c_mktsegment)), 'crm')) AS row_hash FROM customer"
)
def derived_columns(spark, sf):
    specs = [
        {"column_name": "source_system", "data_type": "string", "value": "crm"},
        {"column_name": "name_hash", "data_type": "string", "function_name": "hash", "hash_of": ["c_name", "c_mktsegment"]},
        {"column_name": "row_hash", "data_type": "string", "hash_of": ["name_hash", "source_system"]},
        {"column_name": "inserted_time", "data_type": "timestamp", "function_name": "current_timestamp"},
    ]
    df = C.add_derived_columns(table(spark, sf, "customer"), specs)
    return df.select("c_custkey", "source_system", "name_hash", "row_hash")


@query(
    "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) x WHERE rn = 1"
)
def dedup_latest(spark, sf):
    order_by = [{"column": "o_orderdate", "direction": "desc"}, {"column": "o_orderkey", "direction": "desc"}]
    df = shape.dedup_latest(table(spark, sf, "orders"), ["o_custkey"], order_by)
    return df.select("o_custkey", "o_orderkey", "o_orderstatus")


@query(
    "SELECT o_custkey, upper(o_orderpriority) AS priority, o_orderkey * 10 AS ref, "
    "CASE WHEN o_totalprice > 100000 THEN 'big' ELSE 'small' END AS size FROM orders"
)
def custom_transforms(spark, sf):
    steps = [
        lambda df: df.withColumn("priority", F.upper("o_orderpriority")),
        {"ref": "o_orderkey * 10", "size": "CASE WHEN o_totalprice > 100000 THEN 'big' ELSE 'small' END"},
        lambda df: df.select("o_custkey", "priority", "ref", "size"),
    ]
    return shape.apply_transforms(table(spark, sf, "orders"), steps)


@query(
    "SELECT l_suppkey, COUNT(*) AS n_lines, CAST(SUM(l_linenumber) AS BIGINT) AS n FROM lineitem GROUP BY l_suppkey"
)
def sql_on_dataframe(spark, sf):
    return sql.sql_on(
        table(spark, sf, "lineitem"),
        "SELECT l_suppkey, COUNT(*) AS n_lines, SUM(l_linenumber) AS n FROM {source_data} GROUP BY l_suppkey",
    )


PASSTHROUGH = """
SELECT n_name, o_orderstatus, COUNT(*) AS n_lines, CAST(SUM(l_linenumber) AS BIGINT) AS n,
       COUNT(DISTINCT c_custkey) AS customers
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
JOIN {customer} ON o_custkey = c_custkey
JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
GROUP BY GROUPING SETS ((n_name, o_orderstatus), (n_name))
"""
_PASSTHROUGH_TABLES = ["lineitem", "orders", "customer", "nation", "region"]


@query("SELECT n_name, COALESCE(o_orderstatus, 'all') AS o_orderstatus, n_lines, n, customers FROM ("
       + PASSTHROUGH.format(**{t: t for t in _PASSTHROUGH_TABLES}) + ") x")
def sql_passthrough(spark, sf):
    paths = {t: f"parquet.`{sf}/{t}.parquet`" for t in _PASSTHROUGH_TABLES}
    df = sql.read_sql(spark, PASSTHROUGH, paths)
    return df.withColumn("o_orderstatus", F.coalesce("o_orderstatus", F.lit("all")))
