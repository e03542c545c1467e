"""Writes to catalog tables, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadkit.queries.registry import query, table
from loadkit.session import scratch_table
from loadkit.sinks import tables as sinks


@query("SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def sink_append(spark, sf):
    name = scratch_table(spark, "people")
    sinks.write_table(table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name"), name)
    # Columns in another order: they are matched by name.
    sinks.append_table(table(spark, sf, "supplier").selectExpr("s_name AS name", "s_suppkey AS id"), name)
    return spark.table(name)


@query("SELECT o_orderkey, upper(lower(o_orderpriority)) || '!' AS o_orderpriority FROM orders")
def sink_overwrite(spark, sf):
    name = scratch_table(spark, "orders")
    sinks.write_table(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), name)
    changed = spark.table(name).withColumn("o_orderpriority", F.concat("o_orderpriority", F.lit("!")))
    sinks.write_table(changed, name, "overwrite")
    return spark.table(name)


@query(
    "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders "
    "UNION ALL SELECT o_orderkey, 'again', o_orderstatus FROM orders"
)
def sink_partitioned(spark, sf):
    name = scratch_table(spark, "orders")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    sinks.write_table(orders, name, partition_by=["o_orderstatus"])
    again = orders.withColumn("o_orderpriority", F.lit("again"))
    sinks.write_table(again, name, partition_by=["o_orderstatus"])
    return spark.table(name)


@query(
    "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, '-' AS nation FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, '-', CAST(s_nationkey AS VARCHAR) FROM supplier"
)
def sink_evolving(spark, sf):
    name = scratch_table(spark, "people")
    customers = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    suppliers = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS name", "CAST(s_nationkey AS string) AS nation"
    )
    sinks.append_evolving(customers, name)
    sinks.append_evolving(suppliers, name)
    return spark.table(name).fillna("-", ["segment", "nation"])


@query(
    "SELECT 'customer' AS kind, CAST(CAST(c_custkey AS DECIMAL(21,2)) AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS code FROM customer "
    "UNION ALL SELECT 'supplier', CAST(CAST(s_suppkey + 5000000000 AS DECIMAL(21,2)) AS VARCHAR), CAST(s_nationkey AS VARCHAR) FROM supplier "
    "UNION ALL SELECT 'part', CAST(CAST(p_partkey + 0.25 AS DECIMAL(21,2)) AS VARCHAR), p_brand FROM part"
)
def sink_evolving_types(spark, sf):
    """One column goes from int to long to decimal, another from int to text; the rows that are there already keep their values."""
    name = scratch_table(spark, "parties")
    frames = (
        table(spark, sf, "customer").selectExpr("'customer' AS kind", "CAST(c_custkey AS int) AS id", "CAST(c_nationkey AS int) AS code"),
        table(spark, sf, "supplier").selectExpr("'supplier' AS kind", "CAST(s_suppkey + 5000000000 AS bigint) AS id", "CAST(s_nationkey AS smallint) AS code"),
        table(spark, sf, "part").selectExpr("'part' AS kind", "CAST(p_partkey + 0.25 AS decimal(12,2)) AS id", "p_brand AS code"),
    )
    for frame in frames:
        sinks.append_evolving(frame, name)
    return spark.table(name).select("kind", F.col("id").cast("string"), "code")


def _counts(spark, name, **counts):
    """Counts taken on the way, next to the rows the table really has."""
    held = spark.table(name).agg(F.count("*").alias("table_rows"))
    return held.withColumns({k: F.lit(n).cast("bigint") for k, n in counts.items()})


@query("SELECT COUNT(*) AS source_rows, COUNT(*) AS written_rows, COUNT(*) AS table_rows FROM lineitem")
def row_counts(spark, sf):
    name = scratch_table(spark, "lineitem")
    lines, seen = sinks.counted(table(spark, sf, "lineitem"), "source")
    written = sinks.write_table(lines, name)
    return _counts(spark, name, source_rows=seen.get["rows"], written_rows=written)


@query("SELECT COUNT(*) AS would_write, CAST(0 AS BIGINT) AS table_rows FROM orders")
def dry_run(spark, sf):
    name = scratch_table(spark, "orders")
    orders = table(spark, sf, "orders")
    spark.createDataFrame([], orders.schema).write.saveAsTable(name)
    return _counts(spark, name, would_write=sinks.append_table(orders, name, dry_run=True))


ORC_SQL = """SELECT COUNT(*) AS table_rows, CAST(SUM(id) AS BIGINT) AS ids, 'orc' AS format, 'people' AS comment
FROM (SELECT c_custkey AS id FROM customer UNION ALL SELECT {ids} FROM supplier) x"""


def _orc(spark, sf) -> str:
    name = scratch_table(spark, "people")
    spark.sql(f"CREATE TABLE {name} (id BIGINT, name STRING) USING orc COMMENT 'people'")
    sinks.append_table(table(spark, sf, "customer").selectExpr("c_name AS name", "c_custkey AS id"), name)
    return name


def _described(spark, name):
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return spark.table(name).agg(F.count("*").alias("table_rows"), F.sum("id").alias("ids")).withColumns(
        {"format": F.lit(details["Provider"].lower()), "comment": F.lit(details["Comment"])}
    )


@query(ORC_SQL.format(ids="s_suppkey"))
def sink_append_orc(spark, sf):
    name = _orc(spark, sf)
    sinks.append_table(table(spark, sf, "supplier").selectExpr("s_name AS name", "s_suppkey AS id"), name)
    return _described(spark, name)


@query(ORC_SQL.format(ids="-s_suppkey"))
def sink_overwrite_orc(spark, sf):
    name = _orc(spark, sf)
    more = table(spark, sf, "supplier").selectExpr("-s_suppkey AS id", "s_name AS name")
    sinks.write_table(spark.table(name).unionByName(more), name, "overwrite")
    return _described(spark, name)


@query(ORC_SQL.format(ids="s_suppkey"))
def sink_evolving_orc(spark, sf):
    name = _orc(spark, sf)
    sinks.append_evolving(table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_nationkey AS nation"), name)
    return _described(spark, name)
