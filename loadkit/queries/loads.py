"""Whole loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.config import LoadConfig
from loadkit.plans.load import LoadResult, load_frame, run_load, run_sql_batch
from loadkit.queries.registry import query
from loadkit.queries.sources import sql_file
from loadkit.session import scratch_path, scratch_table
from loadkit.sources.registry import read_source


def _parts(table: str) -> dict[str, str]:
    catalog, schema, name = table.split(".")
    return {"target_catalog": catalog, "target_schema": schema, "target_table": name}


ORDERS_DDL = (
    "customer BIGINT, o_orderkey BIGINT, o_orderstatus STRING, o_orderpriority STRING, source_system STRING, "
    "row_hash STRING, loaded_at TIMESTAMP"
)


def load_orders(spark: SparkSession, sf: str, **settings) -> tuple[LoadResult, LoadConfig]:
    """Load each customer's newest order: filter, deduplicate, rename, hash, validate, gate, write."""
    target = scratch_table(spark, "newest_order")
    spark.sql(f"CREATE TABLE {target} ({ORDERS_DDL}) USING parquet")
    common = {
        "ingest_type": "parquet",
        "run_date": "1999-01-01",
        "audit_columns_to_be_added": [
            {"column_name": "source_system", "data_type": "string", "value": "unknown"},
            {"column_name": "row_hash", "data_type": "string", "hash_of": ["customer", "o_orderkey", "o_orderstatus"]},
            {"column_name": "loaded_at", "data_type": "timestamp", "function_name": "current_timestamp"},
        ],
    }
    own = {
        "source_location": f"{sf}/orders.parquet",
        "columns": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"],
        "where_clause": "o_orderdate < TIMESTAMP_NTZ '{run_date}'",
        "deduplication": {
            "keys": ["o_custkey"],
            "order_by": [
                {"column": "o_orderdate", "direction": "desc"},
                {"column": "o_orderkey", "direction": "desc"},
            ],
        },
        "column_mappings": {"o_custkey": "customer"},
        "custom_transformations": [lambda df: df.drop("o_orderdate")],
        "table_columns_to_be_added": [{"column_name": "source_system", "data_type": "string", "value": "erp"}],
        "validations": [
            {"name": "null_check", "columns": ["customer"], "action_on_unexpected": "ERROR"},
            {"name": "not_low", "expression": "o_orderpriority <> '5-LOW'", "action_on_unexpected": "WARNING"},
        ],
    }
    cfg = LoadConfig.from_layers(common, own, _parts(target), settings)
    return run_load(spark, cfg), cfg


LOADED_CTE = """WITH loaded AS (SELECT o_custkey AS customer, o_orderkey, o_orderstatus, o_orderpriority,
  sha256(concat_ws('_', CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), o_orderstatus)) AS row_hash
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01') x WHERE rn = 1)
"""
_LOADED = "customer, o_orderkey, o_orderstatus, o_orderpriority, row_hash"


@query(LOADED_CTE + f"""SELECT 'target' AS side, {_LOADED}, 'erp' AS source_system,
  'COMPLETED_WITH_VALIDATION_WARNING' AS run_status FROM loaded
UNION ALL SELECT 'quarantine', {_LOADED}, 'erp', 'COMPLETED_WITH_VALIDATION_WARNING' FROM loaded
WHERE o_orderpriority = '5-LOW'""")
def load_end_to_end(spark, sf):
    result, cfg = load_orders(spark, sf)
    cols = ["customer", "o_orderkey", "o_orderstatus", "o_orderpriority", "row_hash", "source_system"]

    def side(name: str, table: str) -> DataFrame:
        return spark.table(table).select(F.lit(name).alias("side"), *cols)

    both = side("target", cfg.target).unionByName(side("quarantine", cfg.quarantine))
    return both.withColumn("run_status", F.lit(result.status))


@query("SELECT c_custkey AS customer, c_name AS called, c_mktsegment AS segment, 'COMPLETED' AS run_status FROM customer")
def load_renamed_with_schema_check(spark, sf):
    """Names of the file, of the schema and of the target differ; the schema is checked as the file has it."""
    target = scratch_table(spark, "customers")
    spark.sql(f"CREATE TABLE {target} (customer BIGINT, called STRING, segment STRING) USING orc")
    schema = {
        "customer": {"data_type": "long", "source_column_name": "c_custkey"},
        "name": {"data_type": "string", "source_column_name": "c_name"},
        "segment": {"data_type": "string", "source_column_name": "c_mktsegment"},
    }
    cfg = LoadConfig.from_layers(
        {"ingest_type": "parquet", "source_location": f"{sf}/customer.parquet", "schema": schema},
        {"columns": ["c_custkey", "c_name", "c_mktsegment"], "column_mappings": {"name": "called"}},
        {"validations": [{"name": "schema_check", "action_on_unexpected": "ERROR"}]},
        _parts(target),
    )
    result = run_load(spark, cfg)
    return spark.table(target).withColumn("run_status", F.lit(result.status))


@query("""SELECT CASE WHEN COUNT(*) = 0 THEN 'COMPLETED_WITH_ZERO' ELSE 'COMPLETED' END AS run_status,
  COUNT(*) AS table_rows FROM orders WHERE o_totalprice < 0""")
def empty_source_status(spark, sf):
    result, cfg = load_orders(
        spark, sf, columns=["o_orderkey", "o_custkey", "o_totalprice"], where_clause="o_totalprice < 0"
    )
    return spark.table(cfg.target).agg(F.count("*").alias("table_rows")).withColumn("run_status", F.lit(result.status))


@query("""WITH by_customer AS (SELECT o_custkey, COUNT(*) AS n_orders, MAX(o_orderkey) AS newest FROM orders GROUP BY o_custkey)
SELECT 'by_customer' AS step, o_custkey AS id, n_orders AS n FROM by_customer
UNION ALL SELECT 'by_count', n_orders, COUNT(*) FROM by_customer GROUP BY n_orders""")
def sql_batch(spark, sf):
    first, second = scratch_table(spark, "by_customer"), scratch_table(spark, "by_count")
    spark.sql(f"CREATE TABLE {first} (o_custkey BIGINT, n_orders BIGINT, newest BIGINT) USING parquet")
    spark.sql(f"CREATE TABLE {second} (n_orders BIGINT, customers BIGINT) USING parquet")
    by_customer = (
        "SELECT o_custkey, COUNT(*) AS n_orders, MAX(o_orderkey) AS newest "
        "FROM parquet.`{folder}/orders.parquet` GROUP BY o_custkey"
    )
    by_count = "SELECT n_orders, COUNT(*) AS customers FROM {first} GROUP BY n_orders"
    steps = [
        {
            "name": "step_1",
            "sql_file_location": sql_file(spark, "by_customer.sql", by_customer),
            "validations": [{"name": "null_check", "columns": ["o_custkey"], "action_on_unexpected": "ERROR"}],
            **_parts(first),
        },
        {"name": "step_2", "sql_file_location": sql_file(spark, "by_count.sql", by_count), **_parts(second)},
    ]
    run_sql_batch(spark, steps, {"folder": sf, "first": first})
    rows = spark.table(first).select(F.lit("by_customer").alias("step"), F.col("o_custkey").alias("id"), F.col("n_orders").alias("n"))
    return rows.unionByName(
        spark.table(second).select(F.lit("by_count").alias("step"), F.col("n_orders").alias("id"), F.col("customers").alias("n"))
    )


@query("""WITH months AS (SELECT unnest(range(date_trunc('month', MIN(o_orderdate)), MAX(o_orderdate) + INTERVAL 1 MICROSECOND,
  INTERVAL 1 MONTH)) AS m FROM orders)
SELECT 'read' AS kind, o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS run_day FROM orders
WHERE month(o_orderdate) % 3 <> 0
UNION ALL SELECT 'missing', 0, strftime(m, '%Y-%m-%d') FROM months WHERE month(m) % 3 = 0""")
def read_dated_gaps(spark, sf):
    """A backfill over every month of the orders, of which every third has no folder: the load names those."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    base, target = scratch_path(spark, "landing/"), scratch_table(spark, "backfilled")
    spark.sql(f"CREATE TABLE {target} (o_orderkey BIGINT, run_day DATE) USING parquet")
    landed = orders.where(F.month("o_orderdate") % 3 != 0)
    landed = landed.select("o_orderkey", F.date_format(F.trunc("o_orderdate", "month"), "yyyyMMdd'.parquet'").alias("orders"))
    landed.hint("rebalance", "orders").write.partitionBy("orders").parquet(base + "sales")
    first, last = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    months = [f"{m // 12}-{m % 12 + 1:02}-01" for m in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)]
    own = {
        "ingest_type": "parquet",
        "run_dates": months,
        "source_base_location": base,
        "source_reference_location": "sales/",
        "source_file_name_prefix": "orders=",
        "source_file_name_date_pattern": "{year}{month}{day}",
        "source_file_extension": ".parquet",
        "run_date_column": "run_day",
        "missing_dates": "skip",
    }
    result = run_load(spark, LoadConfig.from_layers(own, _parts(target)))
    gaps = spark.createDataFrame([(d,) for d in result.missing_dates], "run_day string")
    read = spark.table(target).select(F.lit("read").alias("kind"), "o_orderkey", F.col("run_day").cast("string").alias("run_day"))
    return read.unionByName(gaps.select(F.lit("missing").alias("kind"), F.lit(0).cast("bigint").alias("o_orderkey"), "run_day"))


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'first' ELSE 'second' END AS load_run,
  'COMPLETED' AS run_status FROM orders""")
def load_restarted(spark, sf):
    """Two loads; the first had written its rows but not noted its end when it was started again."""
    target = scratch_table(spark, "orders_by_load")
    spark.sql(f"CREATE TABLE {target} (o_orderkey BIGINT, o_custkey BIGINT, load_run STRING) USING parquet PARTITIONED BY (load_run)")
    statuses = []
    for run, rows in (("first", "= 'F'"), ("second", "<> 'F'")):
        own = {
            "ingest_type": "parquet",
            "source_location": f"{sf}/orders.parquet",
            "columns": ["o_orderkey", "o_custkey", "o_orderstatus"],
            "where_clause": f"o_orderstatus {rows}",
            "custom_transformations": [lambda df: df.drop("o_orderstatus")],
            "run_id": run,
        }
        cfg = LoadConfig.from_layers(own, _parts(target))
        if run == "first":
            load_frame(spark, read_source(spark, cfg), cfg, run)
        statuses.append(run_load(spark, cfg).status)
    return spark.table(target).withColumn("run_status", F.lit("/".join(sorted(set(statuses)))))
