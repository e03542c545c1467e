"""Validation of all orders, with flaws that follow from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.operators import validation as V
from loadkit.plans.gate import gate, store
from loadkit.queries.registry import query, table
from loadkit.session import scratch_table
from loadkit.sinks.tables import append_evolving

RAW_CTE = """WITH raw AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'n/a' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END
  AS price_txt, o_orderpriority AS priority FROM orders),
issues AS (
  SELECT o_orderkey, 'null_check' AS rule, 'status' AS checked, 'WARNING' AS action FROM raw WHERE status IS NULL
  UNION ALL SELECT o_orderkey, 'type_check', 'price_txt', 'ERROR' FROM raw
            WHERE price_txt IS NOT NULL AND TRY_CAST(price_txt AS BIGINT) IS NULL
  UNION ALL SELECT o_orderkey, 'not_low', 'priority <> ''5-LOW''', 'WARNING' FROM raw WHERE NOT (priority <> '5-LOW'))
"""


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    price = F.floor("o_totalprice").cast("string")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "n/a").otherwise(price).alias("price_txt"),
        F.col("o_orderpriority").alias("priority"),
    )


NULLS = V.null_check(["status"])
TYPES = V.type_check({"price_txt": "bigint"})
NOT_LOW = V.expression_check("not_low", "priority <> '5-LOW'", V.WARNING)
# Names and types that depart from the frame's: a missing column and another type.
DECLARED = {
    "o_orderkey": {"data_type": "int"},
    "status": {"data_type": "string"},
    "price_txt": {"data_type": "string"},
    "region": {"data_type": "string"},
}


def _issues(result: V.ValidationResult) -> DataFrame:
    rows = result.issue_rows.select("o_orderkey", F.explode(V.ISSUES).alias("i"))
    return rows.select("o_orderkey", "i.rule", F.col("i.column").alias("checked"), "i.action")


def _summary(result: V.ValidationResult) -> DataFrame:
    return result.summary.select("rule", F.col("column").alias("checked"), "action", "failed_rows")


@query(RAW_CTE + "SELECT o_orderkey, rule, checked, action FROM issues")
def validation_issues(spark, sf):
    return _issues(V.run_validations(raw_orders(spark, sf), [NULLS, TYPES, NOT_LOW]))


@query(RAW_CTE + "SELECT rule, checked, action, COUNT(*) AS failed_rows FROM issues GROUP BY rule, checked, action")
def validation_summary(spark, sf):
    return _summary(V.run_validations(raw_orders(spark, sf), [NULLS, TYPES, NOT_LOW]))


@query(RAW_CTE + "SELECT o_orderkey, rule, checked, action FROM issues WHERE rule = 'null_check'")
def validate_null_check(spark, sf):
    return _issues(V.run_validations(raw_orders(spark, sf), [NULLS]))


@query(RAW_CTE + "SELECT o_orderkey, rule, checked, action FROM issues WHERE rule = 'type_check'")
def validate_type_check(spark, sf):
    return _issues(V.run_validations(raw_orders(spark, sf), [TYPES]))


@query(RAW_CTE + "SELECT o_orderkey, rule, checked, action FROM issues WHERE rule = 'not_low'")
def validate_expression(spark, sf):
    return _issues(V.run_validations(raw_orders(spark, sf), [NOT_LOW]))


@query(RAW_CTE + """SELECT 'schema_check' AS rule, 'o_orderkey: expected int, found bigint' AS checked, 'ERROR' AS action,
COUNT(*) AS failed_rows FROM raw
UNION ALL SELECT 'schema_check', 'region: expected string, found nothing', 'ERROR', COUNT(*) FROM raw""")
def validate_schema_check(spark, sf):
    return _summary(V.run_validations(raw_orders(spark, sf), [V.schema_check(DECLARED)]))


def _gated(spark: SparkSession, sf: str, rules: list[V.Rule]) -> DataFrame:
    """Rows that pass the gate and rows that go to quarantine, with the run's status."""
    raw = raw_orders(spark, sf)
    result, n_rows = store(V.run_validations(raw, rules), scratch_table(spark, "checked"))
    verdict = gate(result, result.summary.collect(), n_rows)
    cols = ["o_orderkey", "status", "price_txt", "priority"]
    sides = {"target": verdict.to_target, "quarantine": verdict.to_quarantine}
    parts = [df.select(F.lit(side).alias("side"), *cols) for side, df in sides.items() if df is not None]
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.withColumn("run_status", F.lit(verdict.status))


_COLS = "o_orderkey, status, price_txt, priority"


@query(RAW_CTE + f"SELECT 'target' AS side, {_COLS}, 'COMPLETED' AS run_status FROM raw")
def gate_clean(spark, sf):
    return _gated(spark, sf, [V.null_check(["o_orderkey", "priority"], V.ERROR), V.type_check({"o_orderkey": "long"})])


@query(RAW_CTE + f"""SELECT 'target' AS side, {_COLS}, 'COMPLETED_WITH_VALIDATION_WARNING' AS run_status FROM raw
UNION ALL SELECT 'quarantine', {_COLS}, 'COMPLETED_WITH_VALIDATION_WARNING' FROM raw
WHERE status IS NULL OR priority = '5-LOW'""")
def gate_warning(spark, sf):
    return _gated(spark, sf, [NULLS, NOT_LOW])


@query(RAW_CTE + f"""SELECT 'quarantine' AS side, {_COLS}, 'COMPLETED_WITH_VALIDATION_ERROR' AS run_status FROM raw
WHERE status IS NULL OR price_txt = 'n/a'""")
def gate_error(spark, sf):
    return _gated(spark, sf, [NULLS, TYPES])


@query(RAW_CTE + "SELECT o_orderkey, COUNT(*) AS n_issues FROM issues GROUP BY o_orderkey")
def quarantine_append(spark, sf):
    name = scratch_table(spark, "quarantine")
    append_evolving(V.run_validations(raw_orders(spark, sf), [NULLS, TYPES, NOT_LOW]).issue_rows, name)
    return spark.table(name).select("o_orderkey", F.size(V.ISSUES).cast("bigint").alias("n_issues"))


def _set_issues(spark: SparkSession, sf: str, rule: V.Rule) -> DataFrame:
    return _issues(V.run_validations(table(spark, sf, "orders"), [rule]))


@query("""SELECT o_orderkey, 'unique_check' AS rule, 'o_custkey, o_orderdate' AS checked, 'WARNING' AS action FROM orders
WHERE (o_custkey, o_orderdate) IN (SELECT (o_custkey, o_orderdate) FROM orders GROUP BY o_custkey, o_orderdate HAVING COUNT(*) > 1)""")
def validate_unique(spark, sf):
    return _set_issues(spark, sf, V.unique_check(["o_custkey", "o_orderdate"], V.WARNING))


@query("""SELECT o_orderkey, 'reference_check' AS rule, 'o_custkey' AS checked, 'ERROR' AS action FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")
def validate_reference(spark, sf):
    """Orders of customers who are not in credit."""
    return _set_issues(spark, sf, V.reference_check(["o_custkey"], table(spark, sf, "customer").where("c_acctbal >= 0"), ["c_custkey"]))


@query("""SELECT o_orderkey, 'few_orders' AS rule, 'count(*) <= 12 by o_custkey' AS checked, 'ERROR' AS action FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING COUNT(*) > 12)""")
def validate_aggregate(spark, sf):
    return _set_issues(spark, sf, V.aggregate_check("few_orders", "count(*) <= 12", ["o_custkey"]))


@query("""WITH flawed AS (SELECT *, COUNT(*) OVER (PARTITION BY o_custkey, o_orderdate) > 1 AS again FROM orders)
SELECT 'target' AS side, o_orderkey, 'COMPLETED_WITH_VALIDATION_WARNING' AS run_status FROM flawed
UNION ALL SELECT 'quarantine', o_orderkey, 'COMPLETED_WITH_VALIDATION_WARNING' FROM flawed WHERE again""")
def gate_set_rules(spark, sf):
    """A reference that holds, and a uniqueness that does not, through the gate."""
    orders = table(spark, sf, "orders")
    rules = [
        V.unique_check(["o_custkey", "o_orderdate"], V.WARNING),
        V.reference_check(["o_custkey"], table(spark, sf, "customer"), ["c_custkey"]),
    ]
    result, n_rows = store(V.run_validations(orders, rules), scratch_table(spark, "checked"))
    verdict = gate(result, result.summary.collect(), n_rows)
    sides = {"target": verdict.to_target, "quarantine": verdict.to_quarantine}
    parts = [df.select(F.lit(side).alias("side"), "o_orderkey") for side, df in sides.items() if df is not None]
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.withColumn("run_status", F.lit(verdict.status))
