"""Tables and SQL text as sources."""

from __future__ import annotations

import re
from typing import Any

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from loadkit.config import render
from loadkit.sources.files import check_extension

# The commands a load may run, and the node that Spark's parser gives them.
COMMAND_NODES = {
    "InsertIntoStatement": "INSERT",
    "UpdateTable": "UPDATE",
    "MergeIntoTable": "MERGE",
    "Create": "CREATE",
}
# Nodes a query can begin with.
QUERY_NODES = (
    "Project", "Aggregate", "Sort", "GlobalLimit", "LocalLimit", "Offset", "Distinct", "Deduplicate", "Union", "Except",
    "Intersect", "Join", "Filter", "UnresolvedHaving", "UnresolvedRelation", "UnresolvedInlineTable", "LocalRelation",
    "OneRowRelation", "SubqueryAlias", "UnresolvedSubqueryColumnAliases", "UnresolvedTableValuedFunction",
    "UnresolvedHint", "Repartition", "RepartitionByExpression", "RebalancePartitions", "WithWindowDefinition", "Window",
    "Pivot", "Unpivot", "UnresolvedUnpivot", "Sample", "Generate", "LateralJoin", "Transform",
)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _explain(spark: SparkSession, text: str) -> str:
    return spark.sql(f"EXPLAIN EXTENDED {text}").first()[0]


def statement_class(spark: SparkSession, text: str) -> str:
    """SELECT, INSERT, UPDATE, MERGE or CREATE; anything else raises ``ValueError``.

    Spark's parser decides, through EXPLAIN, which runs nothing. Text with more
    than one statement does not parse.
    """
    try:
        plan = _explain(spark, text)
    except ParseException as error:
        raise ValueError(f"Failed to parse SQL: {error}") from error
    lines = plan.splitlines()
    if not lines[0].startswith("== Parsed"):
        raise ValueError(f"statement is not supported by the table it writes to: {plan.strip()[:500]}")
    nodes = [re.match(r"[\s:+-]*'?(\w*)", line)[1] for line in lines[1 : lines.index("")]]
    nodes = [n for n in nodes if n]
    # WITH in front of a statement: what stands under it, after the named queries' own nodes, if it is a command
    commands = [n for n in nodes if n.startswith((*COMMAND_NODES, "InsertIntoDir", "DeleteFromTable"))]
    root = commands[0] if nodes[0] in ("CTE", "UnresolvedWith") and commands else nodes[0]
    for node, verb in COMMAND_NODES.items():
        if root.startswith(node):
            return verb
    if root in QUERY_NODES or root in ("CTE", "UnresolvedWith"):
        return "SELECT"
    raise ValueError(f"Disallowed SQL operation detected: {root}")


def run_sql(spark: SparkSession, text: str, args: dict[str, Any] | None = None) -> DataFrame | None:
    """Run one allowed statement. Only a query gives a frame; a command gives ``None``."""
    verb = statement_class(spark, text)
    result = spark.sql(text, args=args)
    return result if verb == "SELECT" else None


def read_sql(
    spark: SparkSession, template: str, values: dict[str, Any] | None = None, args: dict[str, Any] | None = None
) -> DataFrame:
    """Run a query whose ``{placeholders}`` are filled from ``values``.

    Literals are better passed as ``:name`` parameters in ``args``.
    """
    try:
        return spark.sql(render(template, values or {}, strict=True), args=args)
    except Exception as error:
        raise ValueError(f"failed to render or run the source query: {error}") from error


def read_sql_file(
    spark: SparkSession, path: str, values: dict[str, Any] | None = None, args: dict[str, Any] | None = None
) -> DataFrame | None:
    """Run the one statement of a ``.sql`` file."""
    return run_sql(spark, render(sql_file_text(spark, path), values or {}), args)


def sql_file_text(spark: SparkSession, path: str) -> str:
    check_extension(path, "sql")
    texts = spark.read.text(path, wholetext=True).take(2)
    if len(texts) != 1:
        raise ValueError(f"{path} must hold one SQL file")
    return texts[0][0]


def sql_on(df: DataFrame, text: str) -> DataFrame:
    """Run SQL that names the frame as ``{source_data}``."""
    return df.sparkSession.sql(text, source_data=df)
