"""What a validation lets through."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from loadkit.operators import ledger
from loadkit.operators.validation import ISSUES, ValidationResult, has_error
from loadkit.session import scratch_table
from loadkit.sinks.tables import write_table


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def final_status(summary: list[Row], n_rows: int) -> str:
    """Status of a finished run from its failed rules and its row count."""
    if n_rows == 0:
        return ledger.COMPLETED_WITH_ZERO
    if has_error(summary):
        return ledger.COMPLETED_WITH_VALIDATION_ERROR
    return ledger.COMPLETED_WITH_VALIDATION_WARNING if summary else ledger.COMPLETED


@dataclass(frozen=True)
class Gate:
    to_target: DataFrame | None
    to_quarantine: DataFrame | None
    status: str


def gate(result: ValidationResult, summary: list[Row], n_rows: int) -> Gate:
    """Without a failed ERROR rule every row goes to the target, warned ones too; with one, none does.

    Failing rows go to quarantine either way. ``summary`` is the collected
    ``result.summary``: one row per failed rule and column.
    """
    status = final_status(summary, n_rows)
    blocked = has_error(summary)
    return Gate(
        to_target=None if blocked or n_rows == 0 else result.checked.drop(ISSUES),
        to_quarantine=result.issue_rows if summary else None,
        status=status,
    )


def store(result: ValidationResult, table: str) -> tuple[ValidationResult, int]:
    """Run the validation once into a table; the result read from there, and its row count.

    A flag beside the issues lets the scan for issue rows skip clean row groups.
    """
    spark = result.checked.sparkSession
    rows = write_table(result.checked.withColumn("_flawed", F.col(ISSUES).isNotNull()), table, "errorifexists")
    stored = spark.table(table)
    return ValidationResult(stored.drop("_flawed"), stored.where("_flawed").drop("_flawed"), result.checks), rows


@contextmanager
def stored(result: ValidationResult) -> Iterator[tuple[ValidationResult, int]]:
    """The result in a scratch table, so that verdict, target and quarantine see the same rows.

    The table is in the shared folder: a lost executor costs no second source scan.
    """
    spark = result.checked.sparkSession
    table = scratch_table(spark, "checked")
    try:
        yield store(result, table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
