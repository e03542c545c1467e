"""Appends that a retry cannot double.

A table whose first partition column is ``load_run`` keeps the rows of each load
in partitions of their own. A load overwrites only these, so doing it again
replaces its rows, whether the first try stopped before, during or after its
write. A record of finished loads beside the table saves a retry the work.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.sinks.tables import _create, _exists, _gathered, _observed, partition_columns

RUN = "load_run"


def run_value(load_id: str) -> str:
    """A load's id as a partition value: itself, or its hash where a folder or a statement could misread it."""
    if not load_id:
        raise ValueError("an append that happens once needs the id of its load")
    return load_id if re.fullmatch(r"[A-Za-z0-9_.-]+", load_id) else hashlib.sha256(load_id.encode()).hexdigest()


def keeps_runs(spark: SparkSession, table: str, partition_by: list[str] | None = None) -> bool:
    """Whether the table, or the one to be made with ``partition_by``, keeps loads apart."""
    parts = partition_columns(spark, table) if _exists(spark, table) else partition_by or []
    return parts[:1] == [RUN]


def _record(table: str) -> str:
    return f"{table}__loads"


def _publish(rows: DataFrame, table: str, run: str) -> int:
    """Replace the partitions of one load, by name; the number of rows.

    The load's value is given in the statement: Spark then removes that value's
    partitions alone, under any overwrite mode.
    """
    spark = rows.sparkSession
    parts = partition_columns(spark, table)
    wanted = [c for c in spark.table(table).columns if c != RUN]
    given = {c.lower(): c for c in rows.columns}
    if sorted(given) != sorted(c.lower() for c in wanted) or len(given) != len(rows.columns):
        raise ValueError(f"{table} has columns {wanted} beside {RUN}, got {rows.columns}")
    spec = ", ".join([f"{RUN} = '{run}'", *[f"`{c}`" for c in parts[1:]]])
    # by position: the partition columns come last
    order = [c for c in wanted if c not in parts] + parts[1:]
    ordered = _gathered(rows.select(*[F.col(f"`{given[c.lower()]}`").alias(c) for c in order]), parts[1:])
    statement = f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT * FROM {{load_rows}}"
    return _observed(ordered, table, lambda out: spark.sql(statement, load_rows=out))


def committed_rows(spark: SparkSession, table: str, load_id: str) -> int | None:
    """How many rows a load has put into the table, or ``None`` where it has not finished doing so."""
    record = _record(table)
    if not _exists(spark, record):
        return None
    spark.catalog.refreshTable(record)
    found = spark.table(record).where(F.col(RUN) == run_value(load_id)).first()  # a partition of one row
    return found["n_rows"] if found else None


def append_once(df: DataFrame, table: str, load_id: str, partition_by: list[str] | None = None) -> int:
    """Append a load's rows by column name unless they are there; the number of rows the load has in the table.

    The table is made if it does not exist, partitioned by ``load_run`` and the
    rest of ``partition_by``. ``df`` does not have that column. A load without
    rows leaves no record: when it is tried again its source may have some.
    """
    spark = df.sparkSession
    run = run_value(load_id)
    if RUN in (c.lower() for c in df.columns):
        raise ValueError(f"{RUN!r} is the table's own column")
    if not _exists(spark, table):
        parts = [RUN, *[c for c in partition_by or [] if c != RUN]]
        _create(df.limit(0).withColumn(RUN, F.lit(run)), table, parts)
    elif not keeps_runs(spark, table):
        raise ValueError(f"{table} is not partitioned by {RUN} first")
    done = committed_rows(spark, table, load_id)
    if done is not None:
        return done
    rows = _publish(df, table, run)
    if rows:
        record = _record(table)
        if not _exists(spark, record):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {record} (n_rows BIGINT, recorded TIMESTAMP, {RUN} STRING) USING parquet PARTITIONED BY ({RUN})")
        note = spark.range(1).select(F.lit(rows).cast("bigint").alias("n_rows"), F.current_timestamp().alias("recorded"))
        _publish(note, record, run)
    return rows
