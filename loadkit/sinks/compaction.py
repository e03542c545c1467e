"""Upkeep of the run ledger: events of past run dates become one row per run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loadkit.operators.ledger import current_state
from loadkit.session import scratch_table
from loadkit.sinks.tables import _create, _replace_partitions, partition_columns, partition_files, require_table

RUN_DATE = "run_date"


def compact_events(spark: SparkSession, table: str, before: date) -> int:
    """Rewrite the events of run dates before a day as the state of their runs; the number of dates rewritten.

    Every run leaves a few files of a row or two, which each start has to list.
    Compacted, a date is one file (or a few, if it is large) with a row per run.
    ``current_state`` over the table gives the same before and after; the
    states a run went through are gone. The table is partitioned by run date,
    and only dates of more than one file are read and written, so doing it
    again writes nothing. Events without a run date are left as they are. If an
    event comes in for one of the dates meanwhile, this fails and changes
    nothing: take dates whose runs are over.
    """
    require_table(spark, table)
    if partition_columns(spark, table) != [RUN_DATE]:
        raise ValueError(f"{table} is not partitioned by {RUN_DATE}")
    spark.catalog.refreshTable(table)
    events = spark.table(table)
    files = events.where(F.col(RUN_DATE) < F.lit(before)).select(RUN_DATE, F.col("_metadata.file_path").alias("file")).distinct()
    days = [r[RUN_DATE] for r in files.groupBy(RUN_DATE).count().where("count > 1").collect()]  # as many as there are dates, at most
    if not days:
        return 0
    spots = [(day,) for day in days]
    found = partition_files(spark, table, [RUN_DATE], spots)
    staged = scratch_table(spark, "compacted")
    try:
        _create(current_state(spark.table(table).where(F.col(RUN_DATE).isin(days))), staged)
        if partition_files(spark, table, [RUN_DATE], spots) != found:
            raise RuntimeError(f"{table} was written by another run meanwhile")
        _replace_partitions(spark, table, [RUN_DATE], staged, spark.createDataFrame(spots, f"{RUN_DATE} date"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
    return len(days)
