"""Compaction of the run ledger."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadkit.operators import ledger as L
from loadkit.session import scratch_table
from loadkit.sinks import compaction as C
from loadkit.sinks.tables import append_evolving, append_table, write_table
from tests.conftest import rows

DAY = date(2024, 3, 1)


def event(run, day, n, status):
    at = datetime(2024, 3, 1) + timedelta(minutes=n)
    return (run, f"job-{run[0]}", at, at, at, at, day, n, status, None)


def ledger(spark, days=4, batches=5):
    """A ledger of several appends: each run starts in one, and goes on or ends in another."""
    draw, name = random.Random(2), scratch_table(spark, "events")
    for batch in range(batches):
        made = [event(f"{draw.choice('abc')}{d}", DAY + timedelta(days=d), batch * 100 + draw.randrange(100), draw.choice([L.STARTED, L.COMPLETED, L.FAILED])) for d in range(days) for _ in range(3)]
        made += [event("lost", None, batch, L.STARTED)]
        append_evolving(spark.createDataFrame(made, L.RUN_SCHEMA).coalesce(1), name, partition_by=["run_date"])
    return name


def files(spark, name, day):
    spark.catalog.refreshTable(name)
    return set(spark.table(name).where(F.col("run_date") == day).inputFiles())


def test_the_state_stays_and_past_dates_become_one_file(spark):
    name = ledger(spark)
    state = rows(L.current_state(spark.table(name)))
    last = DAY + timedelta(days=3)
    open_files, events = files(spark, name, last), spark.table(name).count()
    assert C.compact_events(spark, name, last) == 3
    assert rows(L.current_state(spark.table(name))) == state
    assert [len(files(spark, name, DAY + timedelta(days=d))) for d in range(3)] == [1, 1, 1]
    assert files(spark, name, last) == open_files and len(open_files) == 5
    assert spark.table(name).where("run_date is null").count() == 5 and spark.table(name).count() < events
    done = files(spark, name, DAY)
    assert C.compact_events(spark, name, last) == 0 and files(spark, name, DAY) == done  # again: nothing to do


def test_only_the_date_that_got_an_event_is_written_again(spark):
    name = ledger(spark)
    C.compact_events(spark, name, DAY + timedelta(days=9))
    kept = files(spark, name, DAY)
    late = spark.createDataFrame([event("a1", DAY + timedelta(days=1), 9999, "LATE")], L.RUN_SCHEMA)
    append_table(late, name)
    assert C.compact_events(spark, name, DAY + timedelta(days=9)) == 1
    assert files(spark, name, DAY) == kept
    assert [r.run_status for r in spark.table(name).where("run_id = 'a1'").collect()] == ["LATE"]


def test_an_event_that_comes_in_meanwhile_is_not_lost(spark, monkeypatch):
    name = ledger(spark)
    late = spark.createDataFrame([event("a1", DAY + timedelta(days=1), 9999, "LATE")], L.RUN_SCHEMA)
    create = C._create
    monkeypatch.setattr(C, "_create", lambda df, table: (create(df, table), append_table(late, name)))
    before = spark.table(name).count()
    with pytest.raises(RuntimeError, match="another run"):
        C.compact_events(spark, name, DAY + timedelta(days=9))
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == before + 1


def test_a_ledger_without_partitions_is_refused(spark):
    name = scratch_table(spark, "events")
    write_table(spark.createDataFrame([event("a", DAY, 1, L.STARTED)], L.RUN_SCHEMA), name)
    with pytest.raises(ValueError, match="not partitioned"):
        C.compact_events(spark, name, DAY)
