"""Appends that a retry cannot double, and merges that notice another's write."""

import pytest
from pyspark.sql import functions as F

from loadkit.operators import ledger as L
from loadkit.plans import load
from loadkit.session import scratch_table
from loadkit.sinks import once
from loadkit.sinks import tables as sinks
from tests.conftest import rows
from tests.test_load import NULLS, csv, settings  # noqa: F401


@pytest.fixture
def target(spark):
    name = scratch_table(spark, "people")
    spark.sql(f"CREATE TABLE {name} (id INT, name STRING, h STRING, load_run STRING) USING parquet PARTITIONED BY (load_run)")
    return name


def frame(spark, ids, day="a"):
    return spark.createDataFrame([(i, day) for i in ids], "id int, day string")


def test_a_load_counts_once(spark):
    name = scratch_table(spark, "once")
    assert once.append_once(frame(spark, [1, 2]), name, "a") == 2
    assert once.append_once(frame(spark, [1, 2]), name, "a") == 2
    assert once.append_once(frame(spark, [2, 3, 4]), name, "b") == 3
    assert rows(spark.table(name).select("id", "load_run")) == [(1, "a"), (2, "a"), (2, "b"), (3, "b"), (4, "b")]
    assert once.committed_rows(spark, name, "a") == 2 and once.committed_rows(spark, name, "c") is None


@pytest.mark.parametrize("parts", [None, ["load_run", "day"]])
def test_stopped_before_its_record(spark, monkeypatch, parts):
    """Whatever a stopped try has left behind is replaced, partitions that the retry does not write included."""
    name = scratch_table(spark, "once")
    once.append_once(frame(spark, [9], "z"), name, "other", parts)
    publish = once._publish

    def stopped(df, table, run):
        if table == name:
            return publish(df, table, run)
        raise KeyboardInterrupt

    monkeypatch.setattr(once, "_publish", stopped)
    with pytest.raises(KeyboardInterrupt):
        once.append_once(frame(spark, [1, 2], "a").unionByName(frame(spark, [3], "b")), name, "mine", parts)
    monkeypatch.setattr(once, "_publish", publish)
    assert spark.table(name).count() == 4
    once.append_once(frame(spark, [1, 2], "a"), name, "mine", parts)
    assert rows(spark.table(name).select("id", "day", "load_run")) == [(1, "a", "mine"), (2, "a", "mine"), (9, "z", "other")]


def test_an_empty_load_leaves_no_record(spark):
    name = scratch_table(spark, "once")
    assert once.append_once(frame(spark, []), name, "a") == 0
    assert once.append_once(frame(spark, [1]), name, "a") == 1


def test_odd_ids_and_refusals(spark):
    name = scratch_table(spark, "once")
    for _ in range(2):
        assert once.append_once(frame(spark, [1]), name, "job {x}'; é/2024") == 1
    assert spark.table(name).count() == 1
    with pytest.raises(ValueError, match="own column"):
        once.append_once(frame(spark, [1]).withColumn("load_run", F.lit("x")), name, "b")
    with pytest.raises(ValueError, match="columns"):
        once.append_once(frame(spark, [1]).drop("day"), name, "b")
    with pytest.raises(ValueError, match="id of its load"):
        once.append_once(frame(spark, [1]), name, "")
    plain = scratch_table(spark, "plain")
    frame(spark, [1]).write.saveAsTable(plain)
    with pytest.raises(ValueError, match="not partitioned"):
        once.append_once(frame(spark, [1]), plain, "a")


@pytest.mark.parametrize("action, in_target, in_quarantine", [("WARNING", 3, 1), ("ERROR", 0, 1), (None, 3, None)])
def test_killed_between_write_and_event(spark, csv, target, monkeypatch, action, in_target, in_quarantine):  # noqa: F811
    """The ledger knows only the start; the next start of the job finds the rows."""
    checks = [NULLS | {"action_on_unexpected": action}] if action else []
    runs = scratch_table(spark, "runs")
    cfg = settings(target, source_location=csv, job_id="j", job_run_details_table_name=runs, validations=checks)
    record = load.RunLedger.record

    def killed(self, status, *args, **more):
        if status.startswith("COMPLETED"):
            raise KeyboardInterrupt
        record(self, status, *args, **more)

    monkeypatch.setattr(load.RunLedger, "record", killed)
    with pytest.raises(KeyboardInterrupt):
        load.run_load(spark, cfg)
    monkeypatch.setattr(load.RunLedger, "record", record)
    result = load.run_load(spark, cfg)
    assert spark.table(target).count() == in_target and result.row_count == 3
    held = spark.table(cfg.quarantine).select("id").distinct().count() if spark.catalog.tableExists(cfg.quarantine) else None
    assert held == in_quarantine
    if action != "ERROR":
        assert load.run_load(spark, cfg).status == L.ALREADY_COMPLETED
        assert spark.table(target).count() == in_target


def test_steps_of_a_batch_into_one_table(spark, target, tmp_path):
    catalog, schema, name = target.split(".")
    steps = []
    for n in (1, 2):
        (tmp_path / f"{n}.sql").write_text(f"SELECT {n} AS id, 'x' AS name, 'h' AS h")
        steps.append({"sql_file_location": str(tmp_path / f"{n}.sql"), "target_catalog": catalog, "target_schema": schema, "target_table": name})
    for _ in range(2):
        load.run_sql_batch(spark, steps, {"run_id": "batch"})
    assert rows(spark.table(target).select("id")) == [(1,), (2,)]


def test_two_merges_of_a_partitioned_table(spark, monkeypatch):
    """The later one fails, no row is lost, and the session's overwrite mode is never changed."""
    name = scratch_table(spark, "merged")
    sinks.write_table(frame(spark, [1, 2], "a").unionByName(frame(spark, [3], None)).withColumn("v", F.lit(0)), name, partition_by=["day"])
    feed = lambda v: frame(spark, [1, 4], "a").unionByName(frame(spark, [3], None)).withColumn("v", F.lit(v))
    create, done = sinks._create, []

    def interrupted(df, table, *rest):
        out = create(df, table, *rest)
        if "merged" in table and table != name and not done:
            done.append(1)
            sinks.merge_into(feed(1), name, ["id"], ["v"])
        return out

    monkeypatch.setattr(sinks, "_create", interrupted)
    with pytest.raises(RuntimeError, match="meanwhile"):
        sinks.merge_into(feed(2), name, ["id"], ["v"])
    assert rows(spark.table(name).select("id", "v")) == [(1, 1), (2, 0), (3, 1), (4, 1)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    modes, insert = [], sinks._insert
    monkeypatch.setattr(sinks, "_insert", lambda *a, **k: (modes.append(spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower()), insert(*a, **k))[1])
    sinks.merge_into(feed(3), name, ["id"], ["v"])
    assert set(modes) == {"static"}
    assert rows(spark.table(name).select("id", "v")) == [(1, 3), (2, 0), (3, 3), (4, 3)]
