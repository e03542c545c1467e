"""Whole loads: gate outcomes, ledger, batches."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from loadkit.config import LoadConfig
from loadkit.operators import ledger as L
from loadkit.operators.validation import Check
from loadkit.plans.load import RunLedger, run_load, run_sql_batch
from loadkit.session import scratch_table
from tests.conftest import rows

NULLS = {"name": "null_check", "columns": ["name"]}


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("id,name\n1,Ann\n2,\n3,Cid\n")
    return str(path)


def settings(table, **more):
    catalog, schema, name = table.split(".")
    return LoadConfig.from_layers(
        {
            "ingest_type": "csv",
            "run_date": "2024-01-01",
            "schema": {"id": {"data_type": "int"}, "name": {"data_type": "string"}, "h": {"derived_column": True}},
            "audit_columns_to_be_added": [{"column_name": "h", "data_type": "STRING", "hash_of": ["id", "name"]}],
            "target_catalog": catalog,
            "target_schema": schema,
            "target_table": name,
        },
        more,
    )


@pytest.fixture
def target(spark):
    name = scratch_table(spark, "people")
    spark.sql(f"CREATE TABLE {name} (id INT, name STRING, h STRING) USING parquet")
    return name


def count(spark, table):
    return spark.table(table).count() if spark.catalog.tableExists(table) else None


@pytest.mark.parametrize(
    "validations, status, in_target, in_quarantine",
    [
        ([], L.COMPLETED, 3, None),
        ([{"name": "schema_check", "action_on_unexpected": "ERROR"}], L.COMPLETED, 3, None),
        ([NULLS | {"action_on_unexpected": "WARNING"}], L.COMPLETED_WITH_VALIDATION_WARNING, 3, 1),
        ([NULLS | {"action_on_unexpected": "ERROR"}], L.COMPLETED_WITH_VALIDATION_ERROR, 0, 1),
    ],
)
def test_gate_outcomes(spark, csv, target, validations, status, in_target, in_quarantine):
    cfg = settings(target, source_location=csv, validations=validations)
    result = run_load(spark, cfg)
    assert (result.status, result.row_count) == (status, 3)
    assert (count(spark, target), count(spark, cfg.quarantine)) == (in_target, in_quarantine)
    schema = target.split(".")[1]
    assert not [t for t in spark.catalog.listTables(schema) if t.name.startswith("checked")]


@pytest.mark.parametrize("action, loaded", [("ERROR", []), ("WARNING", [(None, "Bob"), (1, "Ann")])])
def test_lines_that_do_not_parse(spark, tmp_path, target, action, loaded):
    path = tmp_path / "people.csv"
    path.write_text("id,name\n1,Ann\nno number,Bob\n")
    cfg = settings(target, source_location=str(path), corrupt_record_column="line", corrupt_record_action=action)
    run_load(spark, cfg)
    assert rows(spark.table(target).select("id", "name")) == loaded
    assert rows(spark.table(cfg.quarantine).select("line")) == [("no number,Bob",)]


def test_dry_run(spark, csv, target):
    cfg = settings(target, source_location=csv, validations=[NULLS], dry_run="True")
    result = run_load(spark, cfg)
    assert (result.status, result.row_count) == (L.COMPLETED_WITH_VALIDATION_WARNING, 3)
    assert (count(spark, target), count(spark, cfg.quarantine)) == (0, None)


def test_empty_source(spark, csv, target):
    result = run_load(spark, settings(target, source_location=csv, where_clause="id > 9", write_mode="overwrite"))
    assert result.status == L.COMPLETED_WITH_ZERO


def test_missing_target(spark, csv):
    with pytest.raises(ValueError, match="not found"):
        run_load(spark, settings("spark_catalog.default.nowhere", source_location=csv))


def test_table_load_with_merge(spark, target):
    source = scratch_table(spark, "source")
    spark.sql(f"CREATE TABLE {source} AS SELECT * FROM VALUES (1,'Al','x',1),(1,'Old','x',0),(4,'Dee','x',1) t(key, name, h, v)")
    spark.sql(f"INSERT INTO {target} VALUES (1, 'Ann', 'x'), (2, 'Bob', 'x')")
    cfg = settings(
        target,
        ingest_type="delta",
        source_table=source,
        columns=["key", "name", "h", "v", "absent"],
        where_clause="h = '{mark}'",
        mark="x",
        deduplication={"keys": ["key"], "order_by": [{"column": "v", "direction": "desc"}]},
        column_mappings={"key": "id"},
        audit_columns_to_be_added=[],
        merge={"target_table": target, "merge_keys": ["id"], "update_columns": ["name"]},
    )
    run_load(spark, cfg)
    assert rows(spark.table(target)) == [(1, "Al", "x"), (2, "Bob", "x"), (4, "Dee", "x")]


def test_ledger(spark, csv, target):
    ledger_tables = {
        "job_details_table_name": scratch_table(spark, "jobs"),
        "job_run_details_table_name": scratch_table(spark, "runs"),
        "validation_run_details_table_name": scratch_table(spark, "validation_runs"),
        "source_system": "crm",
        "source": "people",
        "source_type": "csv",
        "load_type": "full",
    }
    cfg = settings(target, source_location=csv, validations=[NULLS], **ledger_tables)
    assert run_load(spark, cfg).status == L.COMPLETED_WITH_VALIDATION_WARNING
    assert run_load(spark, cfg).status == L.ALREADY_COMPLETED
    assert run_load(spark, cfg).status == L.ALREADY_COMPLETED
    assert spark.table(cfg.job_details_table_name).count() == 1
    runs = L.current_state(spark.table(cfg.job_run_details_table_name))
    assert rows(runs.select("run_status", "run_row_count")) == [
        (L.ALREADY_COMPLETED, 0), (L.ALREADY_COMPLETED, 0), (L.COMPLETED_WITH_VALIDATION_WARNING, 3),
    ]
    log = spark.table(cfg.validation_run_details_table_name)
    assert rows(log.select("validation_rule", "validation_failed_row_count")) == [("null_check", 1)]
    assert log.join(runs, "run_id").count() == 1
    assert count(spark, target) == 3


def test_failure_is_recorded(spark, target):
    table = scratch_table(spark, "runs")
    cfg = settings(target, source_location="/no/such.csv", job_id="j", job_run_details_table_name=table)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_load(spark, cfg)
    state = L.current_state(spark.table(table)).first()
    assert state.run_status == L.FAILED and "PATH_NOT_FOUND" in state.run_error_detail


def test_parallel_start(spark, csv, target):
    table = scratch_table(spark, "runs")
    cfg = settings(
        target, source_location=csv, job_id="j", job_run_details_table_name=table, wait_before_reprocessing_in_seconds=3600
    )
    RunLedger(spark, cfg).record(L.STARTED)
    assert run_load(spark, cfg).status == L.DUPLICATE_PARALLEL_START
    assert count(spark, target) == 0


def test_sql_load(spark, tmp_path, target):
    path = tmp_path / "q.sql"
    path.write_text("SELECT 5 AS id, '{who}' AS name")
    cfg = settings(target, ingest_type="sql", sql_file_location=str(path), who="Eve")
    assert run_load(spark, cfg).row_count == 1
    path.write_text(f"INSERT INTO {target} VALUES (6, 'Flo', 'x')")
    assert run_load(spark, cfg).status == L.COMPLETED
    assert rows(spark.table(target).select("id")) == [(5,), (6,)]


def step(tmp_path, name, text, table, **more):
    path = tmp_path / f"{name}.sql"
    path.write_text(text)
    catalog, schema, target = table.split(".")
    return {
        "name": name, "sql_file_location": str(path), "target_catalog": catalog, "target_schema": schema,
        "target_table": target, **more,
    }


def test_sql_batch(spark, tmp_path, target):
    bad = NULLS | {"action_on_unexpected": "ERROR"}
    runs = scratch_table(spark, "runs")
    first = step(tmp_path, "one", "SELECT 1 AS id, 'a' AS name, 'x' AS h", target)
    failing = step(tmp_path, "two", "SELECT 2 AS id, CAST(NULL AS string) AS name, 'x' AS h", target, validations=[bad])
    third = step(tmp_path, "three", "SELECT 3 AS id, 'c' AS name, 'x' AS h", target)
    common = {"job_id": "j", "run_date": "2024-01-01", "job_run_details_table_name": runs}
    cfg = LoadConfig.from_layers(common, {"ingest_type": "sql_batch", "sqls": [first, failing, third]})
    result = run_load(spark, cfg)
    assert (result.status, result.row_count) == (L.COMPLETED_WITH_VALIDATION_ERROR, 3)
    assert [r.status for r in result.steps] == [L.COMPLETED, L.COMPLETED_WITH_VALIDATION_ERROR, L.COMPLETED]
    assert rows(spark.table(target).select("id")) == [(1,), (3,)]
    assert rows(spark.table(f"{target}_quarantine").select("id")) == [(2,)]
    assert L.current_state(spark.table(runs)).first().run_status == L.COMPLETED_WITH_VALIDATION_ERROR


def test_sql_batch_stops_at_a_failing_step(spark, tmp_path, target):
    runs = scratch_table(spark, "runs")
    broken = step(tmp_path, "broken", "SELEC 1", target)
    never = step(tmp_path, "never", "SELECT 3 AS id, 'c' AS name, 'x' AS h", target)
    with pytest.raises(ValueError, match="Failed to parse SQL"):
        common = {"job_id": "j", "run_date": "2024-01-01", "job_run_details_table_name": runs}
        run_sql_batch(spark, [broken, never], common)
    assert count(spark, target) == 0
    state = L.current_state(spark.table(runs)).first()
    assert state.run_status == L.FAILED and state.run_error_detail.startswith("step 'broken' failed")
    with pytest.raises(ValueError, match="no SQL steps"):
        run_sql_batch(spark, [])


@pytest.mark.parametrize(
    ("rules", "read"),
    [
        ([], 3),
        ([{"name": "short", "expression": "length(h) > 0", "action_on_unexpected": "WARNING"}], 3),  # none fails
        ([NULLS], 4),  # one row is offending, and read again
        ([NULLS | {"action_on_unexpected": "ERROR"}], 3),  # stored first
    ],
)
def test_rows_read_from_the_source(spark, csv, target, rules, read):
    seen = spark.sparkContext.accumulator(0)

    def count_row(value):
        seen.add(1)
        return value

    counting = F.udf(count_row, "int")
    step = lambda df: df.withColumn("id", counting("id"))
    result = run_load(spark, settings(target, source_location=csv, validations=rules, custom_transformations=[step]))
    assert seen.value == read
    assert count(spark, target) == (0 if result.status == L.COMPLETED_WITH_VALIDATION_ERROR else 3)


PEOPLE = {"key": {"data_type": "int", "source_column_name": "id"}, "name": {"data_type": "string"}}


def test_schema_check_and_renames_go_together(spark, csv):
    name = scratch_table(spark, "people")
    spark.sql(f"CREATE TABLE {name} (key INT, called STRING)")
    check = {"name": "schema_check", "action_on_unexpected": "ERROR"}
    cfg = settings(name, source_location=csv, schema=PEOPLE, column_mappings={"name": "called"}, validations=[check], audit_columns_to_be_added=[])
    assert run_load(spark, cfg).status == L.COMPLETED
    assert count(spark, name) == 3


def test_wrong_schema_reads_no_data(spark, tmp_path, target):
    path = str(tmp_path / "wide.parquet")
    spark.range(5).selectExpr("id", "CAST(id AS string) AS name").write.parquet(path)
    log = scratch_table(spark, "log")
    check = {"name": "schema_check", "action_on_unexpected": "ERROR"}
    seen = spark.sparkContext.accumulator(0)
    counting = F.udf(lambda v: (seen.add(1), v)[1], "string")
    cfg = settings(
        target, ingest_type="parquet", source_location=path, schema=PEOPLE, validations=[check, NULLS],
        custom_transformations=[lambda df: df.withColumn("name", counting("name"))], validation_run_details_table_name=log,
    )
    result = run_load(spark, cfg)
    assert result.status == L.COMPLETED_WITH_VALIDATION_ERROR and seen.value == 0 and count(spark, target) == 0
    assert rows(spark.table(log).select("validation_column_name", "validation_failed_row_count")) == [("id: expected int, found bigint", None)]


def test_nothing_runs_without_a_target(spark, csv):
    nowhere = "spark_catalog.default.nowhere"
    cfg = settings(nowhere, source_location=csv, validations=[NULLS | {"action_on_unexpected": "ERROR"}])
    for _ in range(2):
        with pytest.raises(ValueError, match="not found"):
            run_load(spark, cfg)
    assert not spark.catalog.tableExists(cfg.quarantine)


def test_a_run_is_quarantined_once(spark, csv, target):
    bad = NULLS | {"action_on_unexpected": "ERROR"}
    cfg = settings(target, source_location=csv, validations=[bad], run_id="r-1")
    for _ in range(2):
        assert run_load(spark, cfg).status == L.COMPLETED_WITH_VALIDATION_ERROR
    assert rows(spark.table(cfg.quarantine).select("run_id")) == [("r-1",)]
    run_load(spark, settings(target, source_location=csv, validations=[bad], run_id="r-2"))
    assert count(spark, cfg.quarantine) == 2


def test_bad_values_fail_or_go_to_quarantine(spark, tmp_path, target):
    path = tmp_path / "bad.json"
    path.write_text('{"id": 1, "name": "a"}\n{"id": "oops", "name": "b"}\n{broken\n')
    schema = {"id": {"data_type": "int"}, "name": {"data_type": "string"}}
    base = {"ingest_type": "json", "source_location": str(path), "schema": schema}
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        run_load(spark, settings(target, **base))
    assert count(spark, target) == 0
    assert run_load(spark, settings(target, **base, unparsed="null")).status == L.COMPLETED
    cfg = settings(target, **base, corrupt_record_column="raw", corrupt_record_action="WARNING", run_id="j")
    assert run_load(spark, cfg).status == L.COMPLETED_WITH_VALIDATION_WARNING
    assert rows(spark.table(cfg.quarantine).select("raw")) == [('{"id": "oops", "name": "b"}',), ("{broken",)]


def test_ignore_mode_writes_nothing_to_a_table_that_exists(spark, csv, target):
    cfg = settings(target, source_location=csv, validations=[NULLS], write_mode="ignore")
    assert run_load(spark, cfg).row_count == 0 and count(spark, target) == 0


def test_backfill_and_own_rules(spark, tmp_path, target):
    for day in ("2024-03-01", "2024-03-02", "2024-03-03"):
        (tmp_path / f"people_{day.replace('-', '')}.csv").write_text(f"id,name\n{day[-1]},n{day[-1]}\n")

    def even(df):
        return [Check("even", "id", "WARNING", F.col("id") % 2 != 0)]

    cfg = settings(
        target, source_base_location=str(tmp_path) + "/", source_file_name_prefix="people_", source_file_name_date_pattern="{year}{month}{day}",
        source_file_extension=".csv", run_dates=["2024-03-01", "2024-03-02"], path_column="file", schema=PEOPLE | {"id": {"data_type": "int"}},
        custom_transformations=[lambda df: df.selectExpr("id", "name || right(file, 6) AS name")], validations=[even],
    )
    cfg = dataclasses.replace(cfg, schema={"id": {"data_type": "int"}, "name": {}})
    assert run_load(spark, cfg).status == L.COMPLETED_WITH_VALIDATION_WARNING
    assert rows(spark.table(target).select("id", "name")) == [(1, "n1" + "01.csv"), (2, "n2" + "02.csv")]
    assert rows(spark.table(cfg.quarantine).select("id")) == [(1,)]
