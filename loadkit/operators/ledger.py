"""Run ledger as tables: jobs, runs and validation results, answered for all jobs at once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.operators.history import asof_previous
from loadkit.operators.keyed import join_per_key
from loadkit.operators.shape import first_per_key
from loadkit.operators.validation import ERROR

# Run and validation statuses.
STARTED = "STARTED"
READING_SOURCE_DATA = "READING_SOURCE_DATA"
COMPLETED = "COMPLETED"
COMPLETED_WITH_VALIDATION_WARNING = "COMPLETED_WITH_VALIDATION_WARNING"
COMPLETED_WITH_VALIDATION_ERROR = "COMPLETED_WITH_VALIDATION_ERROR"
COMPLETED_WITH_ZERO = "COMPLETED_WITH_ZERO"
FAILED = "FAILED"
ALREADY_COMPLETED = "ALREADY_COMPLETED"
DUPLICATE_PARALLEL_START = "DUPLICATE_PARALLEL_START"
VALIDATION_ERROR = "VALIDATION_ERROR"
VALIDATION_WARNING = "VALIDATION_WARNING"

PROCESSED = (COMPLETED, COMPLETED_WITH_VALIDATION_WARNING, ALREADY_COMPLETED)
RUNNING = (STARTED, READING_SOURCE_DATA)

JOB_KEY = ["source_system", "source", "source_type", "load_type"]

RUN_SCHEMA = (
    "run_id string, job_id string, _created timestamp, _modified timestamp, run_start_time timestamp, "
    "run_end_time timestamp, run_date date, run_row_count bigint, run_status string, run_error_detail string"
)


def _job_text() -> Column:
    """The four settings as one text: no two jobs share it, and null is a setting like any other."""
    return F.to_json(F.array(*[F.col(name).cast("string") for name in JOB_KEY]))


def find_jobs(jobs: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests with ``matches`` and, where exactly one job matches, its ``job_id``."""
    found = jobs.groupBy(_job_text().alias("_job")).agg(F.count("*").alias("matches"), F.min("job_id").alias("job_id"))
    joined = join_per_key(requests.withColumn("_job", _job_text()), found, ["_job"], "left")
    return joined.select(
        *requests.columns,
        F.coalesce("matches", F.lit(0)).alias("matches"),
        F.when(F.col("matches") == 1, F.col("job_id")).alias("job_id"),
    )


def find_job(jobs: DataFrame, source_system: str, source: str, source_type: str, load_type: str) -> str:
    """The id of the one job with these four settings."""
    wanted = dict(zip(JOB_KEY, (source_system, source, source_type, load_type)))
    same = [F.col(name).eqNullSafe(F.lit(value)) for name, value in wanted.items()]
    rows = jobs.where(same[0] & same[1] & same[2] & same[3]).select("job_id").take(2)
    if len(rows) != 1:
        raise ValueError(f"{'no' if not rows else 'more than one'} job for {wanted}")
    return rows[0]["job_id"]


def register_jobs(jobs: DataFrame, requests: DataFrame) -> DataFrame:
    """One new job row for each requested job that is not known; the id follows from its four settings."""
    known = jobs.select(_job_text().alias("_job")).distinct()
    unknown = join_per_key(requests.withColumn("_job", _job_text()), known, ["_job"], "left_anti")
    rest = [c for c in requests.columns if c not in JOB_KEY]
    picked = unknown.groupBy("_job", *JOB_KEY).agg(F.count("*").alias("_n"), *[F.max(c).alias(c) for c in rest])
    return picked.select(
        F.sha2("_job", 256).alias("job_id"),
        F.current_timestamp().alias("_created"),
        F.current_timestamp().alias("_modified"),
        *requests.columns,
    )


def current_state(events: DataFrame) -> DataFrame:
    """One row per run: its latest event, with the time the run was first recorded."""
    rest = [c for c in events.columns if c not in ("run_id", "_created", "_modified")]
    latest = F.max(F.struct("_modified", *rest)).alias("_latest")
    return (
        events.groupBy("run_id")
        .agg(latest, F.min("_created").alias("_created"))
        .select(*[F.col(f"_latest.{c}") if c in (*rest, "_modified") else F.col(c) for c in events.columns])
    )


def record_run(runs: DataFrame, events: DataFrame) -> DataFrame:
    """State of the runs after new events: new runs come in, known ones take the event's values."""
    return current_state(runs.unionByName(events))


def _same_id(name: str) -> Column:
    return F.upper(F.col(name).cast("string"))


def _keyed(runs: DataFrame) -> DataFrame:
    return runs.withColumn("_job", _same_id("job_id"))


_NEWEST_FIRST = ["_modified", "run_id"]


def latest_runs(runs: DataFrame) -> DataFrame:
    """The run last modified, per job and run date; job ids in any case are one job."""
    order = [F.col(c).desc() for c in _NEWEST_FIRST]
    return first_per_key(_keyed(runs), ["_job", "run_date"], order).drop("_job")


def _latest_other_run(runs: DataFrame, current: DataFrame) -> DataFrame:
    """Add ``_other``, the latest run of the same job and date that is not the row's own run.

    It is one of the two latest, so two rows per job and date are enough.
    """
    order = [F.col(c).desc() for c in _NEWEST_FIRST]
    two = first_per_key(_keyed(runs), ["_job", "run_date"], order, n=2)
    run = F.struct("_modified", "run_id", "run_status")
    pairs = two.groupBy("_job", "run_date").agg(F.max(run).alias("_first"), F.min(run).alias("_second"))
    joined = join_per_key(_keyed(current), pairs, ["_job", "run_date"], "left")
    own = _same_id("run_id")

    def unless_own(name: str) -> Column:
        return F.when(F.upper(F.col(name)["run_id"].cast("string")) != own, F.col(name))

    other = F.coalesce(unless_own("_first"), unless_own("_second"))
    return joined.select(*current.columns, other.alias("_other"))


def _with_other(df: DataFrame, current: DataFrame) -> DataFrame:
    return df.select(
        *current.columns,
        F.col("_other.run_id").alias("other_run_id"),
        F.upper("_other.run_status").alias("other_run_status"),
    )


def already_processed(runs: DataFrame, current: DataFrame) -> DataFrame:
    """Current runs whose job and date are done: their latest other run completed. ``runs`` has one row per run."""
    joined = _latest_other_run(runs, current)
    return _with_other(joined.where(F.upper("_other.run_status").isin(*PROCESSED)), current)


def duplicate_start(runs: DataFrame, current: DataFrame, wait_seconds: int, replay: bool = False) -> DataFrame:
    """Current runs that start while another run of their job and date is under way.

    That is their latest other run, modified at most ``wait_seconds`` before
    ``run_start_time``. With ``replay``, each run meets the ledger as it stood
    before its own start, to go over past runs.
    """
    if replay:
        started = _keyed(current).withColumn("_modified", F.col("run_start_time"))
        before = asof_previous(started, _keyed(runs), ["_job", "run_date"], "_modified", ["run_id", "run_status"])
        other = F.struct(
            F.col("prev__modified").alias("_modified"),
            F.col("prev_run_id").alias("run_id"),
            F.col("prev_run_status").alias("run_status"),
        )
        joined = before.select(*current.columns, other.alias("_other"))
    else:
        joined = _latest_other_run(runs, current)
    elapsed = F.unix_timestamp("run_start_time") - F.unix_timestamp("_other._modified")
    running = F.upper("_other.run_status").isin(*RUNNING)
    return _with_other(joined.where((elapsed <= wait_seconds) & running), current)


def validation_log(summary: DataFrame, run_id: str | Column, started: datetime, ended: datetime) -> DataFrame:
    """One ledger row per failed rule and column; no count of rows for a rule that needs no data."""
    status = F.when(F.col("action") == ERROR, VALIDATION_ERROR).otherwise(VALIDATION_WARNING)
    # The columns of the validation log.
    return summary.select(
        (run_id if isinstance(run_id, Column) else F.lit(run_id)).alias("run_id"),
        F.current_timestamp().alias("_created"),
        F.current_timestamp().alias("_modified"),
        F.lit("row").alias("validation_type"),
        F.lit("loadkit").alias("validation_gx_check_class"),
        F.col("rule").alias("validation_rule"),
        F.col("column").alias("validation_column_name"),
        F.lit(started).cast("timestamp").alias("validation_start_time"),
        F.lit(ended).cast("timestamp").alias("validation_end_time"),
        F.col("failed_rows").alias("validation_failed_row_count"),
        status.alias("validation_status"),
        F.concat("rule", F.lit(" failed on "), "column").alias("validation_error_detail"),
    )
