"""Run ledger queries: every event is a run, of its user's job, on its day."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.operators import ledger as L
from loadkit.operators import validation as V
from loadkit.queries.registry import query, table
from loadkit.queries.validation import NOT_LOW, NULLS, RAW_CTE, TYPES, raw_orders
from loadkit.session import scratch_table
from loadkit.sinks.compaction import compact_events
from loadkit.sinks.tables import append_evolving

RUNS_CTE = """WITH runs AS (SELECT CAST(event_id AS VARCHAR) AS run_id, 'job-' || user_id AS job_id,
  CAST(ts AS DATE) AS run_date, ts AS _modified, CASE event_type WHEN 'view' THEN 'Started'
  WHEN 'click' THEN 'READING_SOURCE_DATA' WHEN 'purchase' THEN 'Completed'
  WHEN 'signup' THEN 'COMPLETED_WITH_VALIDATION_WARNING' ELSE 'FAILED' END AS run_status FROM events)
"""
# For each run, the latest other run of its job and date: the second of two if it is the latest itself.
OTHER_CTE = """, ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY job_id, run_date ORDER BY _modified DESC, run_id DESC)
  AS r FROM runs),
other AS (SELECT c.run_id, c.job_id, c._modified AS started, o.run_id AS other_run_id, o._modified,
                 upper(o.run_status) AS other_run_status
  FROM ranked c JOIN ranked o ON o.job_id = c.job_id AND o.run_date = c.run_date
   AND o.r = CASE WHEN c.r = 1 THEN 2 ELSE 1 END)
"""


def runs(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    status = (
        F.when(kind == "view", "Started")
        .when(kind == "click", "READING_SOURCE_DATA")
        .when(kind == "purchase", "Completed")
        .when(kind == "signup", "COMPLETED_WITH_VALIDATION_WARNING")
        .otherwise("FAILED")
    )
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("job_id"),
        F.col("ts").cast("date").alias("run_date"),
        F.col("ts").alias("_created"),
        F.col("ts").alias("_modified"),
        F.col("ts").alias("run_start_time"),
        status.alias("run_status"),
    )


def _current(spark: SparkSession, sf: str) -> DataFrame:
    """Every run, as if it were the one asking; ids in other letters, as the ledger ignores case."""
    return runs(spark, sf).select("run_id", F.upper("job_id").alias("job_id"), "run_date", "run_start_time")


@query(RUNS_CTE + """SELECT run_id, job_id, CAST(run_date AS VARCHAR) AS run_date, run_status FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY job_id, run_date ORDER BY _modified DESC, run_id DESC) AS r FROM runs) x
WHERE r = 1""")
def ledger_latest_run(spark, sf):
    df = L.latest_runs(runs(spark, sf))
    return df.select("run_id", "job_id", F.col("run_date").cast("string").alias("run_date"), "run_status")


@query(RUNS_CTE + OTHER_CTE + """SELECT run_id, upper(job_id) AS job_id, other_run_id, other_run_status FROM other
WHERE other_run_status IN ('COMPLETED', 'COMPLETED_WITH_VALIDATION_WARNING', 'ALREADY_COMPLETED')""")
def ledger_already_processed(spark, sf):
    df = L.already_processed(runs(spark, sf), _current(spark, sf))
    return df.select("run_id", "job_id", "other_run_id", "other_run_status")


@query(RUNS_CTE + """SELECT run_id, upper(job_id) AS job_id, other_run_id, other_run_status FROM (
  SELECT run_id, job_id, _modified, LAG(run_id) OVER w AS other_run_id, LAG(_modified) OVER w AS other_modified,
         upper(LAG(run_status) OVER w) AS other_run_status
  FROM runs WINDOW w AS (PARTITION BY job_id, run_date ORDER BY _modified)) x
WHERE date_diff('second', other_modified, _modified) <= 3600 AND other_run_status IN ('STARTED', 'READING_SOURCE_DATA')""")
def ledger_duplicate_start(spark, sf):
    df = L.duplicate_start(runs(spark, sf), _current(spark, sf), 3600, replay=True)
    return df.select("run_id", "job_id", "other_run_id", "other_run_status")


@query(RUNS_CTE + OTHER_CTE + """SELECT run_id, upper(job_id) AS job_id, other_run_id, other_run_status FROM other
WHERE date_diff('second', _modified, started) <= 3600 AND other_run_status IN ('STARTED', 'READING_SOURCE_DATA')""")
def ledger_duplicate_latest(spark, sf):
    df = L.duplicate_start(runs(spark, sf), _current(spark, sf), 3600)
    return df.select("run_id", "job_id", "other_run_id", "other_run_status")


CURRENT_STATE_SQL = RUNS_CTE + """SELECT job_id || ' ' || CAST(run_date AS VARCHAR) AS run_id, arg_max(run_status, _modified) AS run_status,
  strftime(MIN(_modified), '%Y-%m-%d %H:%M:%S') AS created, strftime(MAX(_modified), '%Y-%m-%d %H:%M:%S') AS modified
FROM runs GROUP BY job_id, run_date"""


@query(CURRENT_STATE_SQL)
def ledger_current_state(spark, sf):
    started, later = _histories(spark, sf)
    return _shown(L.record_run(L.current_state(started), later))


def _histories(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A job's events of one day as the status history of one run: first starts and reads, then the rest."""
    events = runs(spark, sf).withColumn("run_id", F.concat_ws(" ", "job_id", F.col("run_date").cast("string")))
    running = F.upper("run_status").isin(*L.RUNNING)
    return events.where(running), events.where(~running)


def _shown(state: DataFrame) -> DataFrame:
    pattern = "yyyy-MM-dd HH:mm:ss"
    return state.select(
        "run_id",
        "run_status",
        F.date_format("_created", pattern).alias("created"),
        F.date_format("_modified", pattern).alias("modified"),
    )


@query(CURRENT_STATE_SQL)
def ledger_compacted(spark, sf):
    """The same from a ledger table whose dates but the last have been compacted, with events coming in afterwards."""
    started, later = _histories(spark, sf)
    name = scratch_table(spark, "events")
    append_evolving(started, name, partition_by=["run_date"])
    half = F.xxhash64("job_id") % 2 == 0
    append_evolving(later.where(half), name)
    compact_events(spark, name, spark.table(name).agg(F.max("run_date")).first()[0])
    append_evolving(later.where(~half), name)
    return _shown(L.current_state(spark.table(name)))


def _request(name: Column) -> list[Column]:
    return [
        F.lit("crm").alias("source_system"),
        name.alias("source"),
        F.lit("table").alias("source_type"),
        F.lit("full").alias("load_type"),
    ]


def jobs(spark: SparkSession, sf: str) -> DataFrame:
    """A job per customer, and another of the same settings for the customers whose number a supplier has."""
    first = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("job_id"), *_request(F.col("c_name")))
    name = F.regexp_replace("s_name", "Supplier", "Customer")
    second = table(spark, sf, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("job_id"), *_request(name))
    return first.unionByName(second)


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """A request per order line's part number, read as a customer number."""
    number = F.lpad(F.col("l_partkey").cast("string"), 9, "0")
    return table(spark, sf, "lineitem").select(*_request(F.concat(F.lit("Customer#"), number)))


REQUESTS_SQL = "SELECT 'Customer#' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS source FROM lineitem"
JOBS_CTE = f"""WITH jobs AS (SELECT 'c' || c_custkey AS job_id, c_name AS source FROM customer
  UNION ALL SELECT 's' || s_suppkey, replace(s_name, 'Supplier', 'Customer') FROM supplier),
requests AS ({REQUESTS_SQL})
"""


@query(JOBS_CTE + """SELECT r.source, COALESCE(j.matches, 0) AS matches, COALESCE(j.job_id, '-') AS job_id
FROM requests r LEFT JOIN (SELECT source, COUNT(*) AS matches, CASE WHEN COUNT(*) = 1 THEN MIN(job_id) END AS job_id
                           FROM jobs GROUP BY source) j ON r.source = j.source""")
def ledger_find_job(spark, sf):
    df = L.find_jobs(jobs(spark, sf), requests(spark, sf))
    return df.select("source", "matches", F.coalesce("job_id", F.lit("-")).alias("job_id"))


@query(JOBS_CTE + """SELECT DISTINCT source, 'crm' AS source_system, 'table' AS source_type, 'full' AS load_type,
  sha256('["crm","' || source || '","table","full"]') AS job_id FROM requests WHERE source NOT IN (SELECT source FROM jobs)""")
def ledger_register_jobs(spark, sf):
    return L.register_jobs(jobs(spark, sf), requests(spark, sf)).drop("_created", "_modified")


@query(RAW_CTE + """SELECT 'run-1' AS run_id, rule AS validation_rule, checked AS validation_column_name,
  COUNT(*) AS validation_failed_row_count, 'VALIDATION_' || action AS validation_status
FROM issues GROUP BY rule, checked, action""")
def ledger_validation_log(spark, sf):
    result = V.run_validations(raw_orders(spark, sf), [NULLS, TYPES, NOT_LOW])
    log = L.validation_log(result.summary, "run-1", datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 11))
    return log.select(
        "run_id", "validation_rule", "validation_column_name", "validation_failed_row_count", "validation_status"
    )
