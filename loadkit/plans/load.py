"""A whole load: source, shape, audit columns, validation, gate, sinks, ledger."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from loadkit.config import LoadConfig, as_flag, collate_column_specs
from loadkit.functions.columns import add_derived_columns
from loadkit.operators import ledger
from loadkit.operators.shape import apply_transforms, conform, dedup_latest, rename_columns, select_existing, where_template
from loadkit.operators.validation import (
    ISSUES,
    Rule,
    ValidationResult,
    expression_check,
    has_error,
    rules_from_config,
    run_validations,
    schema_findings,
)
from loadkit.plans.gate import final_status, gate, is_empty, stored
from loadkit.sinks import once
from loadkit.sinks import tables as sinks
from loadkit.sources.registry import read_source, without_gaps


@dataclass(frozen=True)
class LoadResult:
    status: str
    row_count: int = 0
    summary: list[Row] = field(default_factory=list)
    steps: list[LoadResult] = field(default_factory=list)
    missing_dates: list[str] = field(default_factory=list)


WORST_FIRST = [
    ledger.COMPLETED_WITH_VALIDATION_ERROR,
    ledger.COMPLETED_WITH_VALIDATION_WARNING,
    ledger.COMPLETED,
    ledger.COMPLETED_WITH_ZERO,
]


def select_rows(df: DataFrame, cfg: LoadConfig) -> DataFrame:
    """Project, then filter; the filter sees projected columns only. A source query does both by itself."""
    if cfg.sql_query:
        return df
    df = select_existing(df, cfg.columns)
    return where_template(df, cfg.where_clause.strip(), cfg.values) if cfg.where_clause else df


def shape(df: DataFrame, cfg: LoadConfig) -> DataFrame:
    """Deduplicate, take the schema's names and types, rename, transform, add audit columns."""
    dedup = cfg.deduplication or {}
    df = dedup_latest(df, dedup.get("keys"), dedup.get("order_by"))
    if cfg.schema:
        df = conform(df, cfg.schema, "null" if cfg.unparsed == "null" else "raise", keep_others=True)
    df = rename_columns(df, cfg.column_mappings or {})
    df = apply_transforms(df, cfg.custom_transformations)
    return add_derived_columns(df, collate_column_specs(cfg.audit_columns_to_be_added, cfg.table_columns_to_be_added))


def _appends_once(spark: SparkSession, cfg: LoadConfig) -> bool:
    """Whether the target keeps loads apart, so that a retry finds its own rows."""
    return not cfg.merge and cfg.write_mode.lower() == "append" and once.keeps_runs(spark, cfg.target, cfg.partition_by)


def _write(df: DataFrame, cfg: LoadConfig, load_id: str) -> int | None:
    if cfg.merge:
        m = cfg.merge
        return sinks.merge_into(
            df, m.get("target_table"), m.get("merge_keys"), m.get("update_columns"), m.get("delete_condition")
        )
    mode = cfg.write_mode.lower()
    if _appends_once(df.sparkSession, cfg):
        return once.append_once(df, cfg.target, load_id, cfg.partition_by)
    if cfg.ingest_type in ("table", "delta") or mode != "append" or cfg.partition_by:
        return sinks.write_table(df, cfg.target, mode, cfg.partition_by)
    return sinks.append_table(df, cfg.target)


def _rules(df: DataFrame, cfg: LoadConfig) -> list[Rule]:
    """Configured rules, and one for lines that did not parse, whose text goes to quarantine only."""
    tested = [v for v in cfg.validations if not isinstance(v, dict) or v["name"] != "schema_check"]
    rules = rules_from_config(tested, cfg.schema)
    if cfg.corrupt_record_column in df.columns:
        rules.append(expression_check("corrupt_record", f"`{cfg.corrupt_record_column}` IS NULL", cfg.corrupt_record_action))
    return rules


def _check_target(spark: SparkSession, cfg: LoadConfig) -> None:
    """Raise for what would stop the write at the end, before anything runs."""
    mode = cfg.write_mode.lower()
    if cfg.merge:
        table, keys = cfg.merge.get("target_table"), cfg.merge.get("merge_keys")
        if not table or not keys:
            raise ValueError("target_table and merge_keys must be specified for merge")
        sinks.require_table(spark, table)
    elif cfg.ingest_type not in ("table", "delta") and mode == "append" and not cfg.partition_by:
        sinks.require_table(spark, cfg.target)
    else:
        sinks.check_partitioning(spark, cfg.target, mode, cfg.partition_by)


def _quarantine(rows: DataFrame, cfg: LoadConfig, run_id: str) -> None:
    """Keep the offending rows of a run, once, however often the run is tried."""
    spark = rows.sparkSession
    if spark.catalog.tableExists(cfg.quarantine) and "run_id" in spark.table(cfg.quarantine).columns:
        if not is_empty(spark.table(cfg.quarantine).where(F.col("run_id") == run_id)):
            return
    sinks.append_evolving(rows.withColumn("run_id", F.lit(run_id)), cfg.quarantine)


def _only_warned(
    validated: ValidationResult, cfg: LoadConfig, run_id: str, load_id: str, findings: list[Row]
) -> tuple[list[Row], int]:
    """Write rows that no rule can stop straight to the target, counting what fails on the way: (summary, rows).

    Only if some do is the source read again, for the offending rows.
    """
    if cfg.write_mode.lower() == "ignore" and validated.checked.sparkSession.catalog.tableExists(cfg.target):
        return findings, 0  # nothing runs, so nothing would be counted
    if _appends_once(validated.checked.sparkSession, cfg):
        rows = once.committed_rows(validated.checked.sparkSession, cfg.target, load_id)
        if rows is not None:  # an earlier try has written them: only what came after is left to do
            summary = validated.summary.collect() if validated.can_fail else []
            if summary:
                _quarantine(validated.issue_rows, cfg, run_id)
            return [*findings, *summary], rows
    failed = Observation("failed checks")
    counts = [F.count_if(c.failed).alias(f"c{i}") for i, c in enumerate(validated.checks)]
    rows = _write(_clean(validated.checked.observe(failed, F.count(F.lit(1)).alias("rows"), *counts), cfg), cfg, load_id)
    got = failed.get
    summary = [
        Row(rule=c.rule, column=c.column, action=c.action, failed_rows=got[f"c{i}"])
        for i, c in enumerate(validated.checks)
        if got[f"c{i}"]
    ]
    if summary:
        _quarantine(validated.issue_rows, cfg, run_id)
    return [*findings, *summary], got["rows"] if rows is None else rows


def _clean(checked: DataFrame, cfg: LoadConfig) -> DataFrame:
    return checked.drop(ISSUES, *[c for c in [cfg.corrupt_record_column] if c])


def load_frame(spark: SparkSession, df: DataFrame, cfg: LoadConfig, run_id: str = "", load_id: str = "") -> LoadResult:
    """Shape, validate and write a source frame.

    The schema is checked as it was read: an ERROR there ends the load before
    any data is read. Rows that no rule can stop go from source to target in
    one pass; where an ERROR rule may hold them back, or a merge needs them
    more than once, they are stored first. A retry gives the ``load_id`` of the
    run it repeats, so that a target that keeps loads apart takes the rows once.
    """
    load_id = load_id or run_id or uuid.uuid4().hex
    dry_run = as_flag(cfg.dry_run)
    if not dry_run:
        _check_target(spark, cfg)
    started = datetime.now()
    findings = schema_findings(df, cfg.validations, cfg.schema)
    if has_error(findings):
        if not dry_run:
            _log_validation(spark, findings, cfg, run_id, started)
        return LoadResult(ledger.COMPLETED_WITH_VALIDATION_ERROR, 0, findings)
    selected = select_rows(df, cfg)
    replacing = cfg.merge or cfg.write_mode.lower() == "overwrite"
    if replacing and is_empty(selected):  # nothing must not replace anything
        return LoadResult(ledger.COMPLETED_WITH_ZERO, 0, findings)
    try:
        return _load_selected(spark, selected, cfg, run_id, load_id, findings, started)
    except (AnalysisException, ValueError):
        # What an empty source lacks for the later steps does not matter. Nothing is written by then.
        if is_empty(selected):
            return LoadResult(ledger.COMPLETED_WITH_ZERO, 0, findings)
        raise


def _load_selected(
    spark: SparkSession,
    selected: DataFrame,
    cfg: LoadConfig,
    run_id: str,
    load_id: str,
    findings: list[Row],
    started: datetime,
) -> LoadResult:
    shaped = shape(selected, cfg)
    validated = run_validations(shaped, _rules(shaped, cfg))
    if as_flag(cfg.dry_run):
        summary = [*findings, *(validated.summary.collect() if validated.can_fail else [])]
        rows = shaped.count()
        return LoadResult(final_status(summary, rows), rows, summary)
    if not validated.can_block and not cfg.merge:
        summary, rows = _only_warned(validated, cfg, run_id, load_id, findings)
        if summary and rows:
            _log_validation(spark, summary, cfg, run_id, started)
        return LoadResult(final_status(summary, rows), rows, summary)

    with stored(validated) as (result, rows):
        summary = [*findings, *result.summary.collect()]  # one row per failed rule and column
        verdict = gate(result, summary, rows)
        if summary and rows:
            _log_validation(spark, summary, cfg, run_id, started)
        if len(summary) > len(findings):
            _quarantine(result.issue_rows, cfg, run_id)
        # Last: a run that fails before it can be started again without doubling rows of the target.
        if verdict.to_target is not None:
            _write(_clean(verdict.to_target, cfg), cfg, load_id)
    return LoadResult(verdict.status, rows, summary)


def _log_validation(
    spark: SparkSession, summary: list[Row], cfg: LoadConfig, run_id: str, started: datetime
) -> None:
    table = cfg.validation_run_details_table_name
    if table:
        rules = spark.createDataFrame(summary, "rule string, column string, action string, failed_rows bigint")
        log = ledger.validation_log(rules.coalesce(1), run_id, started, datetime.now())
        sinks.append_evolving(log, table)


class RunLedger:
    """Status events of one run, appended to the run table; no table, no events."""

    def __init__(self, spark: SparkSession, cfg: LoadConfig):
        self.spark, self.cfg = spark, cfg
        self.table = cfg.job_run_details_table_name
        if self.table:
            cfg.require("run_date")
        self.run_id = cfg.run_id or uuid.uuid4().hex
        self.started = datetime.now()
        self.job_id = cfg.job_id
        self.events: list[tuple] = []

    @property
    def load_id(self) -> str:
        """What a retry has in common with the run it repeats: a given run id, else the ledger's job and run date."""
        if self.cfg.run_id or not self.table or not self.job_id:
            return self.run_id
        return f"{self.job_id}.{self.cfg.run_date}"

    def resolve_job(self) -> None:
        """Look the job up by its four settings, registering it if it is new."""
        table = self.cfg.job_details_table_name
        if self.job_id or not table:
            return
        self.cfg.require(*ledger.JOB_KEY)
        settings = {name: getattr(self.cfg, name) for name in (*ledger.JOB_KEY, "env", "job_name", "frequency")}
        types = ", ".join(f"{name} string" for name in settings)
        request = self.spark.createDataFrame([tuple(settings.values())], types)
        if self.spark.catalog.tableExists(table):
            new = ledger.register_jobs(self.spark.table(table), request)
        else:
            new = ledger.register_jobs(request.limit(0), request)
        sinks.append_evolving(new.coalesce(1), table)
        self.job_id = ledger.find_job(self.spark.table(table), *[settings[name] for name in ledger.JOB_KEY])

    def record(self, status: str, rows: int = 0, error: str = "", last: bool = True) -> None:
        """Note an event. The start is written at once, later ones together with the run's last."""
        if not self.table:
            return
        now = datetime.now()
        run_date = datetime.strptime(self.cfg.run_date, "%Y-%m-%d").date()
        self.events.append((self.run_id, self.job_id, now, now, self.started, now, run_date, rows, status, error))
        if last:
            frame = self.spark.createDataFrame(self.events, ledger.RUN_SCHEMA).coalesce(1)
            sinks.append_evolving(frame, self.table, partition_by=["run_date"])
            self.events = []

    def refusal(self) -> str | None:
        """Why this run must not go on, if another run of its job and date is done or under way."""
        if not self.table or not self.spark.catalog.tableExists(self.table):
            return None
        # This job and date only: a handful of status rows out of the ledger.
        events = self.spark.table(self.table).where(
            (F.upper("job_id") == (self.job_id or "").upper())
            & (F.col("run_date") == F.lit(self.cfg.run_date).cast("date"))
        )
        runs = ledger.current_state(events)
        current = runs.where(F.col("run_id") == self.run_id).select("run_id", "job_id", "run_date", "run_start_time")
        if not is_empty(ledger.already_processed(runs, current)):
            return ledger.ALREADY_COMPLETED
        wait = self.cfg.wait_before_reprocessing_in_seconds
        if wait and not is_empty(ledger.duplicate_start(runs, current, wait)):
            return ledger.DUPLICATE_PARALLEL_START
        return None


def _recorded(spark: SparkSession, cfg: LoadConfig, work: Callable[[str, str], LoadResult]) -> LoadResult:
    """Do the work between its ledger entries. A failure is recorded and raised again."""
    run = RunLedger(spark, cfg)
    try:
        run.resolve_job()
        run.record(ledger.STARTED)
        refusal = run.refusal()
        if refusal:
            run.record(refusal)
            return LoadResult(refusal)
        run.record(ledger.READING_SOURCE_DATA, last=False)
        result = work(run.run_id, run.load_id)
        run.record(result.status, result.row_count)
        return result
    except Exception as error:
        run.record(ledger.FAILED, error=str(error))
        raise


def _load(spark: SparkSession, cfg: LoadConfig, run_id: str, load_id: str) -> LoadResult:
    cfg, gaps = without_gaps(spark, cfg)
    df = read_source(spark, cfg)
    if df is None or as_flag(cfg.skip_write):
        return LoadResult(ledger.COMPLETED, missing_dates=gaps)
    return replace(load_frame(spark, df, cfg, run_id, load_id), missing_dates=gaps)


def run_load(spark: SparkSession, cfg: LoadConfig) -> LoadResult:
    """Run one configured load and record it."""
    if cfg.ingest_type.strip().lower() == "sql_batch":
        return run_sql_batch(spark, cfg.sqls, cfg.values)
    return _recorded(spark, cfg, lambda run_id, load_id: _load(spark, cfg, run_id, load_id))


def run_sql_batch(spark: SparkSession, steps: list[dict], common: dict | None = None) -> LoadResult:
    """Run SQL steps in order, each validated, gated and written to its own target, and record them as one run.

    A failing step ends the batch; a step whose rows fail validation does not.
    """
    if not steps:
        raise ValueError("no SQL steps defined")

    def work(run_id: str, load_id: str) -> LoadResult:
        results = []
        for n, step in enumerate(steps):
            try:
                cfg = LoadConfig.from_layers(common, step, {"ingest_type": "sql"})
                results.append(_load(spark, cfg, run_id, f"{load_id}.{n}"))
            except Exception as error:
                raise ValueError(f"step {step.get('name', 'unnamed_step')!r} failed: {error}") from error
        return LoadResult(
            min((r.status for r in results), key=WORST_FIRST.index),
            sum(r.row_count for r in results),
            [row for r in results for row in r.summary],
            results,
        )

    return _recorded(spark, LoadConfig.from_layers(common), work)
