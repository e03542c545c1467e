"""Readers by ingest type."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from loadkit.config import LoadConfig, as_flag
from loadkit.functions.types import schema_from_config
from loadkit.sources import files, sql
from loadkit.sources.dated import DatedLayout, present_dates, read_dated


def _located(cfg: LoadConfig, reader: Callable[[list[str]], DataFrame]) -> DataFrame:
    if cfg.source_location:
        return reader([cfg.source_location])
    if not cfg.run_dates:
        cfg.require("run_date")
    return read_dated(
        reader,
        DatedLayout.from_config(cfg),
        cfg.run_dates or cfg.run_date,
        cfg.path_column,
        cfg.run_date_column,
        cfg.missing_dates,
    )


def without_gaps(spark: SparkSession, cfg: LoadConfig) -> tuple[LoadConfig, list[str]]:
    """Settings that name only run dates with a location, and the others, where these are to be skipped."""
    if cfg.missing_dates != "skip" or cfg.source_location or not cfg.run_dates:
        return cfg, []
    there, gaps = present_dates(spark, DatedLayout.from_config(cfg), cfg.run_dates)
    return (replace(cfg, run_dates=there), gaps) if there else (cfg, gaps)


def _schema(cfg: LoadConfig):
    schema = schema_from_config(cfg.schema) if cfg.schema else None
    return schema if schema else None


def _csv(spark: SparkSession, cfg: LoadConfig) -> DataFrame:
    def read(paths: list[str]) -> DataFrame:
        return files.read_delimited(
            spark,
            paths,
            _schema(cfg),
            delimiter=cfg.delimiter,
            quote=cfg.quote,
            multi_line=as_flag(cfg.multi_line),
            corrupt_column=cfg.corrupt_record_column,
            unparsed=cfg.unparsed,
        )

    return _located(cfg, read)


def _parquet(spark: SparkSession, cfg: LoadConfig) -> DataFrame:
    def read(paths: list[str]) -> DataFrame:
        files.check_extension(paths, "parquet")
        return files.read_parquet(spark, paths)

    return _located(cfg, read)


def _json(spark: SparkSession, cfg: LoadConfig) -> DataFrame:
    def read(paths: list[str]) -> DataFrame:
        return files.read_json(
            spark, paths, _schema(cfg), as_flag(cfg.multi_line), cfg.corrupt_record_column, cfg.unparsed
        )

    return _located(cfg, read)


def _table(spark: SparkSession, cfg: LoadConfig) -> DataFrame:
    if cfg.sql_query and cfg.sql_query.strip():
        return sql.read_sql(spark, cfg.sql_query.strip(), cfg.values)
    cfg.require("source_table")
    return sql.read_table(spark, cfg.source_table)


def _sql(spark: SparkSession, cfg: LoadConfig) -> DataFrame | None:
    cfg.require("sql_file_location")
    return sql.read_sql_file(spark, cfg.sql_file_location, cfg.values)


READERS: dict[str, Callable[[SparkSession, LoadConfig], DataFrame | None]] = {
    "csv": _csv,
    "parquet": _parquet,
    "json": _json,
    "table": _table,
    "delta": _table,
    "sql": _sql,
}


def read_source(spark: SparkSession, cfg: LoadConfig) -> DataFrame | None:
    reader = READERS.get(cfg.ingest_type.strip().lower())
    if reader is None:
        raise ValueError(f"unknown ingest type {cfg.ingest_type!r}, expected one of {sorted(READERS)}")
    return reader(spark, cfg)
