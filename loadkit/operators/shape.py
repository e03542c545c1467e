"""Projection, filter, rename, cast, deduplication, custom transformations."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.config import render
from loadkit.functions.types import column_type, source_columns, spark_type


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns {missing}")
    return df.select(*cols)


def select_existing(df: DataFrame, cols: list[str] | None) -> DataFrame:
    """Project the names the frame has; keep every column if it has none of them."""
    known = [c for c in cols or [] if c in df.columns]
    return df.select(*known) if known else df


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def where(df: DataFrame, clause: str | Column) -> DataFrame:
    return df.where(clause)


def where_template(df: DataFrame, template: str, values: dict[str, Any]) -> DataFrame:
    """Filter by a clause whose ``{placeholders}`` are filled from ``values``."""
    try:
        return df.where(render(template, values, strict=True))
    except Exception as error:
        raise ValueError(f"failed to apply where clause {template!r}: {error}") from error


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the mapped columns the frame has, one after the other."""
    names = df.columns
    for old, new in mapping.items():
        if old == new or old not in names:
            continue
        if new in names:
            raise ValueError(f"renaming {old!r} would give more than one column {new!r}")
        names = [new if name == old else name for name in names]
    return df.toDF(*names)


def transform_columns(df: DataFrame, mapping: list[dict[str, str]]) -> DataFrame:
    """Rename columns, or with ``target_data_type`` add a cast copy beside the source column."""
    for item in mapping:
        if not isinstance(item, dict):
            raise ValueError(f"a column mapping must be a dict, got {item!r}")
        source, target = item["source_column"], item["target_column"]
        if source not in df.columns:
            raise ValueError(f"source column {source!r} not found")
        data_type = item.get("target_data_type")
        if data_type:
            df = df.withColumn(target, F.col(source).cast(spark_type(data_type)))
        else:
            df = rename_columns(df, {source: target})
    return df


def conform(
    df: DataFrame, schema: dict[str, dict], on_error: str = "raise", keep_others: bool = False
) -> DataFrame:
    """Project and cast raw columns to a configured schema, under its names.

    ``on_error="null"`` turns values that do not parse into null instead of
    failing. ``keep_others`` takes the schema for the columns that are there,
    and lets the others follow them.
    """
    if on_error not in ("raise", "null"):
        raise ValueError(f"on_error must be 'raise' or 'null', got {on_error!r}")

    def column(name: str, spec: dict) -> Column:
        raw = F.col(spec.get("source_column_name", name))
        target = column_type(spec)
        return (raw.try_cast(target) if on_error == "null" else raw.cast(target)).alias(name)

    wanted = source_columns(schema)
    if not keep_others:
        return df.select(*[column(name, spec) for name, spec in wanted.items()])
    wanted = {n: s for n, s in wanted.items() if s.get("source_column_name", n) in df.columns}
    taken = {s.get("source_column_name", n) for n, s in wanted.items()}
    return df.select(*[column(n, s) for n, s in wanted.items()], *[F.col(f"`{c}`") for c in df.columns if c not in taken])


def ordering(order_by: list[dict[str, str]]) -> list[Column]:
    """Sort columns from ``{column, direction}`` specs; nulls first ascending, last descending."""
    return [
        F.col(spec["column"]).desc() if spec.get("direction", "asc").lower() == "desc" else F.col(spec["column"]).asc()
        for spec in order_by
    ]


def first_per_key(df: DataFrame, keys: list[str | Column], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark limits each key to ``n`` rows inside every map task before the
    shuffle (WindowGroupLimit), so a hot key sends at most ``n`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def dedup_latest(df: DataFrame, keys: list[str] | None, order_by: list[dict[str, str]] | None) -> DataFrame:
    """Keep the first row per key; without keys or order, keep every row."""
    if not keys or not order_by:
        return df
    return first_per_key(df, keys, ordering(order_by))


Transform = Callable[[DataFrame], DataFrame] | dict[str, str]


def apply_transforms(df: DataFrame, transforms: list[Transform]) -> DataFrame:
    """Apply functions, or ``{column: SQL expression}`` dicts, in order."""
    for i, step in enumerate(transforms, start=1):
        try:
            if callable(step):
                df = df.transform(step)
            else:
                df = df.withColumns({name: F.expr(text) for name, text in step.items()})
        except Exception as error:
            raise ValueError(f"failed to apply custom transformation #{i}: {error}") from error
    return df
