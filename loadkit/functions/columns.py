"""Derived and audit columns."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.functions.types import spark_type


def _require_new(df: DataFrame, name: str) -> None:
    if name in df.columns:
        raise ValueError(f"column {name!r} already exists")


def add_literal(df: DataFrame, name: str, value: Any, data_type: str | None = None) -> DataFrame:
    _require_new(df, name)
    literal = F.lit(value)
    return df.withColumn(name, literal.cast(spark_type(data_type)) if data_type else literal)


def add_current_timestamp(df: DataFrame, name: str) -> DataFrame:
    _require_new(df, name)
    return df.withColumn(name, F.current_timestamp())


def row_hash(cols: list[str], separator: str = "_", null_token: str | None = None) -> Column:
    """SHA-256 of the joined columns.

    Without ``null_token`` a null column is left out of the joined text, so
    ``(a, null)`` and ``(null, a)`` hash alike.
    """
    parts = [F.col(c) for c in cols]
    if null_token is not None:
        parts = [F.coalesce(p.cast("string"), F.lit(null_token)) for p in parts]
    return F.sha2(F.concat_ws(separator, *parts), 256)


def add_hash(
    df: DataFrame, name: str, cols: list[str], separator: str = "_", null_token: str | None = None
) -> DataFrame:
    _require_new(df, name)
    unknown = [c for c in cols if c not in df.columns]
    if not cols or unknown:
        raise ValueError(f"cannot hash, unknown columns {unknown} among {cols}")
    return df.withColumn(name, row_hash(cols, separator, null_token))


def add_derived_columns(df: DataFrame, specs: list[dict]) -> DataFrame:
    """Add columns from specs, in order; a later one may use an earlier one."""

    def add(current: DataFrame, spec: dict) -> DataFrame:
        name = spec["column_name"]
        if spec.get("value") is not None:
            return add_literal(current, name, spec["value"], spec.get("data_type"))
        function = spec.get("function_name") or ("hash" if spec.get("hash_of") else None)
        if function == "hash":
            return add_hash(current, name, spec["hash_of"])
        if function == "current_timestamp":
            return add_current_timestamp(current, name)
        raise ValueError(f"unknown function {function!r} for column {name!r}")

    return reduce(add, specs, df)


def differs(left: list[Column], right: list[Column]) -> Column:
    """True if any pair differs; null equals null only."""
    return reduce(lambda a, b: a | b, [~x.eqNullSafe(y) for x, y in zip(left, right, strict=True)], F.lit(False))
