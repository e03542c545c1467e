"""File tables dealt out by a hash of their key, so that a merge rewrites only what its keys can be in.

The table is partitioned by a bucket that follows from the key. A merge works
out the buckets of its source's keys, reads only those, and puts them back in
one dynamic overwrite; files of other buckets are neither read nor written.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegralType

from loadkit.operators.merge import merge
from loadkit.session import scratch_table
from loadkit.sinks.tables import _create, _insert, _replace_partitions, require_table

BUCKET = "key_bucket"
PROPERTY = "loadkit.hashed"


def _bucket(keys: list[str], kinds: list[DataType], buckets: int) -> Column:
    """The bucket of a key: equal keys hash alike, whatever whole-number type they come in."""
    parts = [F.col(k).cast("bigint" if isinstance(kind, IntegralType) else kind) for k, kind in zip(keys, kinds, strict=True)]
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


def create_hashed(df: DataFrame, table: str, keys: list[str], buckets: int = 256) -> int:
    """Write a new table in ``buckets`` partitions by a hash of ``keys``; the number of rows written.

    Rows with null keys are kept like others. Take as many buckets as make one
    a few hundred megabytes when the table has its size: a merge writes a whole
    bucket for each of its keys at worst.
    """
    if not keys or buckets < 1:
        raise ValueError("a hashed table needs keys and at least one bucket")
    if BUCKET in (c.lower() for c in df.columns):
        raise ValueError(f"{BUCKET!r} is the name of the table's own column")
    kinds = [df.schema[k].dataType for k in keys]
    if any(isinstance(k, (FloatType, DoubleType)) for k in kinds):
        raise ValueError("floating-point keys cannot be hashed: equal ones may differ in their bits")
    rows = _create(df.withColumn(BUCKET, _bucket(keys, kinds, buckets)), table, [BUCKET])
    settings = json.dumps({"keys": keys, "buckets": buckets})
    df.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PROPERTY}' = '{settings}')")
    return rows


def hashed_by(spark: SparkSession, table: str) -> tuple[list[str], int] | None:
    """Keys and number of buckets of a hashed table, or ``None`` for others."""
    found = [r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if r["key"] == PROPERTY]
    return (lambda x: (x["keys"], x["buckets"]))(json.loads(found[0])) if found else None


def hashed_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a hashed table, without its bucket column."""
    return spark.table(table).drop(BUCKET)


def _files(spark: SparkSession, table: str, touched: list[int]) -> set[str]:
    spark.catalog.refreshTable(table)
    return set(spark.table(table).where(F.col(BUCKET).isin(touched)).inputFiles())


def rewrite_hashed(source: DataFrame, table: str, change: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
    """Rewrite the buckets that the source's keys belong to; the number of rows written.

    ``change`` gets the table's rows of these buckets and the source's rows,
    both with their bucket, and gives what the buckets hold from now on. Their
    files are listed before they are read and again before they are replaced:
    if another run has written one of them meanwhile, this one fails and changes
    nothing. A source without rows writes nothing.
    """
    spark = source.sparkSession
    require_table(spark, table)
    settings = hashed_by(spark, table)
    if settings is None:
        raise ValueError(f"{table} is not a hashed table")
    own, buckets = settings
    target = spark.table(table)
    dealt = source.withColumn(BUCKET, _bucket(own, [target.schema[k].dataType for k in own], buckets))
    touched = sorted(r[0] for r in dealt.select(BUCKET).distinct().collect())  # as many as there are buckets, at most
    if not touched:
        return 0
    before = _files(spark, table, touched)
    near = spark.table(table).where(F.col(BUCKET).isin(touched))
    staged = scratch_table(spark, "merged")
    try:
        rows = _create(change(near, dealt), staged)
        if _files(spark, table, touched) != before:
            raise RuntimeError(f"{table} was written by another run meanwhile")
        values = spark.createDataFrame([(b,) for b in touched], f"{BUCKET} int")
        _replace_partitions(spark, table, [BUCKET], staged, values)
        return rows
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")


def merge_hashed(
    source: DataFrame,
    table: str,
    keys: list[str],
    update_columns: list[str] | None = None,
    delete_condition: str | None = None,
) -> int:
    """Merge into a hashed table, as ``operators.merge`` does; the number of rows written.

    ``keys`` must be those the table is hashed by, in any order. Only the
    buckets of the source's keys are read and written, as in ``rewrite_hashed``.
    """
    spark = source.sparkSession
    require_table(spark, table)
    settings = hashed_by(spark, table)
    if settings is None or sorted(settings[0]) != sorted(keys):
        raise ValueError(f"{table} is not hashed by {keys}")
    return rewrite_hashed(source, table, lambda near, dealt: merge(near, dealt, keys, update_columns, delete_condition))


def append_hashed(df: DataFrame, table: str) -> int:
    """Append rows, each to the bucket of its key."""
    spark = df.sparkSession
    settings = hashed_by(spark, table)
    if settings is None:
        raise ValueError(f"{table} is not a hashed table")
    kinds = [spark.table(table).schema[k].dataType for k in settings[0]]
    return _insert(df.withColumn(BUCKET, _bucket(settings[0], kinds, settings[1])), table)
