"""Writes to catalog tables.

File tables have no UPDATE or MERGE and cannot be overwritten while they are
read, so a replacement is written beside the table before it takes its place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadkit.functions.types import promoted
from loadkit.operators.keyed import join_per_key
from loadkit.operators.merge import merge
from loadkit.session import scratch_table

# Table formats with a MERGE of their own.
MERGE_FORMATS = ("delta", "iceberg")
MODES = ("append", "overwrite", "ignore", "error", "errorifexists")


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows as they pass; the action that runs the frame fills ``observation.get["rows"]``.

    Put it last before a write: there each task counts once. Further up, a map
    stage that is run again after a lost executor is counted again.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def _observed(df: DataFrame, table: str, write: Callable[[DataFrame], None]) -> int:
    df, observation = counted(df, f"write {table} {uuid.uuid4().hex[:8]}")
    write(df)
    return observation.get["rows"]


def _gathered(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Gathers each partition value into few files; AQE splits values too large for one task."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def _create(df: DataFrame, table: str, partition_by: list[str] | None = None, provider: str | None = None) -> int:
    writer = lambda out: (out.write.format(provider) if provider else out.write).mode("errorifexists")
    parts = partition_by or []
    return _observed(_gathered(df, parts), table, lambda out: (writer(out).partitionBy(*parts) if parts else writer(out)).saveAsTable(table))


def _insert(df: DataFrame, table: str, overwrite: bool = False) -> int:
    """Insert by column name into a table that exists, in the format it has."""
    spark = df.sparkSession
    wanted = spark.table(table).columns
    given = {c.lower(): c for c in df.columns}
    if sorted(given) != sorted(c.lower() for c in wanted) or len(given) != len(df.columns):
        raise ValueError(f"{table} has columns {wanted}, got {df.columns}")
    rows = _gathered(df.select(*[F.col(f"`{given[c.lower()]}`").alias(c) for c in wanted]), partition_columns(spark, table))
    return _observed(rows, table, lambda out: out.write.insertInto(table, overwrite=overwrite))


def _exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def require_table(spark: SparkSession, table: str) -> None:
    if not _exists(spark, table):
        raise ValueError(f"Target table {table!r} not found")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def append_table(df: DataFrame, table: str, dry_run: bool = False) -> int:
    """Append by column name to a table that exists; the number of rows. A dry run only counts."""
    require_table(df.sparkSession, table)
    if dry_run:
        return df.count()
    return _insert(df, table)


def check_partitioning(spark: SparkSession, table: str, mode: str, partition_by: list[str] | None) -> None:
    """Raise if rows for these partitions cannot be appended to the table."""
    if mode == "append" and partition_by and _exists(spark, table):
        actual = partition_columns(spark, table)
        if partition_by != actual:
            raise ValueError(f"{table} is partitioned by {actual}, cannot append partitioned by {partition_by}")


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "append",
    partition_by: list[str] | None = None,
    dry_run: bool = False,
) -> int:
    """Write with a mode, creating the table if need be; the number of rows written.

    A table that exists keeps its format. ``ignore`` writes nothing to it.
    """
    spark = df.sparkSession
    parts = partition_by if isinstance(partition_by, list) else []
    if mode not in MODES:
        raise ValueError(f"mode must be one of {list(MODES)}, got {mode!r}")
    if dry_run:
        return df.count()
    if not _exists(spark, table):
        return _create(df, table, parts)
    if mode == "ignore":
        return 0
    if mode.startswith("error"):
        raise ValueError(f"table {table!r} exists already")
    if mode == "overwrite":
        return replace_table(df, table, parts or None)
    check_partitioning(spark, table, mode, parts)
    return _insert(df, table)


def append_evolving(df: DataFrame, table: str, dry_run: bool = False, partition_by: list[str] | None = None) -> int:
    """Append, creating the table (partitioned if asked), adding new columns and widening those whose type has changed.

    Columns the frame lacks become null. Where the table's type of a column
    can't hold the frame's (``promoted``), the table is written again with the
    wider type and swapped in before the rows are added, so a failure leaves it as
    it was or merely wider. A frame of narrower types just fits in.
    """
    spark = df.sparkSession
    if dry_run:
        return df.count()
    if not _exists(spark, table):
        return _create(df, table, partition_by)
    known = {f.name.lower(): f for f in spark.table(table).schema}
    types = {f.name: promoted(known[f.name.lower()].dataType, f.dataType) for f in df.schema if f.name.lower() in known}
    wider = {known[c.lower()].name: kind for c, kind in types.items() if kind != known[c.lower()].dataType}
    if wider:
        held = spark.table(table)
        replace_table(held.withColumns({c: F.col(f"`{c}`").cast(kind) for c, kind in wider.items()}), table)
    new = [f for f in df.schema if f.name.lower() not in known]
    if new:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    present = {c.lower() for c in df.columns}
    absent = {f.name: F.lit(None).cast(f.dataType) for name, f in known.items() if name not in present}
    return _insert(df.withColumns({c: F.col(f"`{c}`").cast(kind) for c, kind in types.items()} | absent), table)


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table besides its columns."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    at = next((i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed Table")), len(rows))
    return {r["col_name"]: r["data_type"] for r in rows[at + 1 :]}


def _identity(spark: SparkSession, table: str) -> tuple:
    """Changes when another run puts new rows in a table's place."""
    details = _details(spark, table)
    return details.get("Created Time"), details.get("Location")


def _describe_alike(spark: SparkSession, table: str, like: str) -> None:
    """Give a table the comment and the properties of another."""
    comment = _details(spark, like).get("Comment")
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS '{_quoted(comment)}'")
    own = [r for r in spark.sql(f"SHOW TBLPROPERTIES {like}").collect() if not r["key"].startswith(("transient_", "spark.sql.", "numFiles", "totalSize"))]
    listed = ", ".join(f"'{_quoted(r['key'])}' = '{_quoted(r['value'])}'" for r in own if r["key"] not in ("comment", "owner", "provider", "location", "external"))
    if listed:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def replace_table(df: DataFrame, table: str, partition_by: list[str] | None = None) -> int:
    """Replace the table's rows; ``df`` may read the table itself.

    The new rows are written beside the table, under a name of this run's own,
    and swapped in by two renames. Until then, and if the write fails, the
    table is as it was; after a crash between the renames the old rows are in
    ``<table>__old_…``. Format, comment and properties stay, and those of the
    columns too if their names and types do. If another run has replaced the
    table meanwhile, this one fails: its rows come from a table that is gone.
    """
    spark = df.sparkSession
    require_table(spark, table)
    mark = uuid.uuid4().hex[:12]
    staged, old = f"{table}__staged_{mark}", f"{table}__old_{mark}"
    before = _identity(spark, table)
    actual = partition_columns(spark, table)
    parts = partition_by or [c for c in actual if c in df.columns]
    fields = lambda schema: sorted((f.name.lower(), f.dataType.simpleString()) for f in schema)
    try:
        if parts == actual and fields(df.schema) == fields(spark.table(table).schema):
            spark.sql(f"CREATE TABLE {_in_schema(staged)} LIKE {_in_schema(table)}")
            rows = _insert(df, staged)
        else:
            rows = _create(df, staged, parts, _format(spark, table))
        _describe_alike(spark, staged, table)
        if _identity(spark, table) != before:
            raise RuntimeError(f"{table} was replaced by another run meanwhile")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    _rename(spark, table, old)
    try:
        _rename(spark, staged, table)
    except Exception:
        _rename(spark, old, table)
        raise
    spark.sql(f"DROP TABLE {old}")
    return rows


def _rename(spark: SparkSession, table: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {table} RENAME TO {_in_schema(new)}")
    if partition_columns(spark, new):
        # Not every catalog moves the partitions along with their table.
        spark.sql(f"MSCK REPAIR TABLE {new} SYNC PARTITIONS")


def _in_schema(table: str) -> str:
    """``schema.table``: a rename takes no catalog."""
    return ".".join(table.split(".")[-2:])


def _format(spark: SparkSession, table: str) -> str:
    return _details(spark, table).get("Provider", "").lower()


def merge_statement(
    table: str, keys: list[str], update_columns: list[str] | None = None, delete_condition: str | None = None
) -> str:
    """MERGE text for a table format that has it; ``{merge_source}`` is the source frame.

    The delete comes first: of several matched clauses only the last may be unconditional.
    """
    lines = [
        f"MERGE INTO {table} AS target USING {{merge_source}} AS source",
        "ON " + " AND ".join(f"target.{k} = source.{k}" for k in keys),
    ]
    if delete_condition:
        lines.append(f"WHEN MATCHED AND ({delete_condition}) THEN DELETE")
    if update_columns:
        lines.append("WHEN MATCHED THEN UPDATE SET " + ", ".join(f"{c} = source.{c}" for c in update_columns))
    lines.append("WHEN NOT MATCHED THEN INSERT *")
    return "\n".join(lines)


def merge_into(
    source: DataFrame,
    table: str | None,
    keys: list[str] | None,
    update_columns: list[str] | None = None,
    delete_condition: str | None = None,
    dry_run: bool = False,
) -> int | None:
    """Merge into a table; the number of rows written, or ``None`` where its format merges by itself or on a dry run.

    Of a partitioned file table only the partitions that the merge touches are
    written again. A file table without partitions is written whole: give a
    long one partitions, or a format that has MERGE.
    """
    if not table or not keys:
        raise ValueError("target_table and merge_keys must be specified for merge")
    spark = source.sparkSession
    require_table(spark, table)
    if dry_run:
        return None
    if _format(spark, table) in MERGE_FORMATS:
        spark.sql(merge_statement(table, keys, update_columns, delete_condition), merge_source=source)
        return None
    parts = partition_columns(spark, table)
    if parts:
        return _merge_partitions(source, table, parts, keys, update_columns, delete_condition)
    return replace_table(merge(spark.table(table), source, keys, update_columns, delete_condition), table)


def _merge_partitions(
    source: DataFrame, table: str, parts: list[str], keys: list[str], update_columns: list[str] | None, delete_condition: str | None
) -> int:
    """Merge only the partitions that hold a key of the source, or that a source row belongs to.

    Their files are listed before they are read and again before they are
    replaced: if another run has written one of them meanwhile, this one fails
    and changes nothing.
    """
    spark = source.sparkSession
    target = spark.table(table)
    missing = [c for c in parts if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    wanted = source.select(*keys).distinct()
    hit = join_per_key(target.select(*keys, *[c for c in parts if c not in keys]), wanted, keys, "left_semi").select(*parts)
    own = source.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in parts])
    touched = scratch_table(spark, "touched")
    _create(hit.unionByName(own).distinct(), touched)
    staged = scratch_table(spark, "merged")
    try:
        values = spark.table(touched)
        spots = [tuple(r) for r in values.collect()]  # as many as there are partitions, at most
        before = partition_files(spark, table, parts, spots)
        same = reduce(lambda a, b: a & b, [target[c].eqNullSafe(values[c]) for c in parts])
        near = target.join(values, same, "left_semi")
        rows = _create(merge(near, source, keys, update_columns, delete_condition), staged)
        if partition_files(spark, table, parts, spots) != before:
            raise RuntimeError(f"{table} was written by another run meanwhile")
        _replace_partitions(spark, table, parts, staged, values)
        return rows
    finally:
        for scratch in (touched, staged):
            spark.sql(f"DROP TABLE IF EXISTS {scratch}")


def partition_files(spark: SparkSession, table: str, parts: list[str], spots: list[tuple]) -> set[str]:
    """Files of some partitions, as they are now; from the listing alone, no data is read."""
    if not spots:
        return set()
    spark.catalog.refreshTable(table)
    rows = spark.table(table)
    at = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(parts, spot, strict=True)]) for spot in spots]
    while len(at) > 1:  # in pairs: a chain of many partitions would be too deep to plan
        at = [reduce(lambda a, b: a | b, at[i : i + 2]) for i in range(0, len(at), 2)]
    return set(rows.where(at[0]).inputFiles())


def _replace_partitions(spark: SparkSession, table: str, parts: list[str], staged: str, values: DataFrame) -> None:
    """Put a staged table's rows in the place of the partitions ``values``; those that have lost all rows are dropped."""
    dynamic = spark.newSession()  # other writes of the caller's session keep their own overwrite mode
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            dynamic.conf.set(name, value)
    dynamic.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    _insert(dynamic.table(staged), table, overwrite=True)
    spark.catalog.refreshTable(table)
    left = spark.table(staged).select(*parts).distinct()
    emptied = values.join(left, reduce(lambda a, b: a & b, [values[c].eqNullSafe(left[c]) for c in parts]), "left_anti")
    for row in emptied.collect():  # partitions that lost their last row
        spec = ", ".join(f"`{c}` = {_literal(row[c])}" for c in parts)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def _literal(value: object) -> str:
    return "null" if value is None else str(value) if isinstance(value, (int, float)) else f"'{_quoted(str(value))}'"
