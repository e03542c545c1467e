"""Merge by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.operators.keyed import join_per_key


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_columns: list[str] | None = None,
    delete_condition: str | None = None,
) -> DataFrame:
    """The target after merging ``source`` into it.

    A matched row is deleted if ``delete_condition`` (SQL over ``target`` and
    ``source``) holds, else takes ``update_columns`` from the source. An
    unmatched source row is inserted, whatever the condition says; it needs
    every target column, and others are ignored. Null keys match nothing.
    Several source rows for one matched key raise at run time, unless there is
    nothing to update or delete. The source is read more than once: land one
    that is costly to derive, or not repeatable, first.
    """
    if not keys:
        raise ValueError("merge keys must be given")
    updates = update_columns or []
    missing = [c for c in {*target.columns, *updates} if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {sorted(missing)}")
    foreign = [c for c in updates if c not in target.columns]
    if foreign:
        raise ValueError(f"update columns {foreign} are not in the target")

    # Of the target's keys only those in the source matter: a small source is broadcast, and the rest of a long
    # target leaves at its scan.
    wanted = source.select(*keys).distinct()
    matched_keys = join_per_key(target.select(*keys), wanted, keys, "left_semi").distinct()
    inserted = join_per_key(source, matched_keys, keys, "left_anti").select(
        *[F.col(c).cast(field.dataType).alias(c) for c, field in zip(target.columns, target.schema)]
    )
    if not updates and not delete_condition:
        return target.unionByName(inserted)

    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rows = F.struct(*[c for c in source.columns if c not in keys])
    per_key = source.where(keyed).groupBy(*keys).agg(F.any_value(rows).alias("_row"), F.count("*").alias("_n"))
    # Kept in one struct, so that the check runs for whatever column is read.
    checked = F.when(F.col("_n") == 1, F.col("_row")).when(
        F.col("_n") > 1, F.raise_error(F.lit("several source rows match one target row"))
    )
    joined = join_per_key(target, per_key, keys, "left").select(
        F.struct(*target.columns).alias("target"),
        F.when(F.col("_n").isNotNull(), F.struct(*keys, checked.alias("_row"))).alias("_found"),
    )
    found = F.col("_found")
    joined = joined.select(
        "target",
        F.when(
            found.isNotNull(),
            F.struct(*[(found[c] if c in keys else found["_row"][c]).alias(c) for c in source.columns]),
        ).alias("source"),
    )
    if delete_condition:
        doomed = F.col("source").isNotNull() & F.coalesce(F.expr(delete_condition), F.lit(False))
        joined = joined.where(~doomed)
    matched = F.col("source").isNotNull()
    kept = joined.select(
        *[
            (
                F.when(matched, F.col("source")[c].cast(field.dataType)).otherwise(F.col("target")[c])
                if c in updates
                else F.col("target")[c]
            ).alias(c)
            for c, field in zip(target.columns, target.schema)
        ]
    )
    return kept.unionByName(inserted)
