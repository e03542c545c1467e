"""Merges: every customer account, merged with a feed made of every part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.operators.merge import merge
from loadkit.queries.registry import query, table
from loadkit.session import scratch_table
from loadkit.sinks.hashed import create_hashed, hashed_rows, merge_hashed
from loadkit.sinks.tables import merge_into, write_table

FRAMES = """WITH mt AS (SELECT c_custkey AS account_id, c_name AS name, c_mktsegment AS segment FROM customer),
ms AS (SELECT p_partkey AS account_id, p_name AS name, p_type AS segment, p_size > 40 AS is_deleted FROM part)
"""
MERGED = """SELECT COALESCE(t.account_id, s.account_id) AS account_id,
       CASE WHEN s.account_id IS NULL THEN t.name ELSE s.name END AS name,
       COALESCE(t.segment, s.segment) AS segment
FROM mt t FULL OUTER JOIN ms s ON t.account_id = s.account_id
"""
NOT_DELETED = "WHERE NOT (t.account_id IS NOT NULL AND s.account_id IS NOT NULL AND s.is_deleted)"


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("account_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )


def feed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("account_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("segment"),
        (F.col("p_size") > 40).alias("is_deleted"),
    )


@query(FRAMES + MERGED)
def merge_update_insert(spark, sf):
    return merge(accounts(spark, sf), feed(spark, sf), ["account_id"], ["name"])


@query(FRAMES + MERGED + NOT_DELETED)
def merge_with_delete(spark, sf):
    return merge(accounts(spark, sf), feed(spark, sf), ["account_id"], ["name"], "source.is_deleted = true")


@query(FRAMES + "SELECT * FROM mt UNION ALL SELECT account_id, name, segment FROM ms s "
       "WHERE NOT EXISTS (SELECT 1 FROM mt WHERE mt.account_id = s.account_id)")
def merge_insert_only(spark, sf):
    return merge(accounts(spark, sf), feed(spark, sf), ["account_id"], [])


@query(FRAMES + MERGED + NOT_DELETED)
def merge_into_table(spark, sf):
    name = scratch_table(spark, "accounts")
    write_table(accounts(spark, sf), name)
    merge_into(feed(spark, sf), name, ["account_id"], ["name"], "source.is_deleted = true")
    return spark.table(name)


@query(FRAMES + MERGED + NOT_DELETED)
def merge_into_orc(spark, sf):
    name = scratch_table(spark, "accounts")
    spark.sql(f"CREATE TABLE {name} (account_id BIGINT, name STRING, segment STRING) USING orc")
    write_table(accounts(spark, sf), name)
    merge_into(feed(spark, sf), name, ["account_id"], ["name"], "source.is_deleted = true")
    return spark.table(name)


@query(FRAMES + MERGED + NOT_DELETED)
def merge_into_partitioned(spark, sf):
    """Only the segments that the feed touches are written again."""
    name = scratch_table(spark, "accounts")
    write_table(accounts(spark, sf), name, partition_by=["segment"])
    merge_into(feed(spark, sf), name, ["account_id"], ["name"], "source.is_deleted = true")
    return spark.table(name)


@query(FRAMES + MERGED + NOT_DELETED)
def merge_into_hashed(spark, sf):
    """The table is kept in buckets by a hash of the key; only those of the feed's keys are read and written."""
    name = scratch_table(spark, "accounts")
    create_hashed(accounts(spark, sf), name, ["account_id"], 64)
    merge_hashed(feed(spark, sf), name, ["account_id"], ["name"], "source.is_deleted = true")
    return hashed_rows(spark, name)
