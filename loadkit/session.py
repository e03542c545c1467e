"""Where intermediate tables go."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or the warehouse where that is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/loadkit/{uuid.uuid4().hex}/{name}"


def scratch_table(spark: SparkSession, name: str) -> str:
    """A new three-part table name whose managed files live in the shared folder."""
    root = shared_dir(spark)
    schema = f"loadkit_{hashlib.sha256(root.encode()).hexdigest()[:24]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{root}/{schema}'")
    return f"spark_catalog.{schema}.{name}_{uuid.uuid4().hex[:12]}"
