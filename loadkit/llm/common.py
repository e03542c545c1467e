"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from loadkit.operators.keyed import join_per_key
from loadkit.session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: lineage ends there, and its shuffle files can go."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def in_small_batches(operator: Callable) -> Callable:
    """What the operator runs itself goes to Python by ``BATCH_BYTES`` (and a row), not by a number of rows of any length.

    A batch of ten thousand texts lies several times in the executor, outside
    its heap, and once or twice in the worker. What is run later, out of the
    frame that the operator returns, has the session's own setting.
    """

    @wraps(operator)
    def run(docs: DataFrame, *args, **kwargs):
        conf = docs.sparkSession.conf
        before = conf.get(_BATCH)
        conf.set(_BATCH, str(BATCH_BYTES))
        try:
            return operator(docs, *args, **kwargs)
        finally:
            conf.set(_BATCH, before)

    return run


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of a few rows of the driver. They go as Arrow: plain rows would start Python workers of a second kind, which stay."""
    kind = StructType.fromDDL(schema)
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(kind.names, row, strict=True)) for row in rows], to_arrow_schema(kind)), kind)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a frame made by ``stored`` that nothing will read again."""
    spark = df.sparkSession
    jvm = spark._jvm
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def bucket_of(*columns: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def numbered(df: DataFrame, within: list[str], bucket: str, order: list[str], name: str) -> DataFrame:
    """Adds a gapless number from 0 within each value of ``within``.

    Rows are numbered inside (within, bucket) and shifted by the counts of the
    earlier buckets, so no task holds all rows of a value. ``bucket`` must take
    a bounded number of values; none of the columns may be null in a way that
    matters, as they are compared null-safely.
    """
    keys = [*within, bucket]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        df.withColumn("_rank", rank)
        .join(offsets, same)
        .withColumn(name, (F.col("_before") + F.col("_rank") - 1).cast("long"))
        .drop("_rank", "_before", *[f"_o_{k}" for k in keys])
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node that can be reached.

    Large-star and small-star steps by turns, each a minimum per node with
    map-side combine and a join that Spark can split at a hot node, until every
    node hangs on its root. Nodes without edges do not occur; null nodes are
    not allowed.
    """
    pairs = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), name
    )
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = join_per_key(both.where("b > a"), low, ["a"], "inner")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = join_per_key(large, low, ["a"], "inner")
        after = small.select("b", "m").where("b != m").union(low.select("a", "m")).toDF("a", "b").distinct()
        after = stored(after, name)
        drop_stored(pairs)
        pairs = after
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def hash_bits(hashes: DataFrame, size: int) -> bytes:
    """A bit per remainder of the hashes in the one column: always ``size`` bits, whatever the number of rows.

    Tells for certain that a hash is not among them. It grows fuller with them,
    never larger, and serves to leave rows out before a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size // 8, np.uint8)
        for batch in batches:
            bit = (batch.column(0).drop_null().to_numpy().view(np.uint64) % np.uint64(size)).astype(np.int64)
            np.bitwise_or.at(bits, bit >> 3, (1 << (bit & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])

    bits = np.zeros(size // 8, np.uint8)
    for (part,) in hashes.repartition(2).mapInArrow(run, "bits binary").collect():
        bits |= np.frombuffer(part, np.uint8)
    return bits.tobytes()


def in_bits(hashes: np.ndarray, bits: bytes) -> np.ndarray:
    have = np.frombuffer(bits, np.uint8)
    bit = (hashes.view(np.uint64) % np.uint64(8 * len(have))).astype(np.int64)
    return have[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 > 0
