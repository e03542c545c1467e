"""A corpus pipeline from the operators in ``loadkit.llm``: each stage is written and read again.

A stage takes (spark, docs, sf_dir) and returns what is left of ``docs``, with
the columns of documents; the last one returns the shards. No stage reads
ids as unique: rows are told apart by id and text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.llm import decontamination, jaccard, mixing, quality, sharding
from loadkit.llm.common import stored, table


def _same(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str):
    """Joins rows to keys by id and text hash, null-safely."""
    return docs["doc_id"].eqNullSafe(keys[id_col]) & (F.xxhash64(docs["text"]) == keys[text_col])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier selects; the labels of the whole corpus train it."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.graded(docs, model).where("selected").select("row.*")


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the smallest id. Texts without words stay."""
    groups = jaccard.similar_groups(docs)
    kept = groups.where("n_shingles = 0 or is_first").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_t")).distinct()
    left = docs.join(kept, _same(docs, kept, "_id", "_t"), "left_semi")
    again = groups.where("n_shingles > 0 and is_first").groupBy("doc_id", "text_key").count().where("count > 1")
    if again.isEmpty():
        return left
    # rows that are there several times: their texts are equal, so any one will do
    once = left.where("text is not null").dropDuplicates(["doc_id", "text"])
    return once.unionByName(left.where("text is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = stored(decontamination.contaminated(docs, table(spark, sf_dir, "benchmark")), "leaks")
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_t")).distinct()
    return docs.join(found, _same(docs, found, "_id", "_t"), "left_anti")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: each document as often as the mix takes it."""
    taken = mixing.mixed_rows(docs).where("_copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("_copies")))).select("row.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A shard and a slot for every row."""
    return sharding.assign_shards(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", duplicates_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mixing_sources", mixing_stage),
    ("sharding", sharding_stage),
]

#: No SQL: a trained model and iterative moves decide the rows; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
