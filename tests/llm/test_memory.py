"""What the pipeline's operators leave in the executors' memory."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loadkit.llm import decontamination, jaccard, mixing, quality, sharding
from loadkit.llm.common import BATCH_BYTES, in_small_batches, local_frame
from tests.conftest import rows

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_go_by_bytes(spark):
    @in_small_batches
    def longest(docs):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["bytes", "n"])

        return docs.mapInArrow(run, "bytes long, n long").agg(F.max("bytes"), F.sum("n")).first()

    before = spark.conf.get(LIMIT)
    docs = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("x"), 3000).alias("text"))
    most, n = longest(docs)
    assert most < 1.1 * BATCH_BYTES and n == 6000  # all of them, 18 MB, in one batch otherwise
    assert spark.conf.get(LIMIT) == before


@pytest.mark.parametrize(
    "operator, others",
    [
        (jaccard.similar_groups, []),
        (decontamination.contaminated, ["item_id int, text int"]),
        (quality.fit, ["doc_id int, quality int"]),
    ],
)
def test_operators_on_texts_run_in_small_batches(spark, operator, others):
    seen = []

    class Docs:
        sparkSession = spark

        def select(self, *_):
            seen.append(spark.conf.get(LIMIT))
            raise InterruptedError

    with pytest.raises(InterruptedError):
        operator(Docs(), *[spark.createDataFrame([(1, 0), (2, 1)], schema) for schema in others])
    assert seen == [str(BATCH_BYTES)]


def test_local_frames_start_no_python(spark):
    schema = "k array<string>, b int, n long, x double"
    want = [([None, "a"], 1, 2**40, 0.5), ([], None, None, None)]
    made = local_frame(spark, want, schema)
    assert rows(made) == rows(spark.createDataFrame(want, schema)) and made.dtypes == spark.createDataFrame(want, schema).dtypes
    assert rows(local_frame(spark, [], schema)) == []


def test_mixing_and_sharding_run_without_python(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.lit("one two").alias("text"), F.lit("en").alias("lang"))
    for made in (mixing.mixed_rows(docs), sharding.assign_shards(docs)):
        assert "PythonRDD" not in made._jdf.queryExecution().toRdd().toDebugString()
