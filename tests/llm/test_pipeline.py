"""The stages of the corpus pipeline, each against what it has to do with its own input."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loadkit.llm import jaccard
from loadkit.llm.common import stored
from tests.conftest import DATA
from tests.llm.helpers import similar, words


@pytest.fixture(scope="module")
def frames(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], DATA), name))
    return out


def test_stages_keep_the_columns(frames):
    assert all(f.columns == frames[0].columns for f in frames[:-1])


def test_quality(frames, spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = {r.doc_id for r in frames[1].collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) / len(good) > 0.98
    assert sum(d in kept for d, q in labels.items() if q == 0) / sum(q == 0 for q in labels.values()) < 0.3


def test_one_of_each_group_stays(frames):
    before = [(r.doc_id, r.text) for r in frames[1].collect()]
    want = {c if n else d for d, n, c, _ in similar(before)}
    assert sorted(r.doc_id for r in frames[2].collect()) == sorted(want)


def test_leaks_go_and_the_others_stay(frames, spark):
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    before = {r.doc_id: r.text for r in frames[2].collect()}
    leaks = {d for d, t in before.items() if any(i in t for i in items)}
    assert {r.doc_id for r in frames[3].collect()} == before.keys() - leaks and leaks


def test_mix(frames):
    size = collections.Counter()
    for r in frames[3].collect():
        size[r.source] += len(words(r.text))
    taken = collections.Counter()
    copies = collections.Counter()
    for r in frames[4].collect():
        taken[r.source] += len(words(r.text))
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 3
    weights = {s: 1 + i % 3 for i, s in enumerate(sorted(size))}
    for s in size:
        share = sum(size.values()) * weights[s] / sum(weights.values())
        assert abs(taken[s] - min(share, 3 * size[s])) < 0.02 * share


def test_shards(frames):
    counts = [r["count"] for r in frames[5].groupBy("shard").count().collect()]
    assert sum(counts) == frames[4].count() and max(counts) - min(counts) <= 1


def test_rows_that_are_there_twice(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "h i j k l m"), (None, "h i j k l m"), (3, None), (3, None), (1, "quite another text of six words")],
        "doc_id long, text string",
    ).withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    left = corpus_pipeline.duplicates_stage(spark, docs, DATA)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        [(1, "a b c d e f g"), (None, "h i j k l m"), (3, None), (3, None), (1, "quite another text of six words")], key=repr
    )
    assert jaccard.similar_groups(docs).count() == 8
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, empty, DATA).count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").columns[:2] == ["doc_id", "size"]
