import random

import numpy as np

from loadkit.llm import repeats
from loadkit.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.helpers import SCHEMA, no_docs, odd_docs, without_repeats


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in df.collect()), key=repr)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op5_suffix_array_dedup"](spark, SMALL).collect()), key=repr)
    assert got == sorted(without_repeats(docs), key=repr)


def test_odd_rows(spark):
    # one id with one text: rows that share an id share their fate block by block
    docs = odd_docs(spark).where("doc_id is null or doc_id > 1")
    assert result(repeats.remove_repeats(docs)) == sorted(without_repeats([(r.doc_id, r.text) for r in docs.collect()]), key=repr)
    assert repeats.remove_repeats(no_docs(spark)).collect() == []


def passages(count, seed):
    """Texts of shared pieces, with pieces of few letters and of period, so that anchors tie."""
    dice = random.Random(seed)
    pieces = ["".join(dice.choices("ab", k=dice.randint(40, 200))) for _ in range(6)]
    pieces += ["abcd" * 40, "é" * 60, "".join(dice.choices("abcdefghij klmnop", k=300))]
    return [(i, "".join(dice.choice(pieces)[dice.randint(0, 30) :] for _ in range(dice.randint(1, 5)))) for i in range(count)]


def test_overlapping_passages(spark):
    rows = passages(60, 5)
    for parts in (1, 5):
        got = result(repeats.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(parts)))
        assert got == sorted(without_repeats(rows), key=repr)


def test_windows_of_a_hot_anchor_go_their_own_ways(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_BLOCKS", 1)
    rows = passages(40, 6)
    assert result(repeats.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(4))) == sorted(without_repeats(rows), key=repr)


def test_kept_bytes_and_spans(spark):
    text = "".join(map(chr, range(97, 123))) * 3
    rows = [(1, text), (2, "before " + text + " after")]
    got = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(rows, SCHEMA), with_bytes=True).collect()}
    assert bytes(got[1].kept) == text.encode() and got[1].spans == []
    assert bytes(got[2].kept) == b"before  after"
    assert [(s.start, s.end) for s in got[2].spans] == [(7, 7 + len(text))]


def test_suffix_runs():
    data = np.frombuffer(b"aabaabaab" + b"aabaab", np.uint8)
    starts, doc = np.array([0, 3, 9]), np.array([5, 5, 2])
    assert repeats.earlier_windows(data, starts, doc, 6).tolist() == [True, True, False]
