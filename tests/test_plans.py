"""Shuffles of the main operators, so that a change does not add one unseen."""

import pytest

from loadkit.operators import history as H
from loadkit.operators import ledger as L
from loadkit.operators.merge import merge
from loadkit.operators.shape import dedup_latest
from tests.conftest import DATA, plan

KEYS, DATE, VALUES = ["id"], "at", ["v"]


@pytest.fixture
def frames(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    wide = orders.selectExpr("o_custkey AS id", "DATE(o_orderdate) AS at", "o_orderstatus AS v", "o_totalprice AS w")
    return wide, wide.where("v <> 'P'")


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.mark.parametrize(
    "build, expected",
    [
        # One shuffle of the rows, each key already cut to one row per task.
        (lambda s, t: dedup_latest(s, KEYS, [{"column": DATE, "direction": "desc"}]), 1),
        # Source rows once; the target's keys by key and date, and once more for the join.
        (lambda s, t: H.not_in_target(s, t, KEYS, DATE), 3),
        # The batch's keys and the target meet first (three, none where the batch is small enough to be sent to all).
        (lambda s, t: H.join_last_known(s, t, KEYS, DATE, VALUES), 6),
        # Then target and questions by key and date, their line by key, then answers and source rows for the join.
        (lambda s, t: H.changed_asof(s, t, KEYS, DATE, VALUES), 8),
        (lambda s, t: H.changed_vs_last_known(s, t, KEYS, DATE, VALUES), 12),
        # Closing rows: newest rows and batch keys are laid out alike, so their join adds none.
        (lambda s, t: H.expired_keys(s, t.selectExpr("*", "DATE(null) AS valid_till"), KEYS, DATE, "2010-01-01"), 2),
        (lambda s, t: L.current_state(s.selectExpr("id AS run_id", "at AS _created", "at AS _modified", "v")), 1),
    ],
)
def test_shuffles(frames, build, expected):
    assert shuffles(build(*frames)) == expected


def test_small_merge_source_leaves_the_target_in_place(spark, frames, conf):
    wide, _ = frames
    conf(spark__sql__autoBroadcastJoinThreshold="10MB")
    source = spark.createDataFrame([(1, "2024-01-01", "x", 1.0)], "id bigint, at string, v string, w double")
    landed = source.withColumn("at", source["at"].cast("date")).limit(1)
    text = plan(merge(wide, landed, KEYS, ["v"]))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 3


def test_only_needed_columns_are_read(frames):
    source, target = frames
    text = plan(H.changed_asof(source.select("id", "at", "v"), target, KEYS, DATE, VALUES))
    assert "o_totalprice" not in text and "o_orderpriority" not in text


def test_chained_batches_are_shuffled_twice(frames):
    """By key and date, and by key; before that the batch's keys and the target meet (three)."""
    source, target = (f.select("id", "at", "v") for f in frames)
    text = plan(H.changed_asof(source, target, KEYS, DATE, VALUES, chain=True))
    assert text.count("Exchange hashpartitioning") == 5 and text.count("Join") == 1


def test_kept_newest_rows_save_a_pass(frames):
    source, target = frames
    newest = H.last_known(target, KEYS, DATE)
    assert shuffles(H.changed_vs_last_known(source, target, KEYS, DATE, VALUES, newest=newest)) <= 6
