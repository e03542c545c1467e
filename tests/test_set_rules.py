"""Rules on sets of rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from loadkit.operators import ledger as L
from loadkit.operators import validation as V
from loadkit.plans.load import load_frame
from loadkit.session import scratch_table
from tests.conftest import plan, rows
from tests.test_load import settings

ROWS = [(i, k, p, v) for i, (k, p, v) in enumerate(
    [("a", 1, 5), ("a", 1, 7), ("a", 2, None), ("b", 1, -9), (None, 1, 3), (None, 1, -4), ("c", None, 2), ("c", None, 2), ("", 0, None)]
)]


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(ROWS, "id int, k string, `p.q` int, v int")


def failing(df, *rules):
    issues = V.run_validations(df, list(rules)).issue_rows
    return rows(issues.select("id", F.concat_ws(",", F.transform(V.ISSUES, lambda i: i["rule"]))))


def test_unique(frame):
    seen = Counter((k, p) for _, k, p, _ in ROWS if k is not None and p is not None)
    assert failing(frame, V.unique_check(["k", "p.q"])) == [(i, "unique_check") for i, k, p, _ in ROWS if seen[k, p] > 1]
    ones = Counter(k for _, k, _, _ in ROWS if k is not None)
    assert failing(frame, V.unique_check(["k"])) == [(i, "unique_check") for i, k, _, _ in ROWS if ones[k] > 1]


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_reference(spark, frame, kind):
    held = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 1)], f"theirs string, n {kind}")
    want = [(i, "reference_check") for i, k, p, _ in ROWS if k is not None and p is not None and (k, p) != ("a", 1)]
    assert failing(frame, V.reference_check(["k", "p.q"], held, ["theirs", "n"])) == want
    name = scratch_table(spark, "held")
    held.write.saveAsTable(name)
    config = {"name": "reference_check", "columns": ["k"], "reference_table": name, "reference_columns": ["theirs"]}
    assert failing(frame, *V.rules_from_config([config])) == [(i, "reference_check") for i, k, *_ in ROWS if k not in ("a", "b", None)]
    assert len(failing(frame, V.reference_check(["k"], held.where("false"), ["theirs"]))) == 7
    with pytest.raises(ValueError, match="compares"):
        V.reference_check(["k"], held, ["theirs", "n"])


def test_aggregate(frame):
    sums = Counter()
    for _, k, _, v in ROWS:
        sums[k] += v or 0
    want = [(i, "in_credit") for i, k, _, _ in ROWS if k != "" and sums[k] < 0]
    assert failing(frame, V.aggregate_check("in_credit", "sum(v) >= 0", ["k"])) == want == [(3, "in_credit"), (4, "in_credit"), (5, "in_credit")]
    assert failing(frame, V.aggregate_check("few", "count(*) < 9")) == [(i, "few") for i, *_ in ROWS]
    assert failing(frame, V.aggregate_check("some", "count(*) > 8")) == []
    assert failing(frame.where("false"), V.aggregate_check("some", "count(*) > 8"), V.unique_check(["k"])) == []


def test_together_with_rules_on_rows(frame):
    config = [
        {"name": "unique_check", "columns": ["k", "p.q"], "action_on_unexpected": "WARNING"},
        {"name": "null_check", "columns": ["k"]},
        {"name": "in_credit", "aggregate": "sum(v) >= 0", "group_by": ["k"]},
    ]
    result = V.run_validations(frame, V.rules_from_config(config))
    assert result.checked.columns == [*frame.columns, V.ISSUES] and result.checked.count() == len(ROWS)
    assert failing(frame, *V.rules_from_config(config)) == [
        (0, "unique_check"), (1, "unique_check"), (3, "in_credit"), (4, "null_check,in_credit"), (5, "null_check,in_credit"),
    ]


@pytest.mark.parametrize("action, in_target, status", [
    ("WARNING", 9, L.COMPLETED_WITH_VALIDATION_WARNING), ("ERROR", 0, L.COMPLETED_WITH_VALIDATION_ERROR),
])
def test_through_the_gate(spark, frame, action, in_target, status):
    target = scratch_table(spark, "rows")
    frame = frame.withColumnRenamed("p.q", "p")
    frame.limit(0).write.saveAsTable(target)
    checks = [{"name": "unique_check", "columns": ["k", "p"], "action_on_unexpected": action}]
    cfg = settings(target, schema=None, audit_columns_to_be_added=[], validations=checks)
    result = load_frame(spark, frame, cfg)
    assert (result.status, [r["failed_rows"] for r in result.summary]) == (status, [2])
    assert spark.table(target).count() == in_target
    assert rows(spark.table(cfg.quarantine).select("id")) == [(0,), (1,)]


def test_a_hot_key_is_split(spark, conf):
    """A key with a third of all rows is read by several tasks where its rows are marked."""
    conf(
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__autoBroadcastJoinThreshold="-1",
    )
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(0, 60000, 1, 8).select(hot.alias("k"), F.col("id").alias("v"))
    result = V.run_validations(df, [V.unique_check(["k"])])
    assert result.issue_rows.count() == 20000
    checked = result.checked
    checked.collect()
    assert "SortMergeJoin(skew=true)" in plan(checked), plan(checked)
