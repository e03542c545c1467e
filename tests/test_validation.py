import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from loadkit.operators import ledger as L
from loadkit.operators import validation as V
from loadkit.plans.gate import final_status, gate
from tests.conftest import DATA, plan, rows


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(
        [(1, "a", "5"), (2, None, "x"), (None, None, None), (4, "d", "6.5")], "id int, name string, n string"
    )


def found(result):
    issues = result.issue_rows.select(F.explode(V.ISSUES).alias("i")).groupBy("i.rule", "i.column", "i.action").count()
    return rows(issues)


def test_each_rule(raw):
    assert found(V.run_validations(raw, [V.null_check(["id", "name"], "error")])) == [
        ("null_check", "id", "ERROR", 1),
        ("null_check", "name", "ERROR", 2),
    ]
    assert found(V.run_validations(raw, [V.type_check({"n": "int"})])) == [("type_check", "n", "ERROR", 2)]
    # A condition that is null passes.
    assert found(V.run_validations(raw, [V.expression_check("small", "id < 4", "WARNING")])) == [
        ("small", "id < 4", "WARNING", 1)
    ]


def test_schema_check(raw):
    schema = {"id": {"data_type": "int"}, "who": {"source_column_name": "name"}, "n": {"data_type": "int"}, "z": {}}
    assert V.schema_differences(raw, schema) == [("n", "int", "string"), ("z", "string", None)]
    result = V.run_validations(raw, [V.schema_check(schema)])
    assert {r["failed_rows"] for r in result.summary.collect()} == {4}
    assert V.run_validations(raw, [V.schema_check({"id": {"data_type": "int"}})]).issue_rows.isEmpty()


def test_all_rules_in_one_pass(raw):
    rules = [V.null_check(["name"]), V.type_check({"n": "int"}), V.expression_check("small", "id < 4")]
    result = V.run_validations(raw, rules)
    assert rows(result.summary.select("rule", "failed_rows")) == [("null_check", 2), ("small", 1), ("type_check", 2)]
    assert result.checked.count() == 4
    clean = result.checked.where(F.col(V.ISSUES).isNull())
    assert rows(clean.select("id")) == [(1,)]
    # Rows that fail several rules carry all of them.
    two = result.issue_rows.where("id = 2").first()[V.ISSUES]
    assert [i["rule"] for i in two] == ["null_check", "type_check"]


def test_known_counts_and_single_scan(spark):
    raw = spark.read.parquet(f"{DATA}/orders.parquet").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 11 == 0, "bad").otherwise(F.floor("o_totalprice").cast("string")).alias("price_txt"),
        "o_orderpriority",
    )
    rules = [
        V.null_check(["o_orderstatus"]),
        V.type_check({"price_txt": "bigint"}),
        V.expression_check("not_low", "o_orderpriority <> '5-LOW'"),
    ]
    result = V.run_validations(raw, rules)
    assert {r["rule"]: r["failed_rows"] for r in result.summary.collect()} == {
        "null_check": 1154,
        "type_check": 1364,
        "not_low": 2996,
    }
    assert result.issue_rows.count() == 4942
    text = plan(result.checked)
    assert text.count("FileScan") == 1 and "Exchange" not in text and "Python" not in text


def test_bad_rules(raw):
    with pytest.raises(ValueError, match="action"):
        V.null_check(["id"], "FATAL")
    with pytest.raises(ValueError, match="unknown columns"):
        V.run_validations(raw, [V.null_check(["nope"])])
    with pytest.raises(ValueError, match="unknown validation"):
        V.rules_from_config([{"name": "regex_check"}])
    with pytest.raises(ValueError, match="needs a schema"):
        V.rules_from_config([{"name": "schema_check"}])


def test_rules_from_config(raw):
    rules = V.rules_from_config(
        [
            {"name": "schema_check", "action_on_unexpected": "ERROR"},
            {"name": "null_check", "action_on_unexpected": "WARNING", "columns": ["name"]},
            {"name": "type_check", "columns": {"n": "int"}},
            {"name": "small", "expression": "id < 4", "action_on_unexpected": "ERROR"},
        ],
        {"id": {"data_type": "int"}},
    )
    assert found(V.run_validations(raw, rules)) == [
        ("null_check", "name", "WARNING", 2),
        ("small", "id < 4", "ERROR", 1),
        ("type_check", "n", "WARNING", 2),
    ]


ROW = Row("rule", "column", "action", "failed_rows")
WARNED, FAILED = ROW("r", "c", "WARNING", 3), ROW("r", "c", "ERROR", 1)


@pytest.mark.parametrize(
    "summary, n_rows, status",
    [
        ([], 5, L.COMPLETED),
        ([WARNED], 5, L.COMPLETED_WITH_VALIDATION_WARNING),
        ([WARNED, FAILED], 5, L.COMPLETED_WITH_VALIDATION_ERROR),
        ([], 0, L.COMPLETED_WITH_ZERO),
    ],
)
def test_final_status(summary, n_rows, status):
    assert final_status(summary, n_rows) == status


@pytest.mark.parametrize(
    "action, to_target, to_quarantine", [("WARNING", 4, 2), ("ERROR", None, 2), (None, 4, None)]
)
def test_gate(raw, action, to_target, to_quarantine):
    result = V.run_validations(raw, [V.null_check(["name"], action)] if action else [V.null_check(["id"])][:0])
    verdict = gate(result, result.summary.collect(), 4)
    assert (verdict.to_target and verdict.to_target.count()) == to_target
    assert (verdict.to_quarantine and verdict.to_quarantine.count()) == to_quarantine
    if verdict.to_target:
        assert verdict.to_target.columns == raw.columns
