import pytest

from loadkit.operators.keyed import join_per_key
from tests.conftest import rows


@pytest.mark.parametrize(
    "left, right", [("int", "int"), ("int", "bigint"), ("bigint", "decimal(12,2)"), ("double", "double"), ("string", "int")]
)
def test_key_types(spark, left, right):
    a = spark.sql(f"SELECT CAST(k AS {left}) AS k, v FROM VALUES (0, 'z'), (1, 'a'), (2, 'b'), (NULL, 'n') t(k, v)")
    b = spark.sql(f"SELECT CAST(k AS {right}) AS k, w FROM VALUES (0, 5), (1, 10), (NULL, 30) t(k, w)")
    assert rows(join_per_key(a, b, ["k"], "left").select("v", "w")) == [("a", 10), ("b", None), ("n", None), ("z", 5)]
    assert rows(join_per_key(a, b, ["k"], "left_anti").select("v")) == [("b",), ("n",)]
    assert rows(join_per_key(a, b, ["k"], "inner").select("v", "w")) == [("a", 10), ("z", 5)]


def test_negative_zero(spark):
    a = spark.sql("SELECT -0.0D AS k, 1 AS i")
    b = spark.sql("SELECT 0.0D AS k, 1 AS i, 'hit' AS w")
    assert join_per_key(a, b, ["k", "i"], "inner").count() == 1
