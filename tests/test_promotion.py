"""Tables whose columns widen."""

import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.functions.types import promoted, spark_type
from loadkit.session import scratch_table
from loadkit.sinks import tables as sinks
from tests.conftest import rows

KINDS = ["byte", "short", "int", "long", "decimal(5,2)", "decimal(38,10)", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz", "string"]


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        ("int", "long", "bigint"), ("byte", "short", "smallint"), ("int", "decimal(5,2)", "decimal(12,2)"), ("long", "decimal(38,10)", "decimal(38,10)"),
        ("decimal(38,0)", "decimal(5,2)", "string"), ("float", "double", "double"), ("int", "float", "double"), ("long", "double", "string"),
        ("date", "timestamp", "timestamp"), ("timestamp_ntz", "date", "timestamp_ntz"), ("timestamp", "timestamp_ntz", "string"), ("int", "string", "string"),
        ("boolean", "int", "string"), ("array<int>", "array<int>", "array<int>"),
    ],
)
def test_pairs(spark, a, b, want):
    assert promoted(spark_type(a), spark_type(b)).simpleString() == promoted(spark_type(b), spark_type(a)).simpleString() == want


def test_lattice(spark):
    """The order of the types doesn't matter, and nothing gets narrower."""
    kinds = [spark_type(k) for k in KINDS]
    for a, b in itertools.product(kinds, repeat=2):
        both = promoted(a, b)
        assert both == promoted(b, a) and promoted(both, a) == both and promoted(both, b) == both
    assert promoted(T.NullType(), T.DateType()) == promoted(T.DateType(), T.NullType()) == T.DateType()
    for other in ("binary", "array<int>", "struct<a:int>"):
        with pytest.raises(ValueError, match="no type holds"):
            promoted(spark_type(other), T.StringType())


def test_a_column_widens_step_by_step(spark):
    name = scratch_table(spark, "evolving")
    steps = [("int", 1, "int"), ("bigint", 1 << 40, "bigint"), ("smallint", 2, "bigint"), ("decimal(6,3)", 0.125, "decimal(22,3)"), ("string", "n/a", "string")]
    for i, (kind, value, after) in enumerate(steps):
        frame = spark.createDataFrame([(i,)], "step int").withColumn("VALUE" if i else "value", F.lit(value).cast(kind)).withColumn("note", F.lit(None))
        sinks.append_evolving(frame.drop("note") if i == 0 else frame.withColumn("note", F.lit(f"s{i}")), name)
        assert spark.table(name).schema["value"].dataType.simpleString() == after
        assert spark.table(name).count() == i + 1
    want = [(0, "1.000", None), (1, "1099511627776.000", "s1"), (2, "2.000", "s2"), (3, "0.125", "s3"), (4, "n/a", "s4")]
    assert rows(spark.table(name)) == want


def test_a_partitioned_table_stays_so(spark):
    name = scratch_table(spark, "evolving")
    sinks.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "id int, part string"), name, partition_by=["part"])
    sinks.append_evolving(spark.createDataFrame([("x", "a")], "id string, part string"), name)
    assert sinks.partition_columns(spark, name) == ["part"] and rows(spark.table(name)) == [("1", "a"), ("2", "b"), ("x", "a")]


def test_types_that_nothing_holds_leave_the_table(spark):
    name = scratch_table(spark, "evolving")
    sinks.append_evolving(spark.createDataFrame([(1,)], "id int"), name)
    with pytest.raises(ValueError, match="no type holds"):
        sinks.append_evolving(spark.createDataFrame([([1],)], "id array<int>"), name)
    assert rows(spark.table(name)) == [(1,)]


def test_nested_types_that_differ_in_nulls(spark):
    """A quarantine takes a second run's issues, whose arrays are declared by what that run's rules can give."""
    name = scratch_table(spark, "issues")
    for i in (F.array(F.struct(F.lit("r").alias("rule"))), F.array(F.struct(F.lit(None).cast("string").alias("rule")), F.lit(None))):
        sinks.append_evolving(spark.range(1).select(i.alias("issues")), name)
    assert spark.table(name).select(F.size("issues")).count() == 2
