import hashlib

import pytest
from pyspark.sql import types as T

from loadkit.functions import columns as C
from loadkit.functions.types import schema_from_config, spark_type


# The type names of configuration files.
@pytest.mark.parametrize(
    "name, expected",
    [
        ("string", T.StringType()),
        (" INT ", T.IntegerType()),
        ("integer", T.IntegerType()),
        ("long", T.LongType()),
        ("short", T.ShortType()),
        ("byte", T.ByteType()),
        ("float", T.FloatType()),
        ("double", T.DoubleType()),
        ("bool", T.BooleanType()),
        ("date", T.DateType()),
        ("timestamp", T.TimestampType()),
        ("binary", T.BinaryType()),
        ("DECIMAL(10,0)", T.DecimalType(10, 0)),
        ("bigint", T.LongType()),
        ("array<int>", T.ArrayType(T.IntegerType())),
        ("map<string,int>", T.MapType(T.StringType(), T.IntegerType())),
    ],
)
def test_spark_type(spark, name, expected):
    assert spark_type(name) == expected


@pytest.mark.parametrize("precision", [1, 7, 38])
@pytest.mark.parametrize("scale", [None, 0, 1])
def test_decimal(precision, scale):
    assert spark_type("Decimal", precision, scale) == T.DecimalType(precision, scale or 0)


def test_decimal_without_precision():
    assert spark_type("decimal") == T.DecimalType(10, 0)


def test_bad_types(spark):
    with pytest.raises(ValueError):
        spark_type("nonsense")
    with pytest.raises(ValueError):
        spark_type(" ")
    with pytest.raises(TypeError):
        spark_type(5)


def test_schema_from_config():
    """Source names and types in the order given; derived columns, however that is written, are not read."""
    read = {
        "invoice": {"data_type": "long", "source_column_name": "INV_NO"},
        "net": {"data_type": "decimal", "precision": 9, "scale": 4, "derived_column": "no"},
        "note": {},
    }
    derived = {f"d{i}": {"data_type": "string", "derived_column": flag} for i, flag in enumerate((True, "True", "yes"))}
    expected = T.StructType().add("INV_NO", "long").add("net", T.DecimalType(9, 4)).add("note", "string")
    assert schema_from_config(derived | read) == schema_from_config(read | derived) == expected
    assert schema_from_config(derived) == T.StructType()


def test_hash(spark):
    df = spark.createDataFrame([("a", None, 1)], "a string, b string, c int")
    joined = C.add_hash(df, "h", ["a", "b", "c"]).first()["h"]
    assert joined == hashlib.sha256(b"a_1").hexdigest()
    marked = C.add_hash(df, "h", ["a", "b", "c"], separator="|", null_token="~").first()["h"]
    assert marked == hashlib.sha256(b"a|~|1").hexdigest()


def test_existing_and_unknown_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    for add in (lambda: C.add_literal(df, "a", 1), lambda: C.add_current_timestamp(df, "a"), lambda: C.add_hash(df, "a", ["a"])):
        with pytest.raises(ValueError, match="already exists"):
            add()
    with pytest.raises(ValueError, match="unknown columns"):
        C.add_hash(df, "h", ["b"])


def test_derived_columns(spark):
    df = spark.createDataFrame([("x",)], "name string")
    specs = [
        {"column_name": "src", "data_type": "STRING", "value": "obs"},
        {"column_name": "n", "data_type": "int", "value": "7"},
        {"column_name": "h", "data_type": "STRING", "hash_of": ["name"]},
        {"column_name": "at", "data_type": "timestamp", "function_name": "current_timestamp"},
    ]
    row = C.add_derived_columns(df, specs).first()
    assert (row["src"], row["n"], row["h"]) == ("obs", 7, hashlib.sha256(b"x").hexdigest())
    assert row["at"] is not None
    with pytest.raises(ValueError, match="unknown function"):
        C.add_derived_columns(df, [{"column_name": "z", "function_name": "md5"}])
