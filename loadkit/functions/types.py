"""Configuration type names and Spark schemas."""

from __future__ import annotations

from pyspark.sql import types as T

from loadkit.config import as_flag

# Type names a configuration may use.
SIMPLE_TYPES: dict[str, type[T.DataType]] = {
    "string": T.StringType,
    "int": T.IntegerType,
    "integer": T.IntegerType,
    "long": T.LongType,
    "short": T.ShortType,
    "byte": T.ByteType,
    "float": T.FloatType,
    "double": T.DoubleType,
    "boolean": T.BooleanType,
    "bool": T.BooleanType,
    "date": T.DateType,
    "timestamp": T.TimestampType,
    "binary": T.BinaryType,
    "struct": T.StructType,
}


def spark_type(name: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """Type for a configuration name, or for any Spark DDL type text."""
    if not isinstance(name, str):
        raise TypeError(f"type name must be text, got {type(name).__name__}")
    text = name.strip().lower()
    if not text:
        raise ValueError("empty type name")
    if text == "decimal":
        return T.DecimalType() if precision is None else T.DecimalType(int(precision), int(scale or 0))
    if text in SIMPLE_TYPES:
        return SIMPLE_TYPES[text]()
    try:
        return T.StructType.fromDDL(f"c {name.strip()}")[0].dataType
    except Exception as error:
        raise ValueError(f"unsupported data type {name!r}") from error


def column_type(spec: dict) -> T.DataType:
    return spark_type(spec.get("data_type", "string"), spec.get("precision"), spec.get("scale"))


def source_columns(schema: dict[str, dict]) -> dict[str, dict]:
    """Configured columns that the source itself carries."""
    return {name: spec for name, spec in schema.items() if not as_flag(spec.get("derived_column"))}


def schema_from_config(schema: dict[str, dict]) -> T.StructType:
    """Schema of the source, under the source's own column names."""
    return T.StructType(
        [
            T.StructField(spec.get("source_column_name", name), column_type(spec))
            for name, spec in source_columns(schema).items()
        ]
    )


#: Whole-number types by width, with the digits they need.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_MOMENTS = (T.DateType, T.TimestampType, T.TimestampNTZType)


def promoted(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both without loss; text where no other does.

    Whole numbers widen to longer ones, then to decimals with the digits of
    both sides; short whole numbers and floats to double; dates to timestamps.
    Binary, nested and interval types are only like themselves, whatever they
    say of nulls.
    """
    if a == b or isinstance(b, T.NullType) or a.simpleString() == b.simpleString():
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return a if _WHOLE[type(a)] >= _WHOLE[type(b)] else b
    if all(isinstance(x, T.DecimalType) or type(x) in _WHOLE for x in (a, b)):
        sizes = [(x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType) else (_WHOLE[type(x)], 0) for x in (a, b)]
        whole, scale = (max(s) for s in zip(*sizes, strict=True))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if all(isinstance(x, (T.FloatType, T.DoubleType)) or _WHOLE.get(type(x), 99) <= 10 for x in (a, b)):
        return T.DoubleType()
    if isinstance(a, _MOMENTS) and isinstance(b, _MOMENTS) and isinstance(T.DateType(), (type(a), type(b))):
        return b if isinstance(a, T.DateType) else a
    plain = (*_WHOLE, T.DecimalType, T.FloatType, T.DoubleType, T.BooleanType, T.StringType, T.CharType, T.VarcharType, *_MOMENTS)
    if isinstance(a, plain) and isinstance(b, plain):
        return T.StringType()
    raise ValueError(f"no type holds both {a.simpleString()} and {b.simpleString()}")
