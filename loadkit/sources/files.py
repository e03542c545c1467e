"""File scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DELIMITED_EXTENSIONS = ("csv", "txt", "tsv")

Paths = str | list[str]


def check_extension(paths: Paths, allowed: str | tuple[str, ...]) -> None:
    """Raise unless every path ends with one of the extensions, in any case."""
    endings = tuple(f".{e.lower()}" for e in ([allowed] if isinstance(allowed, str) else allowed))
    for path in [paths] if isinstance(paths, str) else paths:
        if not path.lower().rstrip("/").endswith(endings):
            raise ValueError(f"invalid file extension for {path}, expected one of {endings}")


def _mode(reader: DataFrameReader, unparsed: str) -> DataFrameReader:
    if unparsed not in ("fail", "null"):
        raise ValueError(f"unparsed must be 'fail' or 'null', got {unparsed!r}")
    return reader.option("mode", "FAILFAST" if unparsed == "fail" else "PERMISSIVE")


def _check_headers(spark: SparkSession, path: Paths, names: list[str], options: dict[str, str]) -> None:
    """Raise unless the first line of every file holds these names in this order.

    One pass over the text, of which each task keeps a line per file that begins in it.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    headers = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    # one field more than there should be, to see a header that is too long
    wide = ", ".join(f"`_{i}` string" for i in range(len(names) + 1))
    found = F.array(*[F.col(f"h._{i}") for i in range(len(names) + 1)])
    wanted = F.array(*[F.lit(n) for n in names], F.lit(None).cast("string"))
    wrong = headers.withColumn("h", F.from_csv("header", wide, options)).where(~found.eqNullSafe(wanted)).first()
    if wrong:
        raise ValueError(f"header {wrong['header']!r} of {wrong['file']} does not match schema {names}")


def read_delimited(
    spark: SparkSession,
    path: Paths,
    schema: StructType | None = None,
    delimiter: str = ",",
    quote: str | None = None,
    multi_line: bool = False,
    escape: str | None = None,
    corrupt_column: str | None = None,
    extensions: tuple[str, ...] | None = DELIMITED_EXTENSIONS,
    unparsed: str = "fail",
) -> DataFrame:
    """Scan delimited text with a header line.

    With a schema, the header of every file must carry its names in its order:
    Spark reads delimited columns by position and would otherwise swap them
    silently. Without one, types are inferred by an extra pass over all of the
    text, so give a schema for large inputs. ``multi_line`` stops Spark from
    splitting a file over tasks; use it only where values contain line breaks.

    Lines that do not parse fail the scan; ``unparsed="null"`` reads their
    values as null instead, and ``corrupt_column`` adds a text column with
    those lines. With it, headers take a pass of their own over the text, as
    Spark doesn't check them for a schema with a column that files lack.
    """
    if extensions:
        check_extension(path, extensions)
    options = {"delimiter": delimiter}
    if quote is not None:
        options["quote"] = quote
    if escape is not None:
        options["escape"] = escape
    reader = spark.read.options(**options).option("header", True).option("multiLine", multi_line)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if corrupt_column:
        _check_headers(spark, path, schema.names, options)
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        return reader.schema(StructType(list(schema)).add(corrupt_column, "string")).csv(path)
    return _mode(reader, unparsed).option("enforceSchema", False).schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: Paths) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_json(
    spark: SparkSession,
    path: Paths,
    schema: StructType | None = None,
    multi_line: bool = False,
    corrupt_column: str | None = None,
    unparsed: str = "fail",
) -> DataFrame:
    """Scan JSON records. Records that do not parse fail the scan, are null or are kept as text, as in ``read_delimited``."""
    reader = spark.read.option("multiLine", multi_line)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        if schema is not None:
            schema = StructType(list(schema)).add(corrupt_column, "string")
    else:
        reader = _mode(reader, unparsed)
    return (reader.schema(schema) if schema is not None else reader).json(path)
