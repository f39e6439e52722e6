"""CSV, Parquet and JSON sources and sinks."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pulseframe import rules

# Column names, order and types of the purchase export.
PURCHASE_SCHEMA = T.StructType([
    T.StructField("Order Date", T.DateType()),
    T.StructField("Purchase Price Per Unit", T.DoubleType()),
    T.StructField("Quantity", T.DoubleType()),
    T.StructField("Shipping Address State", T.StringType()),
    T.StructField("Title", T.StringType()),
    T.StructField("ASIN/ISBN (Product Code)", T.StringType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Survey ResponseID", T.StringType()),
])


class CsvReadError(ValueError):
    """A CSV that cannot be read; the message is meant for the person who supplied it."""


def root_cause(error: Exception) -> str:
    """The message of the innermost cause of a failed read, without the stacks of the tasks around it."""
    inner = getattr(error, "java_exception", None)
    if inner is None:
        return str(error)
    while inner.getCause() is not None:
        inner = inner.getCause()
    return inner.getMessage()


def read_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType = PURCHASE_SCHEMA, *, multi_line: bool = True
) -> DataFrame:
    """Typed scan that holds the file to the schema's column names and order.

    Values that do not parse become NULL. Multi-line files cannot be split: one file is one task. Pass
    ``multi_line=False`` for files without line breaks inside quotes and Spark splits them by size.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("dateFormat", "yyyy-MM-dd")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_any_csv(
    spark: SparkSession, path: str, *, multi_line: bool = True, sampling_ratio: float | None = None
) -> DataFrame:
    """CSV scan with inferred types. Inference is a pass of its own; ``sampling_ratio`` shortens it for data
    whose types show in a sample."""
    if not path.lower().rstrip("/").endswith(".csv"):
        raise CsvReadError(rules.NOT_A_CSV)
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("mode", "PERMISSIVE")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    if sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    try:
        return reader.csv(path)
    except PySparkException as error:
        raise CsvReadError(rules.CSV_UNREADABLE % error) from error


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per line. NULL fields are kept, so that every document has every field."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, *, as_array: bool = False) -> DataFrame:
    """Documents with a declared schema. ``as_array`` reads files that hold one JSON array."""
    return spark.read.schema(schema).option("multiLine", as_array).json(path)


def table_facts(df: DataFrame) -> DataFrame:
    """Record count, column count and column names of a loaded table, as one row."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.array(*[F.lit(n) for n in df.columns]).alias("columns"),
        F.lit(df.schema.simpleString()).alias("schema"),
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)

