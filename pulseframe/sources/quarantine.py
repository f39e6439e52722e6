"""One parse of a CSV with two results: the rows that fit the schema, and the lines that do not, with their causes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from pulseframe.functions import c
from pulseframe.sources.files import PURCHASE_SCHEMA
from pulseframe.sources.staging import stage

LINE = "__line"
WRONG_NUMBER = "number of values"


class Quarantine(NamedTuple):
    """``rejected`` has ``line`` (the text as it stood) and ``causes`` (the columns whose value has another type, or
    ``WRONG_NUMBER``); the counts were observed while the file was parsed."""

    good: DataFrame
    rejected: DataFrame
    rows: int
    rejected_rows: int


def read_with_quarantine(
    spark: SparkSession, path: str, schema: T.StructType = PURCHASE_SCHEMA, *, multi_line: bool = True
) -> Quarantine:
    """Parse ``path`` once into the shared folder and split it there. No row is lost: a line is either good or rejected.

    Empty values are NULL and no fault. ``multi_line`` as in ``read_typed_csv``.
    """
    options = {
        "quote": '"', "escape": '"', "dateFormat": "yyyy-MM-dd", "columnNameOfCorruptRecord": LINE, "mode": "PERMISSIVE",
    }
    parsed = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(LINE, T.StringType())]))
        .options(header=True, enforceSchema=False, multiLine=multi_line, **options)
        .csv(path)
    )
    seen = Observation()
    observed = parsed.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(c(LINE)).alias("rejected"))
    parsed = stage(observed, "parsed")
    texts = ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema.fields)
    raw = F.from_csv(c(LINE), texts, {"quote": '"', "escape": '"', "multiLine": str(multi_line).lower()})
    with_raw = parsed.where(c(LINE).isNotNull()).withColumn("__raw", raw)
    value = lambda name: F.col("__raw").getField(name)
    faults = F.array_compact(F.array(*[
        F.when((F.trim(value(f.name)) != "") & c(f.name).isNull(), F.lit(f.name)) for f in schema.fields
    ]))
    rejected = with_raw.select(
        c(LINE).alias("line"), F.when(F.size(faults) > 0, faults).otherwise(F.array(F.lit(WRONG_NUMBER))).alias("causes")
    )
    counts = seen.get
    return Quarantine(parsed.where(c(LINE).isNull()).drop(LINE), rejected, counts["rows"], counts["rejected"])
