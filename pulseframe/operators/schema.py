"""Schema snapshots and their comparison. Only metadata is read; no table is scanned."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from pulseframe import rules

HISTORY_SCHEMA = "batch string, position int, column string, type string"
DRIFT_TYPE = T.StructType([
    T.StructField("detected", T.BooleanType()),
    T.StructField("baseline", T.BooleanType()),
    T.StructField("added_columns", T.ArrayType(T.StringType())),
    T.StructField("removed_columns", T.ArrayType(T.StringType())),
    T.StructField(
        "changed_data_types",
        T.ArrayType(T.StructType([
            T.StructField("column", T.StringType()),
            T.StructField("previous_type", T.StringType()),
            T.StructField("current_type", T.StringType()),
        ])),
    ),
])
DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def schema_snapshot(df: DataFrame, skip: Iterable[str] = ()) -> dict[str, str]:
    """Column name to type name, without the batch keys."""
    left_out = set(skip)
    return {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name not in left_out}


def schema_overview(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(schema_snapshot(df).items())]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def date_column(df: DataFrame) -> str | None:
    """The first date-typed column, else the first whose name speaks of dates or times."""
    typed = [f.name for f in df.schema.fields if isinstance(f.dataType, DATE_TYPES)]
    named = [n for n in df.columns if any(token in n.lower() for token in rules.DATE_NAME_TOKENS)]
    return next(iter(typed + named), None)


def schema_history(spark: SparkSession, batches: Mapping[str, DataFrame | dict[str, str]]) -> DataFrame:
    """Long table of the schemas of named batches, given as tables or as snapshots."""
    rows = []
    for batch, source in batches.items():
        snapshot = source if isinstance(source, dict) else schema_snapshot(source)
        rows += [(batch, i, name, kind) for i, (name, kind) in enumerate(snapshot.items())]
    return spark.createDataFrame(rows, HISTORY_SCHEMA)


def schema_drift(history: DataFrame) -> DataFrame:
    """Added, removed and re-typed columns of each batch against the batch before it.

    Batches are numbered in name order and matched on (number, column) with one full outer join; the first batch
    is the baseline. ``history`` holds one row per batch and column, whatever the size of the tables.
    """
    numbered = history.withColumn("number", F.dense_rank().over(Window.orderBy("batch")))
    batches = numbered.groupBy("batch", "number").agg(F.count(F.lit(1)).alias("columns"))
    last = numbered.agg(F.max("number")).scalar()
    current = numbered.select("number", "column", F.col("type").alias("current_type"))
    previous = numbered.filter(F.col("number") < last).select(
        (F.col("number") + 1).alias("number"), "column", F.col("type").alias("previous_type")
    )
    change = F.struct("column", "previous_type", "current_type")
    kept, gone = F.col("current_type").isNotNull(), F.col("previous_type").isNotNull()
    matched = current.join(previous, ["number", "column"], "full_outer").groupBy("number").agg(
        F.array_sort(F.collect_list(F.when(kept & ~gone, F.col("column")))).alias("added_columns"),
        F.array_sort(F.collect_list(F.when(gone & ~kept, F.col("column")))).alias("removed_columns"),
        F.array_sort(
            F.collect_list(F.when(F.col("current_type") != F.col("previous_type"), change))
        ).alias("changed_data_types"),
    )
    baseline = F.col("number") == 1
    only_later = lambda name: F.when(baseline, F.slice(name, 1, 0)).otherwise(F.col(name)).alias(name)
    compared = batches.join(matched, "number").select(
        "batch", baseline.alias("baseline"),
        only_later("added_columns"), only_later("removed_columns"), only_later("changed_data_types"),
    )
    found = F.size("added_columns") + F.size("removed_columns") + F.size("changed_data_types") > 0
    return compared.select(
        "batch", found.alias("detected"), "baseline", "added_columns", "removed_columns", "changed_data_types"
    )


def drift_literal(previous: Mapping[str, str] | None, current: Mapping[str, str]) -> Column:
    """Comparison of two snapshots held in the driver, as a constant column of the ``schema_drift`` shape."""
    before = dict(previous or {})
    both = sorted(before.keys() & current.keys()) if previous is not None else []
    changed = [(n, before[n], current[n]) for n in both if before[n] != current[n]]
    added = sorted(current.keys() - before.keys()) if previous is not None else []
    removed = sorted(before.keys() - current.keys())
    names = lambda items: F.array(*[F.lit(n) for n in items]).cast("array<string>")
    retyped = F.array(*[
        F.struct(F.lit(n).alias("column"), F.lit(a).alias("previous_type"), F.lit(b).alias("current_type"))
        for n, a, b in changed
    ]) if changed else F.array().cast(DRIFT_TYPE["changed_data_types"].dataType)
    return F.struct(
        F.lit(bool(added or removed or changed)).alias("detected"),
        F.lit(previous is None).alias("baseline"),
        names(added).alias("added_columns"),
        names(removed).alias("removed_columns"),
        retyped.alias("changed_data_types"),
    ).cast(DRIFT_TYPE)
