"""Distinct counts kept as mergeable state: one bitmap row per day, column and range of codes.

Every value of a column has a code in a stored dictionary. The state of a day has a bit for every code that occurs, in
pieces of 32,768 codes, so that it is bounded per row, and days merge to weeks, months or any span by OR. Counts are exact
and come from the state alone. ``sketch_state`` is the smaller option: one sketch per day and column, counts within some
percent.

NULLs have no code and do not count; rows without a date belong to no day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulseframe.functions import c


def daily_values(df: DataFrame, date: str, columns: Sequence[str]) -> DataFrame:
    """Distinct (day, column, value), values as text. Folds on the map side, so a hot value is a row per day and task."""
    values = F.inline(F.array(*[
        F.struct(F.lit(n).alias("column"), c(n).cast("string").alias("value")) for n in columns
    ]))
    return (
        df.select(c(date).cast("date").alias("day"), values).where("day IS NOT NULL AND value IS NOT NULL").distinct()
    )


def dictionary(daily: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``column``, ``value`` and ``code``: the rows of ``known`` and new codes behind them for values it lacks.

    Codes are unique, dense within a task and never change, so old states stay valid. The result has to be written before
    it is used: a second evaluation may number differently.
    """
    values = daily.select("column", "value").distinct()
    if known is None:
        return values.withColumn("code", F.monotonically_increasing_id())
    # The next multiple of the piece size behind all known codes.
    after = known.agg((F.floor(F.coalesce(F.max("code"), F.lit(-1)) / 32768) + 1) * 32768).scalar()
    fresh = values.join(known, ["column", "value"], "left_anti")
    return known.unionByName(fresh.withColumn("code", F.monotonically_increasing_id() + after))


def bitmap_state(daily: DataFrame, codes: DataFrame) -> DataFrame:
    """``day``, ``column``, ``piece`` and ``bits``. Joins one row per day and value with its code, not the facts.

    The codes are dealt by bitmap before any is built. Partial bitmaps would be 4 KB for every day and piece that a task
    has a code of, in the end one for each code. A bitmap has at most 32,768 codes, so none of them is hot.
    """
    coded = daily.join(codes, ["column", "value"]).select(
        "day", "column", F.bitmap_bucket_number("code").alias("piece"), F.bitmap_bit_position("code").alias("bit"))
    bitmap = ["day", "column", "piece"]
    return coded.repartition(*bitmap).groupBy(*bitmap).agg(F.bitmap_construct_agg("bit").alias("bits"))


def distinct_counts(state: DataFrame, span: Column) -> DataFrame:
    """Exact distinct values per ``span`` (an expression of ``day``, such as its week) and column, from bitmaps."""
    merged = state.groupBy(span.alias("span"), "column", "piece").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy("span", "column").agg(F.sum(F.bitmap_count("bits")).alias("distinct_values"))


def sketch_state(df: DataFrame, date: str, columns: Sequence[str], precision: int = 12) -> DataFrame:
    """``day``, ``column`` and a HyperLogLog sketch of its values with 2 ** ``precision`` registers."""
    values = F.inline(F.array(*[
        F.struct(F.lit(n).alias("column"), c(n).cast("string").alias("value")) for n in columns
    ]))
    long = df.select(c(date).cast("date").alias("day"), values).where("day IS NOT NULL")
    return long.groupBy("day", "column").agg(F.hll_sketch_agg("value", precision).alias("sketch"))


def approximate_counts(state: DataFrame, span: Column) -> DataFrame:
    """As ``distinct_counts``, from sketches; off by about 1.04 / sqrt(2 ** precision)."""
    merged = state.groupBy(span.alias("span"), "column").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("span", "column", F.hll_sketch_estimate("sketch").alias("distinct_values"))
