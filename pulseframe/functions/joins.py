"""Joining a large side with a small aggregate of itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from pulseframe.functions.columns import c

# A build side is broadcast only while (most groups there can be) x (bytes per row) stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 64


def fits_broadcast(small: DataFrame, rows: int | None, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``rows`` rows of the shape of ``small`` stay within ``limit`` bytes."""
    row_bytes = 16 + sum(64 if isinstance(f.dataType, T.StringType) else 16 for f in small.schema.fields)
    return rows is not None and rows * row_bytes <= limit


def join_split(large: DataFrame, small: DataFrame, by: Sequence[str], rows: str, salts: int = SALTS) -> DataFrame:
    """Inner join on ``by`` with an aggregate of ``large`` that may be big, with hot keys spread out.

    ``rows`` names the column of ``small`` that counts the rows of its key in ``large``; it is dropped. A key with
    more than 1/``salts`` of all rows is hot. There are fewer than ``salts`` of them, so their list may be broadcast,
    and only their rows of ``small`` are copied, once per salt. The salt is a hash of the row and of its partition,
    which a re-run task repeats.
    """
    total = small.agg(F.sum(rows)).scalar()
    hot = F.col(rows) * salts > total
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    spread = small.withColumn("__salt", F.explode(F.when(hot, every).otherwise(F.array(F.lit(0))))).drop(rows)
    keys = small.where(hot).select(*[c(k) for k in by], F.lit(True).alias("__hot"))
    mixed = F.pmod(F.xxhash64(*[c(n) for n in large.columns], F.spark_partition_id()), F.lit(salts)).cast("int")
    salted = large.join(F.broadcast(keys), list(by), "left").withColumn(
        "__salt", F.when(F.col("__hot"), mixed).otherwise(0)
    )
    return salted.drop("__hot").join(spread, [*by, "__salt"]).drop("__salt")


def attach(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the columns of ``right``, an aggregate with one row per ``by`` key, to ``left``.

    With keys this is an equi join. Without keys both sides are single rows and the right one is read as a
    scalar subquery, which needs no join at all.
    """
    if by:
        return left.join(right, list(by))
    row = right.select(F.struct(*[c(n) for n in right.columns])).scalar()
    return left.select("*", row.alias("__row")).select(*[c(n) for n in left.columns], "__row.*")
