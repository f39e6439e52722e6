"""Purchase-shaped data derived from the given star schema, with faults written into it.

The given tables hold no NULLs and no duplicate rows, so the view adds both by rule: NULLs and blanks in some
fields, repeated rows, two disturbed weeks and one replayed month. Every row of ``lineitem`` stays in.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseframe.operators import duplicates
from pulseframe.operators.cleaning import blank_to_null, in_date_ranges
from pulseframe.rules import DriftRules, Roles
from pulseframe.sources.staging import stage

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
ROLES = Roles(
    date="order_date", entity="response_id", product="product_code", category="category", region="state",
    quantity="quantity", price="unit_price",
)
STRINGS = ["state", "title", "category"]
PERIOD = "1995-2001"
DRIFT = DriftRules(period=PERIOD)

# Incident calendar: surge (rows sent three times, prices off, no category), outage (also quantities off and no
# state) and a month that was sent twice.
SURGE_WEEK = (date(1998, 6, 1), date(1998, 6, 8))
OUTAGE_WEEK = (date(1998, 9, 7), date(1998, 9, 14))
REPLAYED_MONTH = (date(1999, 3, 1), date(1999, 4, 1))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_purchases(spark: SparkSession, sf_dir: str, by_date: bool = False) -> DataFrame:
    """Uncleaned purchases: blank titles are still blank. ``by_date`` lays the rows out in date ranges.

    Orders meet their customers before the lines, so that a shuffled join moves the lines once for both, and the layout
    moves only what the view holds, before rows are repeated.
    """
    line, order, customer, nation, part = (
        table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "nation", "part")
    )
    buyers = (
        order.join(customer, order.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select("o_orderkey", "o_custkey", "n_name")
    )
    joined = (
        line.join(buyers, line.l_orderkey == buyers.o_orderkey)
        .join(part, line.l_partkey == part.p_partkey)
        .withColumn("day", F.col("l_shipdate").cast("date"))
    )
    inside = lambda span, day: (F.col(day) >= F.lit(span[0])) & (F.col(day) < F.lit(span[1]))
    surge, outage = inside(SURGE_WEEK, "day"), inside(OUTAGE_WEEK, "day")
    view = joined.select(
        F.col("day").alias("order_date"),
        (F.col("l_extendedprice") / F.col("l_quantity") * F.when(surge | outage, 20.0).otherwise(1.0)).alias(
            "unit_price"),
        F.when(F.col("l_orderkey") % 11 != 0, F.col("l_quantity") * F.when(outage, 20.0).otherwise(1.0)).alias(
            "quantity"),
        F.when((F.col("l_partkey") % 13 != 0) & ~outage, F.col("n_name")).alias("state"),
        F.when(F.col("p_size") % 10 == 0, F.lit("  ")).otherwise(F.col("p_name")).alias("title"),
        F.col("l_partkey").alias("product_code"),
        F.when((F.col("l_suppkey") % 17 != 0) & ~surge, F.col("p_type")).alias("category"),
        F.col("o_custkey").alias("response_id"),
        # Two bytes in place of the line's key.
        *([F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(4096)).cast("short").alias("spread")] if by_date else []),
    )
    if by_date:
        view = in_date_ranges(view, "order_date", ["spread"]).drop("spread")
    thrice = inside(SURGE_WEEK, "order_date") | inside(OUTAGE_WEEK, "order_date")
    twice = inside(REPLAYED_MONTH, "order_date") | (F.col("product_code") % 37 == 0)
    copies = F.when(thrice, 3).when(twice, 2).otherwise(1)
    return view.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).drop("copy")


_staged: dict[tuple[str, str, str], DataFrame] = {}


def staged_once(spark: SparkSession, sf_dir: str, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``build`` as a written table, made once per application and input."""
    key = (spark.sparkContext.applicationId, sf_dir if "://" in sf_dir else os.path.abspath(sf_dir), label)
    if key not in _staged:
        _staged[key] = stage(build(), label)
    return _staged[key]


def stored_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncleaned purchases as a written table, for queries that export them, some more than once."""
    return staged_once(spark, sf_dir, "raw", lambda: raw_purchases(spark, sf_dir))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned purchases as a written table: prepared once per application, then only read.

    The five-way join is the expensive part at scale, and every monitoring plan reads the table several times,
    so the rows are also laid out in date ranges, once for all of them.
    """
    return staged_once(
        spark, sf_dir, "purchases", lambda: blank_to_null(raw_purchases(spark, sf_dir, by_date=True), STRINGS))


def daily_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and distinct rows of every day as a written table, for the duplicates of weeks and of months."""
    return staged_once(
        spark, sf_dir, "daily-copies", lambda: duplicates.daily_copies(purchases(spark, sf_dir), ROLES.date, "digest"))


def purchases_sql() -> str:
    """CTEs ``raw`` and ``purchases``: the same view as SQL."""
    between = lambda span: f"(day >= DATE '{span[0]}' AND day < DATE '{span[1]}')"
    surge, outage, replayed = between(SURGE_WEEK), between(OUTAGE_WEEK), between(REPLAYED_MONTH)
    blank = lambda n: f"CASE WHEN trim({n}) <> '' THEN {n} END AS {n}"
    return f"""joined AS (
  SELECT *, CAST(l_shipdate AS DATE) AS day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
copied AS (
  SELECT *, unnest(range(CASE WHEN {surge} OR {outage} THEN 3
    WHEN {replayed} OR l_partkey % 37 = 0 THEN 2 ELSE 1 END)) AS copy FROM joined),
raw AS (
  SELECT day AS order_date,
    l_extendedprice / l_quantity * CASE WHEN {surge} OR {outage} THEN 20.0::DOUBLE ELSE 1.0::DOUBLE END AS unit_price,
    CASE WHEN l_orderkey % 11 <> 0
      THEN l_quantity * CASE WHEN {outage} THEN 20.0::DOUBLE ELSE 1.0::DOUBLE END END AS quantity,
    CASE WHEN l_partkey % 13 <> 0 AND NOT {outage} THEN n_name END AS state,
    CASE WHEN p_size % 10 = 0 THEN '  ' ELSE p_name END AS title,
    l_partkey AS product_code,
    CASE WHEN l_suppkey % 17 <> 0 AND NOT {surge} THEN p_type END AS category,
    o_custkey AS response_id
  FROM copied),
purchases AS (
  SELECT order_date, unit_price, quantity, {blank('state')}, {blank('title')}, product_code, {blank('category')},
    response_id FROM raw)"""
