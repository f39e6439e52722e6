"""Queries over month batches and whole tables, each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulseframe.functions import CALENDAR_MONTHS, month_key, percent
from pulseframe.operators import cleaning, duplicates, health, missing, numeric, schema
from pulseframe.plans import batch_health as bh, dataset_report as dr, views
from pulseframe.plans.prepare import prepare_purchases
from pulseframe.rules import DatasetRules, HealthRules
from workload.tables import (
    ROLES, STRINGS, TABLES, daily_copies, purchases, purchases_sql, raw_purchases, staged_once, table,
)

COLUMNS = ["order_date", "unit_price", "quantity", "state", "title", "product_code", "category", "response_id"]
MONTH = "strftime(order_date, '%Y-%m')"
NUMERIC = ROLES.numeric
# Every numeric column of every given table.
NUMERIC_OF = {
    "benchmark": ["item_id"],
    "conversations": ["conv_id", "turn"],
    "customer": ["c_custkey", "c_nationkey", "c_acctbal"],
    "documents": ["doc_id", "n_chars"],
    "embeddings": ["vec_id", "label"],
    "events": ["event_id", "user_id", "value"],
    "labels": ["doc_id", "quality", "toxic"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax"],
    "nation": ["n_nationkey", "n_regionkey"],
    "orders": ["o_orderkey", "o_custkey", "o_totalprice"],
    "pages": ["page_id"],
    "part": ["p_partkey", "p_size", "p_retailprice"],
    "region": ["r_regionkey"],
    "supplier": ["s_suppkey", "s_nationkey", "s_acctbal"],
}


# Results that are compared with exact SQL quantiles are exact at every size.
EXACT_HEALTH = HealthRules(exact_quartiles=True)
EXACT_REPORT = DatasetRules(exact_quartiles=True)


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.with_month(purchases(spark, sf_dir), ROLES.date)


def labelled(batches: DataFrame) -> DataFrame:
    return cleaning.with_month_label(batches)


def month_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = duplicates.duplicates_of_spans(daily_copies(spark, sf_dir), month_key(F.col("day")), "batch")
    return bh.batch_health(monthly(spark, sf_dir), NUMERIC, monthly=True, limits=EXACT_HEALTH, copies=copies)


def stored_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly health as a written table, for the screens and alerts that read results and not facts."""
    return staged_once(spark, sf_dir, "monthly", lambda: month_health(spark, sf_dir))


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Sums of floating point values at the precision both engines agree on, whatever order they add in."""
    exact = {"min", "max", "q1", "q3", "iqr", "lower_bound", "upper_bound"}
    doubles = {n for n, kind in df.dtypes if kind == "double"} - exact
    return df.select(*[F.round(n, digits).alias(n) if n in doubles else F.col(n) for n in df.columns])


def long_integers(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(n).cast("bigint").alias(n) if kind == "int" else F.col(n) for n, kind in df.dtypes])


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def with_purchases(body: str, extra: str = "") -> str:
    return f"WITH {purchases_sql()}{extra} {body}"


# ---------------------------------------------------------------------------------------------- SQL fragments

def missing_sql(source: str, key: str, columns: list[str], blank: bool, digits: int) -> str:
    """Long missing table of ``source``; ``key`` is the batch expression or an empty string."""
    test = lambda n: f"{n} IS NULL OR trim(CAST({n} AS VARCHAR)) = ''" if blank else f"{n} IS NULL"
    head, group = (f"{key} AS batch, ", f"GROUP BY {key}") if key else ("", "")
    return " UNION ALL ".join(
        f"""SELECT {head}count(*) AS total_records, '{n}' AS "column",
        count(*) FILTER (WHERE {test(n)}) AS missing_count,
        round(count(*) FILTER (WHERE {test(n)}) / count(*) * 100.0::DOUBLE, {digits}) AS missing_percentage
        FROM {source} {group}"""
        for n in columns
    )


def stats_sql(source: str, key: str, columns: list[str], count: str) -> str:
    head, group = (f"{key} AS batch, ", f"GROUP BY {key}") if key else ("", "")
    return " UNION ALL ".join(
        f"""SELECT {head}'{n}' AS "column", count({'*' if count == 'records' else n}) AS "count",
        round(avg(CAST({n} AS DOUBLE)), 4) AS mean, round(stddev_samp(CAST({n} AS DOUBLE)), 4) AS stddev,
        min(CAST({n} AS DOUBLE)) AS min, max(CAST({n} AS DOUBLE)) AS max FROM {source} {group}"""
        for n in columns
    )


def fences_sql(source: str, key: str, columns: list[str]) -> str:
    """CTE body: exact quartiles, fences and counts per batch and column."""
    head, group = (f"{key} AS batch, ", f"GROUP BY {key}") if key else ("'' AS batch, ", "")
    match = f"{key} IS NOT DISTINCT FROM q.batch" if key else "TRUE"
    return " UNION ALL ".join(
        f"""SELECT q.batch, {i} AS pos, '{n}' AS "column", q.q1, q.q3, q.q3 - q.q1 AS iqr,
        q.q1 - 1.5::DOUBLE * (q.q3 - q.q1) AS lower_bound, q.q3 + 1.5::DOUBLE * (q.q3 - q.q1) AS upper_bound,
        count({n}) AS valid_count, count(*) AS records,
        count(*) FILTER (WHERE {n} < q.q1 - 1.5::DOUBLE * (q.q3 - q.q1) OR {n} > q.q3 + 1.5::DOUBLE * (q.q3 - q.q1)) AS outlier_count
        FROM {source} JOIN (SELECT {head}quantile_disc(CAST({n} AS DOUBLE), 0.25) AS q1,
          quantile_disc(CAST({n} AS DOUBLE), 0.75) AS q3 FROM {source} {group}) q ON {match}
        GROUP BY q.batch, q.q1, q.q3"""
        for i, n in enumerate(columns)
    )


def outliers_sql(source: str, key: str, columns: list[str], denominator: str) -> str:
    whole = "records" if denominator == "records" else "valid_count"
    lead = "batch, " if key else ""
    return f"""SELECT {lead}"column", q1, q3, iqr, lower_bound, upper_bound, valid_count, outlier_count,
      round(outlier_count / {whole} * 100.0::DOUBLE, 4) AS outlier_percentage
      FROM ({fences_sql(source, key, columns)})"""


def duplicates_sql(source: str, key: str, columns: list[str], digits: int) -> str:
    row = ", ".join(columns)
    head, group = (f"{key} AS batch, ", f"{key}, ") if key else ("", "")
    outer = ("batch, ", "GROUP BY batch") if key else ("", "")
    return f"""SELECT {outer[0]}CAST(sum(n) AS BIGINT) AS total_records, count(*) AS unique_records,
      CAST(sum(n) - count(*) AS BIGINT) AS duplicate_records,
      round(CAST(sum(n) - count(*) AS DOUBLE) / CAST(sum(n) AS DOUBLE) * 100.0::DOUBLE, {digits}) AS duplicate_percentage
      FROM (SELECT {head}count(*) AS n FROM {source} GROUP BY {group}{row}) {outer[1]}"""


def health_sql() -> str:
    """CTEs up to ``health``: one row per month with measures, texts, score and status."""
    miss = missing_sql("purchases", MONTH, COLUMNS, False, 4)
    order = " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(COLUMNS))
    return f""",
miss AS (SELECT *, CASE "column" {order} END AS pos FROM ({miss})),
miss_by AS (SELECT batch, any_value(total_records) AS total_records,
    CAST(sum(missing_count) AS BIGINT) AS total_missing,
    round(CAST(sum(missing_count) AS DOUBLE) / (any_value(total_records) * {len(COLUMNS)}) * 100.0::DOUBLE, 4) AS missing_percentage,
    string_agg('High missing values in ' || "column" || ': ' || printf('%.2f', round(missing_percentage, 2)) || '%', '; ' ORDER BY pos)
      FILTER (WHERE missing_percentage > 20.0) AS texts FROM miss GROUP BY batch),
dups AS ({duplicates_sql('purchases', MONTH, COLUMNS, 4)}),
outl AS (SELECT *, round(outlier_count / records * 100.0::DOUBLE, 4) AS outlier_percentage
    FROM ({fences_sql('purchases', MONTH, NUMERIC)})),
outl_by AS (SELECT batch, string_agg('High numerical outlier percentage in ' || "column" || ': '
      || printf('%.2f', round(outlier_percentage, 2)) || '%', '; ' ORDER BY pos) FILTER (WHERE outlier_percentage > 3.0) AS texts
    FROM outl GROUP BY batch),
grown AS (SELECT *, lag(total_records) OVER (ORDER BY batch) AS previous_records FROM miss_by),
measured AS (SELECT g.batch, g.total_records, g.total_missing, g.missing_percentage, d.duplicate_records,
    d.duplicate_percentage, g.previous_records,
    coalesce(round((g.total_records - g.previous_records) / g.previous_records * 100.0::DOUBLE, 4), 0.0::DOUBLE) AS growth_rate,
    g.texts AS gaps, o.texts AS spikes
    FROM grown g JOIN dups d ON g.batch = d.batch JOIN outl_by o ON g.batch = o.batch),
judged AS (SELECT *, duplicate_percentage > 3.0 AS copied,
    previous_records IS NOT NULL AND abs(growth_rate) > 50.0 AS jumped FROM measured),
scored AS (SELECT *, 100 - CASE WHEN gaps IS NOT NULL THEN 15 ELSE 0 END - CASE WHEN copied THEN 15 ELSE 0 END
    - CASE WHEN jumped THEN 20 ELSE 0 END - CASE WHEN spikes IS NOT NULL THEN 15 ELSE 0 END AS health_score,
    concat_ws('; ', gaps,
      CASE WHEN copied THEN 'High duplicate percentage: ' || printf('%.2f', round(duplicate_percentage, 2)) || '%' END,
      CASE WHEN jumped THEN 'Abnormal batch-size change: ' || printf('%.2f', round(growth_rate, 2)) || '%' END,
      spikes) AS anomalies,
    concat_ws('; ', CASE WHEN gaps IS NOT NULL THEN 'High missing values: -15' END,
      CASE WHEN copied THEN 'High duplicate percentage: -15' END,
      CASE WHEN jumped THEN 'Abnormal batch-size change: -20' END,
      CASE WHEN spikes IS NOT NULL THEN 'High numerical outliers: -15' END) AS deductions
    FROM judged),
health AS (SELECT *, CASE WHEN health_score >= 90 THEN 'Healthy' WHEN health_score >= 70 THEN 'Warning'
    ELSE 'Critical' END AS health_status FROM scored)"""


HEALTH_COLUMNS = (
    "batch, total_records, total_missing, missing_percentage, duplicate_records, duplicate_percentage, growth_rate,"
    " anomalies, deductions, CAST(health_score AS BIGINT) AS health_score, health_status"
)


def flat_health(rows: DataFrame) -> DataFrame:
    return long_integers(rows.select(
        "batch", "total_records", "total_missing", "missing_percentage", "duplicate_records", "duplicate_percentage",
        "growth_rate", F.array_join("data_quality_anomalies", "; ").alias("anomalies"),
        F.array_join("deductions", "; ").alias("deductions"), "health_score", "health_status",
    ))


# ---------------------------------------------------------------------------------------------- yearly releases

# Which columns each yearly release carries; a pair is (name, type) where the release re-typed a column.
RELEASES = {
    1995: ["order_date", "unit_price", "quantity", "state", "product_code"],
    1996: ["order_date", "unit_price", "quantity", "state", "product_code", "category"],
    1997: ["order_date", "unit_price", "quantity", "state", "product_code", "category"],
    1998: ["order_date", "unit_price", ("quantity", "int"), "state", "product_code", "category"],
    1999: ["order_date", "unit_price", ("quantity", "int"), "product_code", "category"],
    2000: ["order_date", "unit_price", "quantity", "product_code", "category", "response_id"],
    2001: ["order_date", "unit_price", "quantity", "product_code", "category", "response_id"],
}


def release_of(year: Column) -> Column:
    """The release a year belongs to: the latest one up to it, the first one before all."""
    found = F.lit(min(RELEASES))
    for release in sorted(RELEASES)[1:]:
        found = F.when(year >= release, release).otherwise(found)
    return found


def released(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with their year as ``batch``, as the year's release carries them: a column it lacks is NULL."""
    whole = purchases(spark, sf_dir)
    release = release_of(F.year(ROLES.date))
    columns = []
    for name in COLUMNS:
        value = F.col(name)
        carried, retyped = [], {}
        for year, items in RELEASES.items():
            for item in items:
                if name == (item if isinstance(item, str) else item[0]):
                    carried.append(year)
                    if not isinstance(item, str):
                        retyped.setdefault(item[1], []).append(year)
        for kind, years in retyped.items():
            cast = F.col(name).cast(kind).cast(whole.schema[name].dataType)
            value = F.when(release.isin(years), cast).otherwise(value)
        columns.append(F.when(release.isin(carried), value).alias(name))
    return whole.select(F.date_format(ROLES.date, "yyyy").alias("batch"), *columns)


def release_schemas(spark: SparkSession, sf_dir: str, years: DataFrame) -> DataFrame:
    """Schema history (batch, position, column, type) of ``years`` (batch), from the releases' columns."""
    types = dict(purchases(spark, sf_dir).dtypes)
    rows = [
        (release, position, item if isinstance(item, str) else item[0], types[item] if isinstance(item, str) else item[1])
        for release, items in RELEASES.items() for position, item in enumerate(items)
    ]
    columns = spark.createDataFrame(rows, "release int, position int, column string, type string")
    known = years.select("batch", release_of(F.col("batch").cast("int")).alias("release"))
    return known.join(columns, "release").select("batch", "position", "column", "type")


def release_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = purchases(spark, sf_dir)
    counts = whole.groupBy(F.date_format(ROLES.date, "yyyy").alias("batch")).agg(
        F.count(F.lit(1)).alias("total_records"))
    drift = schema.schema_drift(release_schemas(spark, sf_dir, counts))
    retyped = F.transform("changed_data_types", lambda x: F.concat_ws(
        " ", x["column"], x["previous_type"], x["current_type"]))
    return drift.join(counts, "batch").select(
        "batch", "total_records", "detected", "baseline", F.array_join("added_columns", ",").alias("added_columns"),
        F.array_join("removed_columns", ",").alias("removed_columns"),
        F.array_join(retyped, ",").alias("changed_data_types"),
    )


# What the release table above implies, year against year before.
RELEASE_DRIFT_SQL = """(VALUES ('1995', FALSE, TRUE, '', '', ''), ('1996', TRUE, FALSE, 'category', '', ''),
  ('1997', FALSE, FALSE, '', '', ''), ('1998', TRUE, FALSE, '', '', 'quantity double int'),
  ('1999', TRUE, FALSE, '', 'state', ''), ('2000', TRUE, FALSE, 'response_id', '', 'quantity int double'),
  ('2001', FALSE, FALSE, '', '', '')) AS drift(batch, detected, baseline, added_columns, removed_columns, changed_data_types)"""


def release_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every yearly release judged on its own against the record count and schema of the one before.

    One profile of all releases at once. A column that a release lacks is NULL there, so it is left out of the
    release's counts by its schema.
    """
    return judged_releases(spark, sf_dir, bh.profile_batches(
        released(spark, sf_dir), NUMERIC, ["batch"], denominator="valid", max_groups=CALENDAR_MONTHS,
        limits=EXACT_HEALTH))


def judged_releases(spark: SparkSession, sf_dir: str, profiled: DataFrame) -> DataFrame:
    profiled = staged_once(spark, sf_dir, "releases", lambda: profiled)
    history = release_schemas(spark, sf_dir, profiled)
    carried = history.groupBy("batch").agg(F.collect_set("column").alias("carried"))
    change = F.struct("detected", "baseline", "added_columns", "removed_columns", "changed_data_types")
    drift = schema.schema_drift(history).select("batch", change.alias("schema_drift"))
    own = lambda entries: F.filter(entries, lambda e: F.array_contains("carried", e["column"]))
    total = F.aggregate("missing", F.lit(0).cast("bigint"), lambda sum_, m: sum_ + m["missing_count"])
    records = F.col("total_records")
    rows = (
        profiled.join(carried, "batch").join(drift, "batch")
        .withColumns({n: own(n) for n in ("missing", "numeric", "outliers")})
        .withColumns({"total_columns": F.size("carried").cast("bigint"), "total_missing": total})
        .withColumn("missing_percentage", percent(F.col("total_missing"), records * F.col("total_columns"), 4))
    )
    return long_integers(health.with_batch_score(health.with_growth(rows), HealthRules()).select(
        "batch", "total_records", "total_columns", "total_missing", "missing_percentage", "duplicate_records",
        "duplicate_percentage", "growth_rate", F.array_join("data_quality_anomalies", "; ").alias("anomalies"),
        "health_score", "health_status",
    ))


def release_health_sql() -> str:
    parts = []
    positions = " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(NUMERIC))
    for year, items in RELEASES.items():
        names = [i if isinstance(i, str) else i[0] for i in items]
        key = f"'{year}'"
        picked = ", ".join(i if isinstance(i, str) else f"CAST({i[0]} AS INTEGER) AS {i[0]}" for i in items)
        source = f"(SELECT {picked} FROM purchases WHERE year(order_date) = {year})"
        missing_terms = " + ".join(f"count(*) FILTER (WHERE {n} IS NULL)" for n in names)
        gap_terms = ", ".join(
            f"CASE WHEN round(count(*) FILTER (WHERE {n} IS NULL) / count(*) * 100.0::DOUBLE, 4) > 20.0 THEN"
            f" 'High missing values in {n}: ' || printf('%.2f', round(round(count(*) FILTER (WHERE {n} IS NULL)"
            f" / count(*) * 100.0::DOUBLE, 4), 2)) || '%' END" for n in names)
        parts.append(f"""SELECT {key} AS batch, m.*, d.duplicate_records, d.duplicate_percentage,
          o.spikes FROM
          (SELECT count(*) AS total_records, {len(names)} AS total_columns, {missing_terms} AS total_missing,
            nullif(concat_ws('; ', {gap_terms}), '') AS gaps FROM {source} s) m,
          ({duplicates_sql(source, '', names, 4)}) d,
          (SELECT string_agg('High numerical outlier percentage in ' || "column" || ': '
              || printf('%.2f', round(outlier_percentage, 2)) || '%', '; ' ORDER BY position)
              FILTER (WHERE outlier_percentage > 3.0) AS spikes
            FROM (SELECT *, CASE "column" {positions} END AS position FROM ({outliers_sql(source, '', NUMERIC, 'valid')}))) o""")
    return with_purchases(f"""SELECT batch, total_records, CAST(total_columns AS BIGINT) AS total_columns, total_missing,
        round(total_missing / (total_records * total_columns) * 100.0::DOUBLE, 4) AS missing_percentage,
        duplicate_records, duplicate_percentage, growth_rate,
        concat_ws('; ', gaps,
          CASE WHEN duplicate_percentage > 3.0 THEN 'High duplicate percentage: ' || printf('%.2f', round(duplicate_percentage, 2)) || '%' END,
          CASE WHEN previous_records > 0 AND abs(growth_rate) > 50.0 THEN 'Abnormal batch-size change: ' || printf('%.2f', round(growth_rate, 2)) || '%' END,
          spikes,
          CASE WHEN detected THEN 'Schema drift detected.' END) AS anomalies,
        CAST(score AS BIGINT) AS health_score,
        CASE WHEN score >= 90 THEN 'Healthy' WHEN score >= 70 THEN 'Warning' ELSE 'Critical' END AS health_status
      FROM (SELECT *, 100 - CASE WHEN gaps IS NOT NULL THEN 15 ELSE 0 END
          - CASE WHEN duplicate_percentage > 3.0 THEN 15 ELSE 0 END
          - CASE WHEN previous_records > 0 AND abs(growth_rate) > 50.0 THEN 20 ELSE 0 END
          - CASE WHEN spikes IS NOT NULL THEN 15 ELSE 0 END - CASE WHEN detected THEN 25 ELSE 0 END AS score
        FROM (SELECT *, coalesce(round((total_records - previous_records) / previous_records * 100.0::DOUBLE, 4), 0.0::DOUBLE) AS growth_rate
          FROM (SELECT r.*, drift.detected, lag(total_records) OVER (ORDER BY r.batch) AS previous_records
            FROM ({' UNION ALL '.join(parts)}) r JOIN {RELEASE_DRIFT_SQL} ON r.batch = drift.batch)))""")


# ---------------------------------------------------------------------------------------------- the registry

def _numeric_tables(spark, sf_dir):
    return {n: table(spark, sf_dir, n) for n in NUMERIC_OF}


def _dataset_quartiles(spark, sf_dir):
    every = numeric.long_values(_numeric_tables(spark, sf_dir), NUMERIC_OF)
    found = numeric.quantiles(
        every, ["value"], (0.25, 0.75), ["table_name", "column_name"], max_groups=sum(map(len, NUMERIC_OF.values())))
    return rounded(found.selectExpr("table_name", "column_name AS column", "q__0_0 AS q1", "q__0_1 AS q3"))


def _dataset_outliers(spark, sf_dir):
    return dr.datasets_outliers(_numeric_tables(spark, sf_dir), NUMERIC_OF, EXACT_REPORT)


def _dataset_outliers_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, "column", round(q1, 4) AS q1, round(q3, 4) AS q3,
        round(lower_bound, 4) AS lower_bound, round(upper_bound, 4) AS upper_bound, valid_count, outlier_count,
        round(outlier_count / valid_count * 100.0::DOUBLE, 2) AS outlier_percentage
        FROM ({fences_sql(n, '', cols)}) WHERE valid_count >= 4 AND iqr > 0""" for n, cols in NUMERIC_OF.items())


def _duplicates_of_tables(spark, sf_dir):
    """Whole rows of the purchase table and of the documents without their id, with long texts by digest."""
    docs = table(spark, sf_dir, "documents").drop("doc_id")
    talks = table(spark, sf_dir, "conversations").drop("conv_id", "turn")
    sources = {"purchases": purchases(spark, sf_dir), "documents": docs, "conversations": talks}
    return union_all([
        duplicates.duplicate_rows(df, identity="digest", digits=2).withColumn("table_name", F.lit(n))
        for n, df in sources.items()
    ])


def _type_outliers(spark, sf_dir):
    """Event values per event type. Nothing bounds the number of types, so the fences are counted before use."""
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "batch")
    return rounded(numeric.iqr_outliers(events, ["value"], ["batch"], exact=True, denominator="valid"))


def _numeric_of_lineitem(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    return rounded(numeric.numeric_stats(line, numeric.numeric_columns(line), denominator="valid"))


def _daily_health(spark, sf_dir):
    """Orders by day: a DATE key that is not a month, so its days stay days, and no bound on their number."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"), "o_custkey", "o_totalprice", "o_orderpriority")
    rows = bh.batch_health(orders, ["o_totalprice"], "day", limits=EXACT_HEALTH)
    return long_integers(rows.select(
        "day", "total_records", "total_missing", "duplicate_records", "growth_rate", "health_score", "health_status",
        F.array_join("data_quality_anomalies", "; ").alias("anomalies"),
    ))


DAILY_SQL = """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, o_custkey, o_totalprice, o_orderpriority FROM orders),
counts AS (SELECT day, CAST(sum(n) AS BIGINT) AS total_records, CAST(sum(n) - count(*) AS BIGINT) AS duplicate_records
  FROM (SELECT day, count(*) AS n FROM o GROUP BY day, o_custkey, o_totalprice, o_orderpriority) GROUP BY day),
q AS (SELECT day, quantile_disc(o_totalprice, 0.25) AS q1, quantile_disc(o_totalprice, 0.75) AS q3 FROM o GROUP BY day),
out_ AS (SELECT day, round(count(*) FILTER (o_totalprice < q1 - 1.5::DOUBLE * (q3 - q1) OR o_totalprice > q3 + 1.5::DOUBLE * (q3 - q1))
  / count(*) * 100.0::DOUBLE, 4) AS pct FROM o JOIN q USING (day) GROUP BY day),
gaps AS (SELECT day, CAST(sum((o_custkey IS NULL)::INT + (o_totalprice IS NULL)::INT + (o_orderpriority IS NULL)::INT) AS BIGINT) AS total_missing
  FROM o GROUP BY day),
j AS (SELECT *, round(duplicate_records / total_records * 100.0::DOUBLE, 4) AS dup,
    lag(total_records) OVER (ORDER BY day) AS previous FROM counts JOIN out_ USING (day) JOIN gaps USING (day)),
g AS (SELECT *, coalesce(round((total_records - previous) / previous * 100.0::DOUBLE, 4), 0.0::DOUBLE) AS growth_rate FROM j),
s AS (SELECT *, 100 - CASE WHEN dup > 3.0 THEN 15 ELSE 0 END - CASE WHEN abs(growth_rate) > 50.0 THEN 20 ELSE 0 END
  - CASE WHEN pct > 3.0 THEN 15 ELSE 0 END AS score FROM g)
SELECT day, total_records, total_missing, duplicate_records, growth_rate, CAST(score AS BIGINT) AS health_score,
  CASE WHEN score >= 90 THEN 'Healthy' WHEN score >= 70 THEN 'Warning' ELSE 'Critical' END AS health_status,
  concat_ws('; ', CASE WHEN dup > 3.0 THEN 'High duplicate percentage: ' || printf('%.2f', round(dup, 2)) || '%' END,
    CASE WHEN abs(growth_rate) > 50.0 THEN 'Abnormal batch-size change: ' || printf('%.2f', round(growth_rate, 2)) || '%' END,
    CASE WHEN pct > 3.0 THEN 'High numerical outlier percentage in o_totalprice: ' || printf('%.2f', round(pct, 2)) || '%' END) AS anomalies
FROM s"""
CHOSEN_MONTH = "1998-09"
LINE_NUMERIC = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]
REPORTED = {
    "customer": (["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
                 ["c_custkey", "c_nationkey", "c_acctbal"], ["c_name", "c_mktsegment"], None),
    "part": (["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
             ["p_partkey", "p_size", "p_retailprice"], ["p_name", "p_brand", "p_type"], None),
    "documents": (["doc_id", "text", "lang", "source", "n_chars"], ["doc_id", "n_chars"],
                  ["text", "lang", "source"], None),
    "events": (["event_id", "ts", "user_id", "event_type", "value", "props"], ["event_id", "user_id", "value"],
               ["event_type", "props"], "ts"),
}


def reports(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [dr.dataset_report(table(spark, sf_dir, n), f"{n}.parquet", EXACT_REPORT) for n in REPORTED]


def flat_report(report: DataFrame) -> DataFrame:
    return report.select(
        "file_name", "row_count", "column_count", "total_missing_values", "overall_missing_percentage",
        "duplicate_row_count", "duplicate_percentage", "overall_outlier_percentage",
        F.array_join("detected_issues", "; ").alias("detected_issues"), "data_health_score", "health_status",
        "date_detection_message", "has_valid_rows", "has_readable_columns",
        F.array_join(F.transform("outlier_analysis", lambda o: o["column"]), ",").alias("analysed_columns"),
    )


def _report(spark, sf_dir):
    return long_integers(union_all([flat_report(r) for r in reports(spark, sf_dir)]))


def report_rows_sql() -> str:
    """CTE body with one row per reported table."""
    parts = []
    for name, (columns, nums, strings, day) in REPORTED.items():
        gaps = " + ".join(
            f"count(*) FILTER (WHERE {n} IS NULL{f' OR trim({n}) = {chr(39) * 2}' if n in strings else ''})"
            for n in columns)
        message = (
            "'Time-based data detected. Historical behavioral drift analysis may be possible for this dataset."
            f" Candidate date/time column: {day}.'" if day else "CAST(NULL AS VARCHAR)")
        parts.append(f"""SELECT '{name}.parquet' AS file_name, m.n AS row_count, {len(columns)} AS column_count,
          m.gaps AS total_missing_values, round(m.gaps / (m.n * {len(columns)}) * 100.0::DOUBLE, 2) AS overall_missing_percentage,
          d.duplicate_records AS duplicate_row_count, d.duplicate_percentage,
          coalesce(round(o.outliers / o.valid * 100.0::DOUBLE, 2), 0.0::DOUBLE) AS overall_outlier_percentage,
          coalesce(o.analysed, '') AS analysed_columns, {message} AS date_detection_message
          FROM (SELECT count(*) AS n, {gaps} AS gaps FROM {name}) m,
            ({duplicates_sql(name, '', columns, 2)}) d,
            (SELECT CAST(sum(outlier_count) AS DOUBLE) AS outliers, CAST(sum(valid_count) AS DOUBLE) AS valid,
               string_agg("column", ',' ORDER BY pos) AS analysed
             FROM ({fences_sql(name, '', nums)}) WHERE valid_count >= 4 AND iqr > 0) o""")
    issue = lambda value, limit, text: (
        f"CASE WHEN {value} > {limit} THEN '{text}: ' || printf('%.1f', round({value}, 1)) || '%' END")
    tier = lambda v, a, b, c, p, q, r: (
        f"CASE WHEN {v} <= {a} THEN 0 WHEN {v} <= {b} THEN {p} WHEN {v} <= {c} THEN {q} ELSE {r} END")
    m, d, o = "overall_missing_percentage", "duplicate_percentage", "overall_outlier_percentage"
    return f"""SELECT *, CASE WHEN data_health_score >= 80 THEN 'HEALTHY' WHEN data_health_score >= 50 THEN 'WARNING'
        ELSE 'CRITICAL' END AS health_status FROM (
      SELECT file_name, row_count, CAST(column_count AS BIGINT) AS column_count, total_missing_values, {m},
        duplicate_row_count, {d}, {o}, analysed_columns, date_detection_message, TRUE AS has_valid_rows,
        TRUE AS has_readable_columns,
        CAST(100 - {tier(m, 1, 5, 15, 10, 20, 30)} - {tier(d, 1, 5, 15, 10, 20, 30)} - {tier(o, 2, 5, 10, 5, 10, 20)} AS BIGINT) AS data_health_score,
        coalesce(nullif(concat_ws('; ', {issue(m, 1, 'High missing-value rate detected')},
          {issue(d, 1, 'Duplicate rows detected')}, {issue(o, 2, 'Outliers detected across numeric fields')}), ''),
          'No major data-health issues detected.') AS detected_issues
      FROM ({' UNION ALL '.join(parts)}))"""


def _overview_of_lineitem(spark, sf_dir):
    """Schema rows beside what each column holds."""
    line = table(spark, sf_dir, "lineitem")
    filled = missing.column_missing(line, blank_is_missing=True, digits=2).withColumnRenamed("column", "column_name")
    return long_integers(schema.schema_overview(line).join(filled, "column_name"))


LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
DATE_COLUMNS = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


def _date_columns(spark, sf_dir):
    rows = []
    for name in TABLES:
        df = table(spark, sf_dir, name)
        found = schema.date_column(df)
        span = [F.col(found), F.col(found)] if found else [F.lit(None)] * 2
        rows.append(df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(span[0].cast("date")).alias("earliest"), F.max(span[1].cast("date")).alias("latest"),
        ).select(
            F.lit(name).alias("table_name"), F.lit(found).cast("string").alias("date_column"),
            dr.date_message(df).alias("message"), "row_count", "earliest", "latest",
        ))
    return union_all(rows)


def _date_columns_sql() -> str:
    def one(name: str) -> str:
        found = DATE_COLUMNS.get(name)
        if not found:
            return (f"SELECT '{name}' AS table_name, CAST(NULL AS VARCHAR) AS date_column, CAST(NULL AS VARCHAR) AS message,"
                    f" count(*) AS row_count, CAST(NULL AS DATE) AS earliest, CAST(NULL AS DATE) AS latest FROM {name}")
        return (f"SELECT '{name}' AS table_name, '{found}' AS date_column, 'Time-based data detected. Historical behavioral"
                f" drift analysis may be possible for this dataset. Candidate date/time column: {found}.' AS message,"
                f" count(*) AS row_count, CAST(min({found}) AS DATE) AS earliest, CAST(max({found}) AS DATE) AS latest FROM {name}")
    return " UNION ALL ".join(one(n) for n in TABLES)


def order_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth from order to order: as many batches as there are orders, so they are put in order in ranges."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("batch")).agg(
        F.count(F.lit(1)).alias("total_records"))
    return health.with_growth_in_ranges(lines)


ORDER_GROWTH_SQL = """WITH g AS (SELECT l_orderkey AS batch, count(*) AS total_records FROM lineitem GROUP BY 1),
  p AS (SELECT *, lag(total_records) OVER (ORDER BY batch) AS previous_records FROM g)
SELECT *, coalesce(round((total_records - previous_records) / previous_records * 100.0::DOUBLE, 4), 0.0::DOUBLE) AS growth_rate
FROM p"""


def queries() -> dict:
    out = {
        "order_growth": order_growth,
        "prepare_clean": lambda s, d: cleaning.keep_year(
            cleaning.blank_to_null(raw_purchases(s, d), STRINGS), ROLES.date, 1998),
        "batch_missing": lambda s, d: labelled(missing.column_missing(monthly(s, d), ["batch"])),
        "batch_missing_total": lambda s, d: long_integers(
            labelled(missing.missing_summary(monthly(s, d), ["batch"]).drop("missing"))),
        "dataset_missing_blank": lambda s, d: missing.column_missing(
            raw_purchases(s, d), blank_is_missing=True, digits=2),
        "batch_duplicates": lambda s, d: labelled(duplicates.duplicate_rows(monthly(s, d), ["batch"])),
        "batch_duplicates_digest": lambda s, d: labelled(duplicates.duplicate_rows(
            monthly(s, d), ["batch"], identity="digest")),
        "dataset_duplicates": _duplicates_of_tables,
        "batch_numeric_stats": lambda s, d: rounded(labelled(
            numeric.numeric_stats(monthly(s, d), NUMERIC, ["batch"]))),
        "batch_numeric_stats_nonnull": lambda s, d: rounded(labelled(
            numeric.numeric_stats(monthly(s, d), NUMERIC, ["batch"], "valid"))),
        "dataset_numeric_summary": _numeric_of_lineitem,
        "batch_quartiles": lambda s, d: rounded(labelled(
            numeric.quartiles(
                monthly(s, d), NUMERIC, ["batch"], exact=True, max_groups=CALENDAR_MONTHS))),
        "dataset_quartiles": _dataset_quartiles,
        "batch_iqr_outliers": lambda s, d: rounded(labelled(numeric.iqr_outliers(
            monthly(s, d), NUMERIC, ["batch"], exact=True, max_groups=CALENDAR_MONTHS))),
        "batch_iqr_outliers_valid": lambda s, d: rounded(labelled(numeric.iqr_outliers(
            monthly(s, d), NUMERIC, ["batch"], exact=True, max_groups=CALENDAR_MONTHS, denominator="valid"))),
        "batch_iqr_outliers_salted": lambda s, d: rounded(labelled(numeric.iqr_outliers(
            monthly(s, d), NUMERIC, ["batch"], exact=True, broadcast_bytes=0))),
        "event_type_outliers": _type_outliers,
        "dataset_iqr_outliers": _dataset_outliers,
        "batch_growth": lambda s, d: health.with_growth(labelled(
            monthly(s, d).groupBy("batch").agg(F.count(F.lit(1)).alias("total_records")))),
        "schema_drift": release_schema_drift,
        "release_health": release_health,
        "batch_health": lambda s, d: flat_health(month_health(s, d)),
        "dataset_report": _report,
        "schema_overview": _overview_of_lineitem,
        "date_column": _date_columns,
        "daily_health": _daily_health,
        "monthly_trend": lambda s, d: long_integers(views.monthly_trend(stored_months(s, d))),
        "month_missing": lambda s, d: views.month_missing(stored_months(s, d)),
        "month_numeric": lambda s, d: rounded(views.month_numeric(stored_months(s, d))),
        "month_iqr": lambda s, d: rounded(views.month_outliers(stored_months(s, d))),
        "latest_month_missing": lambda s, d: views.month_missing(stored_months(s, d), views.LATEST),
        "latest_month_numeric": lambda s, d: rounded(views.month_numeric(stored_months(s, d), views.LATEST)),
        "chosen_month_iqr": lambda s, d: rounded(views.month_outliers(stored_months(s, d), CHOSEN_MONTH)),
    }
    return out


def oracle_sql() -> dict[str, str]:
    iqr = lambda denominator: with_purchases(outliers_sql("purchases", MONTH, NUMERIC, denominator))
    health = lambda body: with_purchases(body, health_sql())
    docs = "(SELECT text, lang, source, n_chars FROM documents)"
    overview = ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(LINE_TYPES.items()))
    return {
        "order_growth": ORDER_GROWTH_SQL,
        "prepare_clean": with_purchases("SELECT * FROM purchases WHERE year(order_date) = 1998"),
        "batch_missing": with_purchases(missing_sql("purchases", MONTH, COLUMNS, False, 4)),
        "batch_missing_total": with_purchases(
            f"SELECT batch, total_records, CAST({len(COLUMNS)} AS BIGINT) AS total_columns, total_missing,"
            " missing_percentage FROM miss_by", health_sql()),
        "dataset_missing_blank": with_purchases(missing_sql("raw", "", COLUMNS, True, 2)),
        "batch_duplicates": with_purchases(duplicates_sql("purchases", MONTH, COLUMNS, 4)),
        "batch_duplicates_digest": with_purchases(duplicates_sql("purchases", MONTH, COLUMNS, 4)),
        "dataset_duplicates": with_purchases(" UNION ALL ".join(
            f"SELECT '{n}' AS table_name, * FROM ({duplicates_sql(source, '', cols, 2)})" for n, source, cols in (
                ("purchases", "purchases", COLUMNS), ("documents", docs, ["text", "lang", "source", "n_chars"]),
                ("conversations", "conversations", ["role", "text"])))),
        "batch_numeric_stats": with_purchases(stats_sql("purchases", MONTH, NUMERIC, "records")),
        "batch_numeric_stats_nonnull": with_purchases(stats_sql("purchases", MONTH, NUMERIC, "valid")),
        "dataset_numeric_summary": stats_sql("lineitem", "", LINE_NUMERIC, "valid"),
        "batch_quartiles": with_purchases(
            f'SELECT batch, "column", q1, q3 FROM ({fences_sql("purchases", MONTH, NUMERIC)})'),
        "dataset_quartiles": " UNION ALL ".join(
            f"""SELECT '{n}' AS table_name, "column", q1, q3
            FROM ({fences_sql(n, '', cols)})""" for n, cols in NUMERIC_OF.items()),
        "batch_iqr_outliers": iqr("records"),
        "batch_iqr_outliers_valid": iqr("valid"),
        "batch_iqr_outliers_salted": iqr("records"),
        "event_type_outliers": outliers_sql("events", "event_type", ["value"], "valid"),
        "dataset_iqr_outliers": _dataset_outliers_sql(),
        "batch_growth": with_purchases(
            f"""SELECT batch, total_records, lag(total_records) OVER (ORDER BY batch) AS previous_records,
            coalesce(round((total_records - lag(total_records) OVER (ORDER BY batch))
              / lag(total_records) OVER (ORDER BY batch) * 100.0::DOUBLE, 4), 0.0::DOUBLE) AS growth_rate
            FROM (SELECT {MONTH} AS batch, count(*) AS total_records FROM purchases GROUP BY 1)"""),
        "schema_drift": with_purchases(
            f"""SELECT drift.*, n.total_records FROM {RELEASE_DRIFT_SQL} JOIN
            (SELECT strftime(order_date, '%Y') AS batch, count(*) AS total_records FROM purchases GROUP BY 1) n
            ON drift.batch = n.batch"""),
        "release_health": release_health_sql(),
        "batch_health": health(f"SELECT {HEALTH_COLUMNS} FROM health"),
        "dataset_report": report_rows_sql(),
        "schema_overview": f"""SELECT CAST(t.p AS BIGINT) AS position, t.column_name, t.data_type, m.total_records,
            m.missing_count, m.missing_percentage FROM (VALUES {overview}) AS t(p, column_name, data_type)
            JOIN ({missing_sql("lineitem", "", list(LINE_TYPES), True, 2)}) m ON m."column" = t.column_name""",
        "date_column": _date_columns_sql(),
        "monthly_trend": health(
            "SELECT batch AS month, CAST(health_score AS BIGINT) AS health_score, total_records FROM health"),
        "month_missing": health(
            'SELECT batch AS month, "column", missing_count, missing_percentage FROM miss'),
        "month_numeric": with_purchases(
            f"SELECT batch AS month, * EXCLUDE (batch) FROM ({stats_sql('purchases', MONTH, NUMERIC, 'records')})"),
        "daily_health": DAILY_SQL,
        "latest_month_missing": health(
            """SELECT batch AS month, "column", missing_count, missing_percentage FROM miss
            WHERE batch = (SELECT max(batch) FROM miss)"""),
        "latest_month_numeric": with_purchases(
            f"""SELECT batch AS month, * EXCLUDE (batch) FROM ({stats_sql('purchases', MONTH, NUMERIC, 'records')})
            WHERE batch = (SELECT max({MONTH}) FROM purchases)"""),
        "chosen_month_iqr": health(
            f"""SELECT batch AS month, 'No schema drift detected.' AS schema_message, "column", q1, q3,
            outlier_percentage FROM outl WHERE batch = '{CHOSEN_MONTH}'"""),
        "month_iqr": health(
            """SELECT batch AS month, 'No schema drift detected.' AS schema_message, "column", q1, q3,
            outlier_percentage FROM outl"""),
    }
