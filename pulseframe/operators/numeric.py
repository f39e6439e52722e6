"""Numeric summaries, quartiles and IQR outliers of a table or of each batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pulseframe.functions import BROADCAST_BYTES, c, fits_broadcast, join_split, percent

NUMERIC_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
)

# Steps into which a bracket around a wanted rank is cut.
BUCKETS = 4096

NUMERIC_ENTRIES = "array<struct<column:string,count:bigint,mean:double,stddev:double,min:double,max:double>>"
OUTLIER_ENTRIES = (
    "array<struct<column:string,q1:double,q3:double,iqr:double,lower_bound:double,upper_bound:double,"
    "valid_count:bigint,outlier_count:bigint,outlier_percentage:double>>"
)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def _value(name: str) -> Column:
    return c(name).cast("double")


def long_values(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """The numeric columns of several tables as rows (table_name, column_name, value), so that one pass measures all of
    them. The pairs of table and column are bounded by the schemas."""
    parts = [
        tables[name].select(F.lit(name).alias("table_name"), F.inline(F.array(*[
            F.struct(F.lit(n).alias("column_name"), _value(n).alias("value")) for n in chosen
        ])))
        for name, chosen in columns.items() if chosen
    ]
    return reduce(DataFrame.unionByName, parts)


def numeric_aggregates(columns: Sequence[str], prefix: str = "num__") -> list[Column]:
    out = []
    for i, name in enumerate(columns):
        value = _value(name)
        out += [
            F.count(value).alias(f"{prefix}{i}__valid"),
            F.avg(value).alias(f"{prefix}{i}__mean"),
            F.stddev_samp(value).alias(f"{prefix}{i}__stddev"),
            F.min(value).alias(f"{prefix}{i}__min"),
            F.max(value).alias(f"{prefix}{i}__max"),
        ]
    return out


def numeric_array(
    columns: Sequence[str], denominator: str = "records", records: Column | None = None, prefix: str = "num__"
) -> Column:
    """Array of (column, count, mean, stddev, min, max). ``denominator`` decides whether ``count`` is every
    record of the batch (``"records"``) or only the non-NULL values (``"valid"``)."""
    entries = []
    for i, name in enumerate(columns):
        count = F.col(f"{prefix}{i}__valid") if denominator == "valid" else records
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                count.alias("count"),
                *[F.col(f"{prefix}{i}__{stat}").alias(stat) for stat in ("mean", "stddev", "min", "max")],
            )
        )
    return F.array(*entries).cast(NUMERIC_ENTRIES)


def numeric_stats(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), denominator: str = "records"
) -> DataFrame:
    """Long numeric summary from a single aggregation: one row per batch and column."""
    counted = df.groupBy(*[c(k) for k in by]).agg(
        F.count(F.lit(1)).alias("total_records"), *numeric_aggregates(columns)
    )
    stats = numeric_array(columns, denominator, F.col("total_records"))
    return counted.select(*[c(k) for k in by], F.inline(stats))


def _beside(
    rows: DataFrame, small: DataFrame, by: Sequence[str], counted: str, max_groups: int | None, broadcast_bytes: int
) -> DataFrame:
    """Every row with the columns of ``small``, one row per ``by`` key, beside it.

    ``max_groups`` (``CALENDAR_MONTHS`` for month batches) can prove in advance that ``small`` may be broadcast. Where it
    cannot, the join is by key with the hot keys split; ``counted`` is the column of ``small`` with the rows of its key.
    """
    if fits_broadcast(small, max_groups, broadcast_bytes):
        return rows.join(F.broadcast(small.drop(counted)), list(by))
    return join_split(rows, small, by, counted)


def _looked_up(rows: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
    """``rows`` beside their matches in ``small``, which has a few rows per column of a table and is read as a scalar."""
    found = [n for n in small.columns if n not in on]
    entries = small.agg(F.collect_list(F.struct(*small.columns))).scalar().alias("__entries")
    match = lambda e: reduce(and_, [e[n] == F.col(n) for n in on])
    own = F.filter("__entries", lambda e: match(e))
    own = F.transform(own, lambda e: F.struct(*[e[n].alias(n) for n in found]))
    return rows.select("*", entries).select(*rows.columns, F.inline(own))


def quantiles(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[float], by: Sequence[str] = (), *,
    max_groups: int | None = None, accuracy: int = 1000, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Exact order statistics by distributed selection: one row per batch with ``q__{column}_{fraction}`` (numbered as
    given, fractions rising) and ``rows``. The quantile of n values at p is the ceil(p n)-th smallest; NULLs do not count.

    No batch is sorted or gathered, whatever its size. Two passes over the rows:

    1. a quantile sketch gives a bracket of values around every wanted rank,
    2. every value falls below, into or above the brackets. Those inside, about 4/``accuracy`` of all, are folded to
       counts per value, all others to one count per stretch. The brackets are cut into ``BUCKETS`` steps, so that the
       running count over steps and stretches, a bounded number per batch and column, finds the step that holds a rank.
       Of the folded values only those of that step are put in order.

    ``accuracy`` is the width of the brackets only; the result does not depend on it. A rank outside its bracket would be
    an error of the sketch and raises one.
    """
    numbered, ranks = range(len(columns)), range(len(fractions))
    # One key column that is never NULL, so that a NULL batch is a batch in every join.
    keys = [*(["__key"] if by else []), "column"]
    # Long form: one short expression serves all columns and stays in generated code.
    long = df.select(
        *([F.struct(*[c(k) for k in by]).alias("__key")] if by else []),
        F.inline(F.array(*[F.struct(F.lit(i).alias("column"), _value(n).alias("value")) for i, n in enumerate(columns)])),
    )
    value, margin = F.col("value"), 2.0 / accuracy
    edges = F.array(*[F.lit(min(max(p + side, 0.0), 1.0)) for p in fractions for side in (-margin, margin)])
    sketches = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"), F.percentile_approx(value, edges, accuracy).alias("edges"))
    brackets = sketches.select(*keys, "__rows", *[
        F.col("edges")[2 * j + side].alias(f"{name}__{j}") for j in ranks for side, name in enumerate(("low", "high"))
    ])
    if by:
        groups = len(columns) * max_groups if max_groups else None
        beside = _beside(long, brackets, keys, "__rows", groups, broadcast_bytes)
    else:
        beside = _looked_up(long, brackets.drop("__rows"), keys)

    low, high = ([F.col(f"{name}__{j}") for j in ranks] for name in ("low", "high"))
    held = [(value >= low[j]) & (value <= high[j]) for j in ranks]
    # Stretches and steps rise with the value, also where brackets overlap. Halves keep the difference finite; what is
    # no number is step 0.
    stretch = reduce(add, [(value >= x).cast("int") for x in low] + [(value > x).cast("int") for x in high])
    share = lambda j: F.nanvl(F.try_divide(value / 2 - low[j] / 2, high[j] / 2 - low[j] / 2), F.lit(0.0))
    step = F.coalesce(reduce(lambda rest, j: F.when(held[j], share(j)).otherwise(rest), reversed(ranks), F.lit(0.0)), F.lit(0.0))
    values = (
        beside.select(
            *keys,
            F.coalesce((stretch * BUCKETS + F.least(F.floor(step * BUCKETS), F.lit(BUCKETS - 1))).cast("int"), F.lit(-1))
            .alias("bucket"),
            F.when(reduce(or_, held), value).alias("value"),
        )
        .groupBy(*keys, "bucket", "value").agg(F.count(F.lit(1)).alias("number"))
    )
    # NULLs are counted in bucket -1, which holds no rank. No branch filters by bucket, so that both read one exchange.
    steps = values.groupBy(*keys, "bucket").agg(F.sum("number").alias("number"))
    every = Window.partitionBy(*keys)
    upward = every.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    valid = F.when(F.col("bucket") >= 0, F.col("number")).otherwise(0)
    summed = steps.withColumns({
        "upto": F.sum(valid).over(upward), "valid": F.sum(valid).over(every), "rows": F.sum("number").over(every)})
    wanted = F.array(*[
        F.struct(F.lit(j).alias("cell"), F.greatest(F.ceil(F.lit(p) * F.col("valid")), F.lit(1)).alias("rank"))
        for j, p in enumerate(fractions)
    ])
    holds = (F.col("upto") - F.col("number") < F.col("rank")) & (F.col("rank") <= F.col("upto"))
    within = F.when(F.col("valid") > 0, F.col("rank") - F.col("upto") + F.col("number"))
    chosen = (
        summed.select(*keys, "bucket", "number", "upto", "valid", "rows", F.inline(wanted))
        .where(holds | (F.col("valid") == 0))  # a column of NULLs keeps its one bucket, without a rank
        .select(*keys, "bucket", "cell", "valid", "rows", within.alias("rank"))
    )
    inner = Window.partitionBy(*keys, "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = [*keys, "bucket"]
    found = (
        (values.join(chosen, places) if by else _looked_up(values, chosen, places))
        .withColumn("upto", F.sum("number").over(inner))
        .where(holds | F.col("rank").isNull())
    )
    missed = F.raise_error(F.lit("A rank lies outside the bracket of its sketch."))
    own = lambda i, j, name: F.max(F.when((F.col("column") == i) & (F.col("cell") == j), F.col(name)))
    result = found.groupBy(*keys[:-1]).agg(
        F.coalesce(F.max("rows"), F.lit(0)).alias("rows"),
        *[
            F.when((own(i, j, "valid") > 0) & own(i, j, "value").isNull(), missed).otherwise(own(i, j, "value"))
            .alias(f"q__{i}_{j}")
            for i in numbered for j in ranks
        ],
    )
    return result.select(*(["__key.*"] if by else []), "rows", *[f"q__{i}_{j}" for i in numbered for j in ranks])


def quartile_bounds(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), accuracy: int = 10000, fence: float = 1.5,
    rows: str | None = None, *, exact: bool = False, **options,
) -> DataFrame:
    """One row per batch with q1, q3 and both fences of every column (``q1__0``, ``lower__0`` ...), and with the
    number of its rows under the name ``rows`` if one is given.

    With ``exact`` the quartiles are order statistics at every size (see ``quantiles``, which takes ``options``). Without
    it they are a sketch of one pass, off by at most 1/``accuracy`` of the ranks. Either way no batch is ever gathered
    in one place.
    """
    if exact:
        found = quantiles(df, columns, (0.25, 0.75), by, **options)
        pairs = [(F.col(f"q__{i}_0"), F.col(f"q__{i}_1")) for i in range(len(columns))]
        out = [F.col("rows").alias(rows)] if rows else []
    else:
        found = df.groupBy(*[c(k) for k in by]).agg(
            *[
                F.percentile_approx(_value(n), F.array(F.lit(0.25), F.lit(0.75)), accuracy).alias(f"__quartiles{i}")
                for i, n in enumerate(columns)
            ],
            *([F.count(F.lit(1)).alias(rows)] if rows else []),
        )
        pairs = [(F.col(f"__quartiles{i}")[0], F.col(f"__quartiles{i}")[1]) for i in range(len(columns))]
        out = [F.col(rows)] if rows else []
    for i, (q1, q3) in enumerate(pairs):
        out += [
            q1.alias(f"q1__{i}"), q3.alias(f"q3__{i}"),
            (q1 - fence * (q3 - q1)).alias(f"lower__{i}"), (q3 + fence * (q3 - q1)).alias(f"upper__{i}"),
        ]
    return found.select(*[c(k) for k in by], *out)


def quartiles(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), accuracy: int = 10000, **options
) -> DataFrame:
    """Long quartile table: one row per batch and column; ``options`` as in ``quartile_bounds``."""
    entries = [
        F.struct(F.lit(n).alias("column"), F.col(f"q1__{i}").alias("q1"), F.col(f"q3__{i}").alias("q3"))
        for i, n in enumerate(columns)
    ]
    bounds = quartile_bounds(df, columns, by, accuracy, **options)
    return bounds.select(*[c(k) for k in by], F.inline(F.array(*entries)))


def outlier_summary(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    *,
    max_groups: int | None = None,
    denominator: str = "records",
    accuracy: int = 10000,
    fence: float = 1.5,
    digits: int = 4,
    broadcast_bytes: int = BROADCAST_BYTES,
    exact: bool = False,
) -> DataFrame:
    """One row per batch with an array of (column, q1, q3, iqr, lower_bound, upper_bound, valid_count,
    outlier_count, outlier_percentage). Values strictly outside a fence count.

    The quartiles are those of ``quartile_bounds``: one pass for a sketch, two with ``exact``. The last pass has every
    row beside its batch's fences (see ``_beside``); for a whole table they are one scalar row. Nothing runs before the
    result is asked for.
    """
    keys = [c(k) for k in by]
    if not columns:
        batches = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_records"))
        return batches.select(*keys, F.array().cast(OUTLIER_ENTRIES).alias("outliers"))
    options = {"exact": True, "max_groups": max_groups, "broadcast_bytes": broadcast_bytes} if exact else {}
    bounds = quartile_bounds(df, columns, by, accuracy, fence, rows="__rows" if by else None, **options)
    narrow = df.select(*keys, *[_value(n).alias(f"value__{i}") for i, n in enumerate(columns)])
    bound = {n: F.col(n) for n in bounds.columns}
    if by:
        paired = _beside(narrow, bounds, by, "__rows", max_groups, broadcast_bytes)
    else:
        fences = bounds.select(F.struct(*bounds.columns)).scalar().alias("__fences")
        paired = narrow.select("*", fences)
        bound = {n: F.col(f"__fences.{n}") for n in bounds.columns}

    aggregates = [F.count(F.lit(1)).alias("total_records")]
    for i in range(len(columns)):
        value = F.col(f"value__{i}")
        outside = (value < bound[f"lower__{i}"]) | (value > bound[f"upper__{i}"])
        aggregates += [
            F.count(value).alias(f"valid__{i}"),
            F.count_if(outside).alias(f"outliers__{i}"),
        ]
        if by:
            aggregates += [F.max(F.col(f"{b}__{i}")).alias(f"{b}__{i}") for b in ("q1", "q3", "lower", "upper")]
    counted = paired.groupBy(*keys).agg(*aggregates)
    if not by:
        counted = counted.select("*", fences).select("*", "__fences.*")

    entries = []
    for i, name in enumerate(columns):
        valid = F.coalesce(F.col(f"valid__{i}"), F.lit(0).cast("bigint"))
        outliers = F.coalesce(F.col(f"outliers__{i}"), F.lit(0).cast("bigint"))
        whole = valid if denominator == "valid" else F.coalesce(F.col("total_records"), F.lit(0).cast("bigint"))
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"q1__{i}").alias("q1"),
                F.col(f"q3__{i}").alias("q3"),
                (F.col(f"q3__{i}") - F.col(f"q1__{i}")).alias("iqr"),
                F.col(f"lower__{i}").alias("lower_bound"),
                F.col(f"upper__{i}").alias("upper_bound"),
                valid.alias("valid_count"),
                outliers.alias("outlier_count"),
                percent(outliers, whole, digits).alias("outlier_percentage"),
            )
        )
    return counted.select(*keys, F.array(*entries).cast(OUTLIER_ENTRIES).alias("outliers"))


def iqr_outliers(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), **options) -> DataFrame:
    """Long form of ``outlier_summary``: one row per batch and column."""
    return outlier_summary(df, columns, by, **options).select(*[c(k) for k in by], F.inline("outliers"))
