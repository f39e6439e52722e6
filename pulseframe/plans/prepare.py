"""From the raw purchase export to the prepared Parquet table of one year."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, types as T

from pulseframe import rules
from pulseframe.operators.cleaning import (
    blank_to_null, check_figures, in_date_ranges, keep_year, summary_aggregates,
)
from pulseframe.rules import Roles
from pulseframe.sources.files import (
    PURCHASE_SCHEMA, CsvReadError, read_parquet, read_typed_csv, root_cause, write_parquet,
)
from pulseframe.sources.paths import Folder


def prepare_purchases(raw: DataFrame, year: int, date_column: str = Roles.date) -> DataFrame:
    """Blank strings to NULL, then one calendar year."""
    strings: Sequence[str] = [f.name for f in raw.schema.fields if isinstance(f.dataType, T.StringType)]
    return keep_year(blank_to_null(raw, strings), date_column, year)


def prepare_to_parquet(
    spark: SparkSession, csv_path: str, parquet_path: str, year: int, date_column: str = Roles.date, *,
    schema: T.StructType = PURCHASE_SCHEMA, multi_line: bool = True, spread: Sequence[str] = (),
) -> DataFrame:
    """Read, validate, clean, write, and return the written table.

    The file is parsed once: dates and rows are counted while the table is written under a pending name, which takes
    the place of ``parquet_path`` only if the figures are good.

    With ``spread`` the rows are laid out in date ranges (see ``in_date_ranges``); without it they keep the order
    of the source and nothing is shuffled.
    """
    raw = read_typed_csv(spark, csv_path, schema, multi_line=multi_line)
    seen = Observation()
    observed = raw.observe(seen, *summary_aggregates(raw, date_column, year))
    prepared = prepare_purchases(observed, year, date_column)
    if spread:
        prepared = in_date_ranges(prepared, date_column, spread)
    folder, _, name = parquet_path.rstrip("/").rpartition("/")
    place, pending = Folder(spark, folder), f"{name}.pending-{uuid.uuid4().hex}"
    try:
        write_parquet(prepared, f"{folder}/{pending}")
        check_figures(seen.get, date_column, f"genuine {year} purchase")
    except ValueError:
        place.delete(pending)
        raise
    except (PySparkException, Py4JJavaError) as error:
        place.delete(pending)
        raise CsvReadError(rules.CSV_UNREADABLE % root_cause(error)) from error
    # The old table makes way under another name first: killed in between, a writer leaves both to be found.
    earlier = f"{name}.replaced-{uuid.uuid4().hex}"
    replaced = name in place.names()
    if replaced:
        place.rename(name, earlier)
    place.rename(pending, name)
    if replaced:
        place.delete(earlier)
    return read_parquet(spark, parquet_path, prepared.schema)
