"""From a CSV that somebody sends to its health report, with every failure as a message."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from pulseframe import rules
from pulseframe.plans.dataset_report import dataset_report
from pulseframe.rules import DatasetRules
from pulseframe.sources.files import CsvReadError, read_any_csv, root_cause
from pulseframe.sources.staging import stage


def report_of_csv(
    spark: SparkSession, path: str, name: str, limits: DatasetRules = DatasetRules(), *, multi_line: bool = True
) -> tuple[DataFrame | None, str | None]:
    """The one-row report of a CSV file and no message, or no report and the reason.

    The report is worked out and written here, since a file that cannot be analysed shows that only then.
    """
    try:
        table = read_any_csv(spark, path, multi_line=multi_line)
    except CsvReadError as error:
        return None, str(error)
    try:
        return stage(dataset_report(table, name, limits), "report"), None
    except (PySparkException, Py4JJavaError) as error:
        return None, rules.CSV_NOT_ANALYSED % root_cause(error)
