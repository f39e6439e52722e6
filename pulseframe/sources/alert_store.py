"""Alert history on files: whole snapshots, and a numbered commit record for each that counts.

A merge writes its snapshot into a folder of its own and then creates the next commit number, which only one writer
can. Readers take the snapshot of the highest commit, so a snapshot without rows counts, and one that was never
committed does not. A writer that lost the race merges again into what the other one stored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pulseframe.operators.alerts import ALERT_SCHEMA, active_history, in_alert_order, merge_history
from pulseframe.rules import AlertRules
from pulseframe.sources.paths import Folder

# Snapshots that stay readable for those who started on them.
KEPT_SNAPSHOTS = 20


def _commits(spark: SparkSession, path: str) -> dict[int, str]:
    """Commit number to snapshot name. A record that is still being written counts as not there."""
    folder = Folder(spark, f"{path}/commits")
    found = {int(name): folder.read(name) for name in folder.names() if name.isdigit()}
    return {number: name for number, name in found.items() if name}


def load_history(spark: SparkSession, path: str) -> DataFrame:
    """The latest committed snapshot; an empty table before the first merge."""
    commits = _commits(spark, path)
    if not commits:
        return spark.createDataFrame([], ALERT_SCHEMA)
    return spark.read.schema(ALERT_SCHEMA).parquet(f"{path}/snapshots/{commits[max(commits)]}")


def update_history(
    new: DataFrame, path: str, limits: AlertRules = AlertRules(), kept: int = KEPT_SNAPSHOTS
) -> DataFrame:
    """Merge ``new`` into the active year's history, store the result as the latest snapshot and return it.

    Of earlier snapshots the last ``kept`` stay.
    """
    spark = new.sparkSession
    records, snapshots = Folder(spark, f"{path}/commits"), Folder(spark, f"{path}/snapshots")
    while True:
        commits = _commits(spark, path)
        taken = [int(name) for name in records.names() if name.isdigit()]
        history = load_history(spark, path)
        name = uuid.uuid4().hex
        merge_history(active_history(history, limits), new).write.parquet(f"{path}/snapshots/{name}")
        number = max(taken, default=0) + 1
        if set(taken) == set(commits) and records.create(f"{number:012d}", name):
            break
        snapshots.delete(name)
    for old in sorted(commits)[: -kept or None] if kept else sorted(commits):
        records.delete(f"{old:012d}")
        snapshots.delete(commits[old])
    return in_alert_order(spark.read.schema(ALERT_SCHEMA).parquet(f"{path}/snapshots/{name}"))
