"""Tables that change as a whole: every version is a folder of its own, and a numbered commit record says which one counts.

A writer first writes its version, where nobody looks, and then creates the commit record that follows the one it started
from. Creating a file that exists fails, so of two writers that started from the same version one wins and the other gets
``PublishConflict``; nothing of theirs can mix. A writer that is killed at any step leaves the version before it readable. A
reader is pinned to the folder of its version and does not notice later ones; ``KEPT_VERSIONS`` of them stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pulseframe.sources.paths import Folder

KEPT_VERSIONS = 5


class PublishConflict(RuntimeError):
    """Somebody else published since the version a writer started from."""


def _records(spark: SparkSession, path: str) -> dict[int, str]:
    """Commit number to version name. A record without content was never finished and does not count."""
    folder = Folder(spark, f"{path}/commits")
    found = {int(name): folder.read(name) for name in folder.names() if name.isdigit()}
    return {number: name for number, name in found.items() if name}


def latest_version(spark: SparkSession, path: str) -> int:
    """The number of the version that counts; 0 before the first one."""
    return max(_records(spark, path), default=0)


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The table as of ``version`` (the latest if not given), or None if there is none."""
    records = _records(spark, path)
    number = max(records, default=0) if version is None else version
    return spark.read.parquet(f"{path}/versions/{records[number]}") if number in records else None


def publish(df: DataFrame, path: str, after: int | None = None, kept: int = KEPT_VERSIONS) -> DataFrame:
    """Write ``df`` as the version that follows ``after`` (the latest if not given) and return it as written.

    ``df`` may read the table itself, whose versions are not touched. Of earlier versions the last ``kept`` - 1 stay.
    """
    spark = df.sparkSession
    base = latest_version(spark, path) if after is None else after
    name = uuid.uuid4().hex
    df.write.parquet(f"{path}/versions/{name}")
    records, versions = Folder(spark, f"{path}/commits"), Folder(spark, f"{path}/versions")
    taken = [int(n) for n in records.names() if n.isdigit()]
    # An unfinished record of a killed writer holds its number for good; the next one is free.
    following = max([base, *(n for n in taken if n not in _records(spark, path))]) + 1
    if latest_version(spark, path) != base or not records.create(f"{following:012d}", name):
        versions.delete(name)
        raise PublishConflict(f"{path} has a newer version than {base}.")
    known = _records(spark, path)
    for old in sorted(known)[:-kept]:
        records.delete(f"{old:012d}")
        versions.delete(known[old])
    return spark.read.schema(df.schema).parquet(f"{path}/versions/{name}")
