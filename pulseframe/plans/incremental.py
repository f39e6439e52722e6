"""Results per batch that follow their facts: only batches whose files changed are computed again.

The facts are a Parquet table in one folder per batch (``batch_folders``). A ledger beside the results remembers the files
of every batch, their sizes and times. A refresh lists the files, computes the batches that are new or differ, drops those
that are gone, keeps the stored rows of all others, and publishes rows and ledger together as one version.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseframe.functions import c
from pulseframe.operators.cleaning import in_date_ranges
from pulseframe.sources.paths import Folder
from pulseframe.sources.published import latest_version, publish, read_published

LEDGER = "__files"


def batch_folders(rows: DataFrame, path: str, key: str, date: str | None = None, spread: Sequence[str] = ()) -> None:
    """Write ``rows`` into one folder per value of ``key``; folders of values that occur are replaced, others stay.

    With ``date`` the rows are first laid out in date ranges, so that a task writes few folders and a hot one is split.
    Rows without a key belong to no batch and are dropped. Keys are dates, numbers or plain words, as they name folders.
    """
    known = rows.where(c(key).isNotNull())
    laid = in_date_ranges(known, date, spread) if date else known
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def files_by_batch(spark: SparkSession, path: str, key: str) -> dict[str, str]:
    """A digest of the data files of every batch: their names, sizes and times. Nothing is read."""
    found = defaultdict(list)
    for name, size, time in Folder(spark, path).files():
        folder = next((part for part in name.split("/") if part.startswith(f"{key}=")), None)
        if folder and not name.rpartition("/")[2].startswith(("_", ".")):
            found[folder.partition("=")[2]].append(f"{name}:{size}:{time}")
    return {batch: hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest() for batch, files in found.items()}


def refresh(
    spark: SparkSession, facts: str, store: str, key: str, compute: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The results of ``compute`` for all batches of ``facts``, up to date and published at ``store``.

    ``compute`` maps fact rows to result rows of their own batch with ``key`` among the columns, and must not look
    across batches. Batches it gives no row for are computed again every time. An unchanged table is neither read nor
    published again.
    """
    version = latest_version(spark, store)
    stored = read_published(spark, store, version)
    now = files_by_batch(spark, facts, key)
    before = {}
    if stored is not None:  # one entry per batch, as many as the listing has folders
        before = {r["batch"]: r["files"] for r in stored.select(F.col(f"{LEDGER}.*")).distinct().collect()}
    changed = sorted(b for b, files in now.items() if before.get(b) != files)
    if stored is not None and not changed and before.keys() <= now.keys():
        return stored.drop(LEDGER)
    parts = []
    if stored is not None:
        same = [b for b in before if now.get(b) == before[b]]
        parts.append(stored.where(F.col(f"{LEDGER}.batch").isin(same)))
    if changed or stored is None:
        rows = spark.read.option("basePath", facts).parquet(*[f"{facts}/{key}={b}" for b in changed or now])
        results = compute(rows)
        batch = c(key).cast("string")
        known = F.create_map(*[F.lit(x) for b in changed for x in (b, now[b])])
        parts.append(results.withColumn(LEDGER, F.struct(batch.alias("batch"), F.try_element_at(known, batch).alias("files"))))
    whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return publish(whole, store, after=version).drop(LEDGER)
