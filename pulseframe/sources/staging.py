"""Tables written to the shared folder of the cluster, to cut lineage and to spare repeated work."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Every executor must see it. Only a session in local mode, where one machine is the cluster, may go without:
    it gets a fresh temporary folder.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
    return _local_roots.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used; old ones are left to the folder's retention."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet and return the written table: no lineage, column pruning and file statistics, and
    nothing to recompute when executors are lost."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
