"""Batch-triggered alerting: new fingerprint files in, merged alert history out.

Fingerprints are complete weekly results, so the alert rules need no state of their own. Each run takes the
files that arrived since the last one and stops; the merge is idempotent, so a repeated micro-batch is harmless.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from pulseframe.operators.alerts import behavior_alerts
from pulseframe.rules import AlertRules
from pulseframe.sources.alert_store import update_history


def fingerprint_feed(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).json(folder)


def alert_feed(
    fingerprints: DataFrame, history_path: str, checkpoint: str, limits: AlertRules = AlertRules(),
    generated: str | None = None,
) -> StreamingQuery:
    """Start a run over the files waiting in the feed; it ends when they are processed.

    Alerts carry ``generated`` or else the time at which their micro-batch is merged.
    """
    def merge(alerts: DataFrame, epoch: int) -> None:
        moment = generated or datetime.now(timezone.utc).isoformat()
        update_history(alerts.withColumn("generated_timestamp", F.lit(moment)), history_path, limits)

    return (
        behavior_alerts(fingerprints, limits=limits)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
