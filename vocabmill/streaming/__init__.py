"""An append-only ledger fed by Structured Streaming (an extra: the source pipelines are batch only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "item string, batch int, status string, recorded_on string"


def append_ledger(spark: SparkSession, source: str, target: str, checkpoint: str):
    """Append each new JSON record of ``source`` to the ledger exactly once; ends when all that is there is taken."""
    rows = spark.readStream.schema(LEDGER).json(source)
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def todo(items: DataFrame, ledger: DataFrame) -> DataFrame:
    """Items whose last record is not ``done``: what failed, or was never tried, is next."""
    last = ledger.groupBy("item").agg(F.max_by("status", F.struct("recorded_on", "batch")).alias("status"))
    return items.join(last.where("status = 'done'"), "item", "left_anti")
