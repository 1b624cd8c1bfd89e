"""The edit log as a stream. Each micro-batch is one part of the log, written over if it comes again, so every edit counts once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lodestar.operators import overlay


def follow(stream: DataFrame, log: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Appends a stream of edits (``overlay.SCHEMA``) to the log under a path."""

    def keep(rows: DataFrame, epoch: int) -> None:
        rows.select("id", "seq", "action", "grafia", "graf").write.mode("overwrite").parquet(f"{log}/epoch={epoch}")

    return stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def folded(spark: SparkSession, log: str) -> DataFrame:
    """The overlay after all edits that have come so far, in order of seq whatever the order of arrival."""
    return overlay.fold(spark.read.schema(f"{overlay.SCHEMA}, epoch long").parquet(log).drop("epoch"))
