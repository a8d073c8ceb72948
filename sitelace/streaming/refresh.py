"""Batch stages over arriving files and paged services, by `foreachBatch` (an addition; the batch stages themselves have no event time)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def _into(stage: Callable[[DataFrame], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, number: int) -> None:
        stage(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def refresh(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Every micro-batch goes through a stage and becomes a folder of its own, so a repeated batch replaces itself."""
    return stream.writeStream.foreachBatch(_into(stage, path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drain(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> None:
    """The same for sources that bound their own batches: batch after batch until nothing is new, then it ends.  After a
    failure the next call goes on from the checkpoint."""
    query = stream.writeStream.foreachBatch(_into(stage, path)).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
