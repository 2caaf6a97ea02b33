"""Streaming daily statistics of captured traffic.

Each micro-batch writes additive partial statistics per (day, feature) under
its own ``batch_id`` (a re-run batch overwrites its own rows), and the
statistics are merged when they are read. There is no window state and no
watermark, so a row counts for its day however late it comes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.operators.drift import long_capture, merged_stats, partial_stats


def start_daily_stats_stream(spark: SparkSession, capture: DataFrame, features: list[str],
                             out_dir: str, checkpoint: str, available_now: bool = True):
    """``capture`` is a streaming frame with ``captured_at`` and struct(value, text) features."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (partial_stats(long_capture(batch, features))
         .write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}"))

    w = capture.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 minutes")
    return w.start()


def read_daily_stats(spark: SparkSession, out_dir: str) -> DataFrame:
    """(day, feature, n, nulls, type_errors, mean, std, min, max) over all batches so far."""
    return merged_stats(spark.read.parquet(out_dir))
