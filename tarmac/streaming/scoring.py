"""Streaming scoring with a capture sink.

Requests arrive as files; each micro-batch is checked, encoded with the
train-fitted frequencies (stream–static broadcast join), scored by the
fitted trees and written — inputs and outputs together — to a capture
table, all of it. Requests that fail the checks go to a quarantine table
with the names of the checks, so every request has a row in one of the
two. The capture is partitioned by day and published batch by batch
(``sources/committed``): a batch that died half-way is not seen, and its
re-run is there once. The quarantine is written under ``batch_id=<n>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.drift import utc_day
from tarmac.operators.scoring import score
from tarmac.schema import REQUEST_COLS
from tarmac.sources.committed import publish, read_committed
from tarmac.sources.model_store import ModelBundle

CAPTURE_DAY = "capture_date"


def capture_columns(scored: DataFrame) -> DataFrame:
    return (scored.withColumn("captured_at", F.current_timestamp())
            .withColumn(CAPTURE_DAY, utc_day("captured_at")))


def read_capture(spark: SparkSession, capture_dir: str, days: list | None = None) -> DataFrame | None:
    """Captured requests of all published batches, on all or the given days."""
    return read_committed(spark, capture_dir, CAPTURE_DAY, days)


def start_scoring_stream(spark: SparkSession, requests: DataFrame, bundle: ModelBundle,
                         capture_dir: str, quarantine_dir: str, checkpoint: str,
                         id_col: str = "request_id", available_now: bool = True):
    """``requests`` is a streaming DataFrame with ``id_col`` + request columns."""
    keep = [id_col] + REQUEST_COLS

    def write(batch: DataFrame, batch_id: int) -> None:
        scored, rejected = score(batch, bundle, keep=keep)
        publish(capture_columns(scored), capture_dir, CAPTURE_DAY, batch_id)
        (rejected.select(*keep, "errors")
         .write.mode("overwrite").parquet(f"{quarantine_dir}/batch_id={batch_id}"))

    w = requests.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
