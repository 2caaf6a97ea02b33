"""Landing-folder stream: new ``*.csv`` files → typed, labelled rows + quarantine + reports.

Files are streamed as text lines and read by their own headers
(``rows_by_header``), picked up once each (file-source log in the
checkpoint), at most ``max_files_per_trigger`` files per micro-batch so a
backlog is worked off in bounded batches (``availableNow`` honours the
cap). A file without a required column is listed in ``rejected_files``; the
others go on. ``foreachBatch`` writes every output under ``batch_id=<n>``,
so a batch that is re-run after a failure overwrites its own output —
exactly-once per file. The labelled rows are those that the batch path
keeps: the request rules belong to scoring and drop nothing here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import quality as qx
from tarmac.operators.featurize import create_target
from tarmac.operators.routing import LANDING_PREFIX
from tarmac.session import scratch_path
from tarmac.sources.csv_landing import rows_by_header, type_rows


def process_landed(lines: DataFrame, batch_id: int, out_dir: str,
                   id_col: str | None = "flight_id") -> None:
    """Lines of files under the landing prefix are processed; others are skipped (counted)."""
    def write(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{out_dir}/{name}/batch_id={batch_id}")

    inside = under_landing_prefix()
    write(lines.where(~inside).groupBy("source_file").agg((F.count(F.lit(1)) - 1).alias("count")), "skipped")
    rows, rejected = rows_by_header(lines.where(inside), [id_col] if id_col else None)
    write(rejected, "rejected_files")
    typed = type_rows(rows, ([id_col] if id_col else []) + ["source_file"])
    if id_col:
        typed = typed.withColumn(id_col, F.col(id_col).try_cast("long"))
    # three outputs read the typed rows: parsed once, written to the shared folder
    path = scratch_path(lines.sparkSession, "landed")
    typed.write.parquet(path)
    typed = lines.sparkSession.read.schema(typed.schema).parquet(path)
    write(qx.quality_report(typed, include_duplicates=False), "reports")
    usable, unusable = qx.split_unusable(typed)
    write(unusable, "quarantine")
    write(create_target(usable).drop("_type_errors"), "labelled")


def start_landing_stream(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str,
                         id_col: str | None = "flight_id", available_now: bool = True,
                         max_files_per_trigger: int = 1000):
    """Start the landing stream; returns the ``StreamingQuery``."""
    lines = (spark.readStream.option("pathGlobFilter", "*.csv")
             .option("maxFilesPerTrigger", max_files_per_trigger)
             .option("recursiveFileLookup", True).text(landing_dir))
    # places of lines are counted per batch, where the files of a batch are read
    src = lines.select("value", F.col("_metadata.file_path").alias("source_file"),
                       F.col("_metadata.file_block_start").alias("_block"))
    w = (src.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda b, i: process_landed(
             b.withColumn("_line", F.monotonically_increasing_id()), i, out_dir, id_col)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def under_landing_prefix(path_col: str = "source_file") -> F.Column:
    return F.col(path_col).contains(f"/{LANDING_PREFIX}")
