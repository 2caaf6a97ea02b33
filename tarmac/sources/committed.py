"""Tables partitioned by day whose batches become visible as a whole.

A batch may span several day partitions. Its files are written first, under the day and
an attempt of their own::

    <root>/data/<day column>=2024-01-05/attempt=<batch>-<random>/part-...
    <root>/commits/part-...           one file a batch: (batch, attempt, day, rows, sources)

and it counts once its commit file is there, which names the attempt and its days. Readers
join the commits, so files of an attempt that died are never read, and a batch that is run
again is published once. Filters on the day prune partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT = T.StructType([
    T.StructField("batch", T.StringType()), T.StructField("attempt", T.StringType()),
    T.StructField("day", T.DateType()), T.StructField("rows", T.LongType()),
    T.StructField("sources", T.ArrayType(T.StringType()))])

EVERY_COMMIT = 1_000_000      # commit rows that are broadcast; beyond, the join is shuffled


def commits(spark: SparkSession, root: str) -> DataFrame:
    """(batch, attempt, day, rows, sources): a row for each day of each published batch."""
    try:
        return spark.read.schema(COMMIT).parquet(f"{root}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def publish(df: DataFrame, root: str, day: str, batch: str | int, sources: Iterable[str] = ()) -> bool:
    """Write the rows of ``df`` under their days and commit them as ``batch``; False (and nothing is
    visible) if that batch was published before. ``sources`` is kept with the commit."""
    spark = df.sparkSession
    batch = str(batch)
    if not commits(spark, root).where(F.col("batch") == batch).isEmpty():
        return False
    attempt = f"{batch}-{uuid.uuid4().hex}"
    (df.hint("rebalance", day).withColumn("attempt", F.lit(attempt))
     .write.mode("append").partitionBy(day, "attempt").parquet(f"{root}/data"))
    commit(spark, root, day, batch, attempt, sources)
    return True


def commit(spark: SparkSession, root: str, day: str, batch: str, attempt: str, sources: Iterable[str] = ()) -> None:
    """Name the days and rows of an attempt whose files are complete, in one file."""
    try:
        mine = spark.read.option("basePath", f"{root}/data").parquet(f"{root}/data/{day}=*/attempt={attempt}")
        days = mine.groupBy(F.col(day).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    except AnalysisException as e:          # a batch without rows
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        days = spark.createDataFrame([(None, 0)], "day date, rows long")
    named = F.array(*[F.lit(s) for s in sources]).cast("array<string>")
    (days.select(F.lit(batch).alias("batch"), F.lit(attempt).alias("attempt"), "day", "rows", named.alias("sources"))
     .coalesce(1).write.mode("append").parquet(f"{root}/commits"))


def read_committed(spark: SparkSession, root: str, day: str, days: list | None = None,
                   attempts: list[str] | None = None) -> DataFrame | None:
    """Rows of all published batches, or of those ``attempts``, on all or the given ``days``
    (partitions pruned). Two commits of one batch (writers that raced): the first attempt by
    name counts. None if nothing was published."""
    known = commits(spark, root).where("rows > 0")
    first = known.groupBy("batch").agg(F.min("attempt").alias("attempt"))
    if attempts is not None:
        first = first.where(F.col("attempt").isin(attempts))
    n = first.count()
    if not n:
        return None
    rows = spark.read.parquet(f"{root}/data")
    if days is not None:
        rows = rows.where(F.col(day).isin(days))
    if attempts is not None:
        rows = rows.where(F.col("attempt").isin(attempts))
    first = first.select("attempt")
    return rows.join(F.broadcast(first) if n <= EVERY_COMMIT else first, "attempt", "left_semi").drop("attempt")
