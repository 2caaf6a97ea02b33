"""Model bundle persistence: Spark ML pipeline + fitted frequency tables, one folder.

A save writes both under a version of their own, then one small manifest file that names
it; a load reads what the last manifest names. A save that died leaves no manifest, so trees
are never paired with the counts of another fit::

    <path>/versions/<version>/pipeline, frequencies
    <path>/manifests/part-...            (version, saved_at), one file a save

Folders written without manifests (``pipeline`` and ``frequencies`` side by side) can be read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tarmac.operators.encode import FrequencyModel


@dataclass
class ModelBundle:
    pipeline: PipelineModel
    encoder: FrequencyModel

    def save(self, path: str) -> str:
        """Returns the folder of the version."""
        version = uuid.uuid4().hex
        folder = f"{path}/versions/{version}"
        self.pipeline.write().save(f"{folder}/pipeline")
        self.encoder.save(f"{folder}/frequencies")
        spark = SparkSession.getActiveSession()
        (spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("saved_at"))
         .coalesce(1).write.mode("append").parquet(f"{path}/manifests"))
        return folder

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ModelBundle":
        folder = saved_folder(spark, path)
        return cls(pipeline=PipelineModel.load(f"{folder}/pipeline"),
                   encoder=FrequencyModel.load(spark, f"{folder}/frequencies"))


def saved_folder(spark: SparkSession, path: str) -> str:
    """The folder of the version that the last manifest names (ties: the greater name)."""
    try:
        saves = spark.read.schema("version string, saved_at timestamp").parquet(f"{path}/manifests")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return path
    last = saves.orderBy(F.col("saved_at").desc(), F.col("version").desc()).limit(1).collect()
    return f"{path}/versions/{last[0]['version']}" if last else path
