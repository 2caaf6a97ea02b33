"""Batch/stream scoring: request checks → features (train counts) → GBT → tiers."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import tiers as tx
from tarmac.operators.featurize import base_features
from tarmac.operators.quality import split_requests
from tarmac.operators.train import model_input
from tarmac.schema import FEATURE_COLS
from tarmac.sources.model_store import ModelBundle


def predict(features: DataFrame, bundle: ModelBundle) -> DataFrame:
    """Adds ``prediction`` (int) and ``p_delayed`` (unrounded P(class 1))."""
    out = bundle.pipeline.transform(model_input(features))
    return (out.withColumn("p_delayed", vector_to_array("probability")[1])
               .withColumn("p_on_time", vector_to_array("probability")[0])
               .withColumn("prediction", F.col("prediction").cast("int"))
               .drop("features", "rawPrediction", "probability"))


def score(requests: DataFrame, bundle: ModelBundle, keep: list[str] | None = None,
          canonicalise: bool = True) -> tuple[DataFrame, DataFrame]:
    """(scored, quarantine). Class from the unrounded score; tiers from the rounded one."""
    keep = [c for c in (keep or []) if c in requests.columns]
    valid, bad = split_requests(requests, canonicalise=canonicalise)
    feats = bundle.encoder.transform(base_features(valid))
    scored = predict(feats.select(*keep, "OP_CARRIER", "ORIGIN", "DEST", *FEATURE_COLS), bundle)
    p = tx.round4("p_delayed")
    out = scored.select(*keep, F.col("prediction").alias("delayed"), p.alias("delay_probability"),
                        tx.risk_level(p).alias("risk_level"),
                        tx.confidence_level(p).alias("confidence"),
                        tx.flight_label().alias("flight"))
    return out, bad
