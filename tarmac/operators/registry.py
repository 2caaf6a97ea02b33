"""Model registry operators: latest approved package, champion/challenger, decision document.

"Latest per group" hash-aggregates fixed-width maxima (created_at, then package_id among
the newest) and fetches the winning rows with semi-joins, so neither the wide columns nor
the JSON text are sorted or shuffled for it, and a group holding a third of all rows is
combined map-side like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.docs import json_path_double, split_object_uri
from tarmac.functions.tiers import round4
from tarmac.schema import IMPROVEMENT_THRESHOLD, METRIC_TO_COMPARE

METRICS_SCHEMA = T.StructType([
    T.StructField("val_accuracy", T.DoubleType()),
    T.StructField("val_f1", T.DoubleType()),
    T.StructField("val_auc_roc", T.DoubleType()),
])
DOC_SCHEMA = T.StructType([T.StructField("challenger", METRICS_SCHEMA)])
PACKAGE_FIELDS = ["package_id", "created_at", "status", "model_uri", "metrics_uri", "metrics_doc"]


def latest_per_group(registry: DataFrame, status: str | None = None,
                     group: str | None = None) -> DataFrame:
    """(group_name, package fields…) of the newest package per group (ties: larger id)."""
    r = registry
    if status is not None:
        r = r.where(F.col("status") == status)
    if group is not None:
        r = r.where(F.col("group_name") == group)
    r = r.select("group_name", *PACKAGE_FIELDS)
    newest = r.groupBy("group_name").agg(F.max("created_at").alias("_at"))
    same_group = F.col("r.group_name").eqNullSafe(F.col("m.group_name"))
    at = r.alias("r").join(newest.alias("m"), same_group & F.col("r.created_at").eqNullSafe(F.col("m._at")),
                           "left_semi")
    last = at.groupBy("group_name").agg(F.max("package_id").alias("_id"))
    return at.alias("r").join(last.alias("m"), same_group & F.col("r.package_id").eqNullSafe(F.col("m._id")),
                              "left_semi")


def with_documents(spark, packages: DataFrame) -> DataFrame:
    """``packages`` (one row per group, few) with ``metrics_doc`` read from the document at
    ``metrics_uri`` where the registry holds no text of it. An empty URI means no document;
    one that can't be read is an error."""
    wanted = (packages.where(F.col("metrics_doc").isNull() & (F.col("metrics_uri") != ""))
              .select("package_id", "metrics_uri").collect())
    if not wanted:
        return packages
    texts = []
    for r in wanted:
        lines = spark.read.text(r["metrics_uri"], wholetext=True).collect()
        if not lines:
            raise ValueError(f"no document at {r['metrics_uri']}")
        texts.append((r["package_id"], "".join(x["value"] for x in lines)))
    read = spark.createDataFrame(texts, "_id long, _doc string")
    return (packages.join(F.broadcast(read), F.col("package_id") == F.col("_id"), "left")
            .withColumn("metrics_doc", F.coalesce("metrics_doc", "_doc")).drop("_id", "_doc"))


def package_metrics(packages: DataFrame) -> DataFrame:
    """Metrics stored with each package; no URI or no ``challenger`` key → no metrics."""
    bucket, key = split_object_uri("metrics_uri")
    doc = F.from_json("metrics_doc", DOC_SCHEMA)
    has_doc = F.col("metrics_uri") != ""
    m = F.when(has_doc, doc["challenger"])
    return packages.select("*", bucket.alias("metrics_bucket"), key.alias("metrics_key"),
                           m.alias("metrics"))


def compare_champion(challenger: DataFrame, champion: DataFrame,
                     metric: str = METRIC_TO_COMPARE,
                     threshold: float = IMPROVEMENT_THRESHOLD) -> DataFrame:
    """Per group: challenger vs champion on ``metric``; absent champion scores 0.0.

    ``beats_champion`` uses the unrounded difference; ``improvement`` is stored rounded.
    Both inputs hold one row per group, so the join is between two small tables.
    """
    ch = package_metrics(challenger).select(
        "group_name", F.col("package_id").alias("challenger_package"),
        F.col("metrics").alias("challenger_metrics"))
    cp = package_metrics(champion).select(
        "group_name", F.col("package_id").alias("champion_package"),
        F.col("metrics").alias("champion_metrics"))
    j = ch.join(cp, "group_name", "left")
    c_score = F.coalesce(F.col(f"challenger_metrics.{metric}"), F.lit(0.0))
    p_score = F.coalesce(F.col(f"champion_metrics.{metric}"), F.lit(0.0))
    diff = c_score - p_score
    return j.select(
        "group_name", "challenger_package", "champion_package",
        "challenger_metrics", "champion_metrics",
        c_score.alias("challenger_score"), p_score.alias("champion_score"),
        round4(diff).alias("improvement"),
        (diff >= threshold).alias("beats_champion"),
    )


def decision_document(comparison: DataFrame, metric: str = METRIC_TO_COMPARE,
                      threshold: float = IMPROVEMENT_THRESHOLD) -> DataFrame:
    """(group_name, challenger_package, doc) with ``doc`` the decision as JSON text."""
    flag = F.when(F.col("beats_champion"), 1.0).otherwise(0.0)
    none = F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in METRICS_SCHEMA))
    doc = F.struct(
        F.col("challenger_metrics").alias("challenger"),
        F.coalesce("champion_metrics", none).alias("champion"),       # no champion: {}
        F.struct(F.lit(metric).alias("metric"), F.col("challenger_score").alias("challenger"),
                 F.col("champion_score").alias("champion"), F.col("improvement"),
                 F.lit(threshold).alias("threshold"), F.col("beats_champion")).alias("comparison"),
        F.struct(F.struct(flag.alias("value")).alias("challenger_beats_champion"),
                 F.struct(F.col("challenger_score").alias("value")).alias("challenger_f1"))
        .alias("metrics"))
    return comparison.select("group_name", "challenger_package", F.to_json(doc).alias("doc"))


def read_decision(docs: DataFrame) -> DataFrame:
    """JSON-path reads the conditional step uses."""
    return docs.select(
        "group_name", "challenger_package",
        json_path_double("doc", "$.metrics.challenger_beats_champion.value").alias("beats_value"),
        json_path_double("doc", "$.metrics.challenger_f1.value").alias("challenger_f1"),
        json_path_double("doc", "$.comparison.improvement").alias("improvement"))


def registrations(decisions: DataFrame, packages: DataFrame, min_flag: float = 0.5) -> DataFrame:
    """Registry rows to append for challengers whose decision flag ≥ ``min_flag``."""
    winners = read_decision(decisions).where(F.col("beats_value") >= min_flag)
    return (winners.join(packages.select(F.col("package_id").alias("challenger_package"),
                                         "model_uri", "metrics_uri"),
                         "challenger_package")
            .select("group_name", F.col("challenger_package").alias("package_id"),
                    F.lit("PendingManualApproval").alias("status"), "model_uri", "metrics_uri"))
