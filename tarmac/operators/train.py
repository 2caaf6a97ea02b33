"""Distributed gradient-boosted trees on the 14 features (a Spark ML model).

Trees are grown from per-partition histograms merged per tree level
(``operators/boost``); the binned rows are cached once and reused in every
iteration. Results are not numerically equal to another library's
trees; quality is judged by thresholds.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.boost import as_model, fit_trees
from tarmac.schema import (BEHAVIOUR_RATIO, FEATURE_COLS, GBT_PARAMS, GATE_ACCURACY, GATE_AUC,
                           GATE_F1, TARGET_COL)

# a missing date leaves day-of-week / month NULL; trees get a value of their own
MISSING_FEATURE_VALUE = -1


def model_input(df: DataFrame) -> DataFrame:
    return df.na.fill(MISSING_FEATURE_VALUE, subset=FEATURE_COLS)


MAX_BINS = 64


def fit_model(train: DataFrame, params: dict | None = None) -> PipelineModel:
    """Assembler + boosted trees, as a Spark ML pipeline model."""
    p = {**GBT_PARAMS, **(params or {})}
    gbt = GBTClassifier(featuresCol="features", labelCol="label",
                        maxIter=int(p["n_estimators"]), maxDepth=int(p["max_depth"]),
                        stepSize=float(p["learning_rate"]),
                        minInstancesPerNode=int(p["min_samples_leaf"]),
                        seed=int(p["random_state"]), maxBins=MAX_BINS)
    # read twice, for the split candidates and for the bins
    data = model_input(train).persist(StorageLevel.DISK_ONLY)
    try:
        trees, thresholds = fit_trees(data, FEATURE_COLS, TARGET_COL, gbt.getMaxIter(), gbt.getMaxDepth(),
                                      gbt.getStepSize(), gbt.getMinInstancesPerNode(), MAX_BINS)
    finally:
        data.unpersist()
    assembler = VectorAssembler(inputCols=FEATURE_COLS, outputCol="features", handleInvalid="keep")
    return PipelineModel([assembler, as_model(gbt, trees, thresholds)])


def feature_importance(model) -> DataFrame:
    """(feature, importance, rank) from the fitted trees, descending."""
    spark = SparkSession.getActiveSession()
    gbt = model.stages[-1]
    # 14 model parameters, not data: ranked while building the rows
    pairs = sorted(zip(FEATURE_COLS, gbt.featureImportances.toArray()), key=lambda t: (-t[1], t[0]))
    rows = [(name, float(v), i) for i, (name, v) in enumerate(pairs, start=1)]
    return spark.createDataFrame(rows, "feature string, importance double, rank int")


# ── the fitted trees as a table ───────────────────────────────────────


def node_table(spark: SparkSession, pipeline_path: str) -> DataFrame:
    """(tree, weight, node, feature, threshold, left, right, value, gain, rows) of a saved model:
    a row per node, leaves with null ``feature``. Its size follows the model, not the data."""
    saved = f"{pipeline_path}/stages/*_GBTClassifier_*"
    weights = spark.read.parquet(f"{saved}/treesMetadata").toDF("tree", "_meta", "weight").select("tree", "weight")
    n, inner = F.col("nodeData"), F.col("nodeData.leftChild") >= 0
    nodes = spark.read.parquet(f"{saved}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"),
        F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        F.when(inner, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner, n["leftChild"]).alias("left"), F.when(inner, n["rightChild"]).alias("right"),
        n["prediction"].alias("value"), F.when(inner, n["gain"]).alias("gain"), n["rawCount"].alias("rows"))
    return nodes.join(F.broadcast(weights), "tree")


def tree_walk(rows: DataFrame, nodes: DataFrame, id_col: str, depth: int) -> DataFrame:
    """(id, p_delayed): every row goes down every tree, a level a join. Nodes are broadcast (their
    number is bounded by the model); the rows are not shuffled until the trees' values are
    summed per row, partly before the exchange."""
    trees = nodes.select("tree").distinct().count()
    x = F.array(*[F.col(c).cast("double") for c in FEATURE_COLS])
    at = (model_input(rows).select(id_col, x.alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
          .withColumn("node", F.lit(0)))
    step = F.broadcast(nodes.select("tree", "node", "feature", "threshold", "left", "right"))
    for _ in range(depth):
        goes_left = F.get("_x", F.col("feature")) <= F.col("threshold")
        at = at.join(step, ["tree", "node"]).select(id_col, "_x", "tree", F.when(
            F.col("feature").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right")).alias("node"))
    leaves = F.broadcast(nodes.where("feature is null").select("tree", "node", (F.col("weight") * F.col("value")).alias("_v")))
    margin = at.join(leaves, ["tree", "node"]).groupBy(id_col).agg(F.sum("_v").alias("_m"))
    return margin.select(id_col, (1 / (1 + F.exp(-2 * F.col("_m")))).alias("p_delayed"))


def importance_of_gains(nodes: DataFrame) -> DataFrame:
    """(feature, importance): each feature's share of all gains, weighted by the rows of the nodes."""
    names = F.array(*[F.lit(c) for c in FEATURE_COLS])
    by = (nodes.where("feature is not null").groupBy(F.get(names, F.col("feature")).alias("feature"))
          .agg(F.sum(F.col("gain") * F.col("rows")).alias("_g")))
    every = nodes.sparkSession.createDataFrame([(c,) for c in FEATURE_COLS], "feature string")
    total = F.sum("_g").over(Window.partitionBy())                               # a row a feature
    return every.join(F.broadcast(by), "feature", "left").select(
        "feature", F.coalesce(F.try_divide(F.col("_g"), total), F.lit(0.0)).alias("importance"))


RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("model_uri", T.StringType()),
])


def run_record(spark: SparkSession, params: dict, tags: dict, metrics: dict,
               model_uri: str) -> DataFrame:
    """One row describing a training run (append it to a runs table)."""
    row = (str(uuid.uuid4()), dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
           {k: str(v) for k, v in params.items()}, {k: str(v) for k, v in tags.items()},
           {k: float(v) for k, v in metrics.items()}, model_uri)
    return spark.createDataFrame([row], RUN_SCHEMA)


def quality_gates(metrics: DataFrame) -> DataFrame:
    """(gate, value, threshold, passed) from a row with accuracy / f1 / auc columns."""
    gates = [("accuracy", "accuracy", GATE_ACCURACY), ("f1", "f1", GATE_F1), ("auc", "auc", GATE_AUC)]
    rows = [F.struct(F.lit(g).alias("gate"), F.col(c).alias("value"),
                     F.lit(t).alias("threshold"), (F.col(c) >= t).alias("passed"))
            for g, c, t in gates]
    return metrics.select(F.inline(F.array(*rows)))


def behaviour_summary(scored: DataFrame, slot: str, morning: int, evening: int) -> DataFrame:
    """One row over scored (flight, slot) copies: pair count, class and probability ranges,
    largest |P(0) + P(1) − 1|, mean P(delay) per slot, and whether the evening mean is at
    least 0.8 × the morning mean. Every figure is a plain aggregate over the copies, so no
    per-flight grouping (and no shuffle of the copies) is needed."""
    s, p = F.col(slot), F.col("p_delayed")
    err = F.abs(p + F.col("p_on_time") - 1)
    out = scored.agg(F.count(F.when(s == morning, F.lit(1))).alias("pairs"),
                     F.min("prediction").alias("min_pred"), F.max("prediction").alias("max_pred"),
                     F.min(p).alias("min_p"), F.max(p).alias("max_p"),
                     F.max(err).alias("max_sum_error"),
                     F.avg(F.when(s == morning, p)).alias("mean_p_morning"),
                     F.avg(F.when(s == evening, p)).alias("mean_p_evening"))
    return out.withColumn("evening_not_lower",
                          F.col("mean_p_evening") >= BEHAVIOUR_RATIO * F.col("mean_p_morning"))
