"""The batch jobs: preprocess → train → evaluate (+ conditional registration), baseline, monitor.

Each job reads its inputs from tables and writes its outputs as tables,
so a lost executor only costs the tasks of the running stage, and each
hand-over between jobs is a written dataset rather than driver memory.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import drift as dx
from tarmac.operators import metrics as mx
from tarmac.operators import profile as px
from tarmac.operators import quality as qx
from tarmac.operators import registry as rx
from tarmac.operators import split as sx
from tarmac.operators import train as tr
from tarmac.operators.encode import fit_frequencies
from tarmac.operators.featurize import base_features, create_target
from tarmac.operators.scoring import predict
from tarmac.schema import (FEATURE_COLS, GBT_PARAMS, MODEL_GROUP, RANDOM_STATE,
                           REFERENCE_SAMPLE_ROWS, TARGET_COL, TEST_SIZE, VAL_SIZE)
from tarmac.session import scratch_path
from tarmac.sources import committed as cm
from tarmac.sources.csv_landing import normalize_columns
from tarmac.sources.model_store import ModelBundle


def with_row_key(df: DataFrame, id_col: str | None) -> tuple[DataFrame, str]:
    """Rows need a unique key for the seeded split: the id column, or one made of the row's
    content (the same in any file layout, see ``split.content_key``)."""
    if id_col and id_col in df.columns:
        return df, id_col
    return sx.content_key(df), "row_key"


def preprocess(raw: DataFrame, out_dir: str, id_col: str | None = None,
               val_size: float = VAL_SIZE, test_size: float = TEST_SIZE,
               seed: int = RANDOM_STATE, fit_on: str = "train") -> dict:
    """Validate, label, split, encode, profile and write train/val/test + reference outputs.

    ``fit_on="train"`` fits frequencies on the training rows only;
    ``"all"`` counts the whole labelled frame before the split. Flights with neither an
    elapsed time nor a distance go to ``quarantine``.
    """
    spark = raw.sparkSession
    raw = normalize_columns(raw)
    qx.validate_raw_data(raw)
    usable, unusable = qx.split_unusable(raw)
    unusable.write.mode("overwrite").parquet(f"{out_dir}/quarantine")
    labelled, key = with_row_key(create_target(usable), id_col)
    # the split needs key and label only, so it comes before the features
    split = base_features(sx.stratified_split(labelled, id_col=key, test_size=test_size,
                                              val_size=val_size, seed=seed))
    encoder = fit_frequencies(split.where(F.col("split") == "train") if fit_on == "train" else split)
    encoder.save(f"{out_dir}/frequencies")
    feats = encoder.transform(split).select(key, *FEATURE_COLS, TARGET_COL, "split")
    feats.write.mode("overwrite").partitionBy("split").parquet(f"{out_dir}/features")
    written = spark.read.parquet(f"{out_dir}/features")
    train = written.where(F.col("split") == "train")
    sx.reference_sample(train, key, REFERENCE_SAMPLE_ROWS, seed).write.mode("overwrite").parquet(
        f"{out_dir}/reference")
    (spark.read.parquet(f"{out_dir}/reference").write.mode("overwrite").option("header", True)
     .csv(f"{out_dir}/monitoring/reference"))
    px.feature_profile(train).coalesce(1).write.mode("overwrite").json(f"{out_dir}/feature_stats")
    counts = {r["split"]: r["rows"] for r in sx.split_counts(written).collect()}   # 3 rows
    return {"rows": counts, "key": key, "features": f"{out_dir}/features",
            "frequencies": f"{out_dir}/frequencies"}


def evaluate_frame(model, frame: DataFrame) -> DataFrame:
    """One row: n, tp, fp, fn, tn, accuracy, precision, recall, f1, auc."""
    return mx.classification_report(predict(frame, model), TARGET_COL, "p_delayed", "prediction")


def train(spark: SparkSession, prep_dir: str, model_dir: str, params: dict | None = None,
          tags: dict | None = None) -> dict:
    feats = spark.read.parquet(f"{prep_dir}/features")
    train_df = feats.where(F.col("split") == "train")
    val_df = feats.where(F.col("split") == "val")
    p = {**GBT_PARAMS, **(params or {})}
    model = tr.fit_model(train_df, p)
    bundle = ModelBundle(pipeline=model, encoder=_load_encoder(spark, prep_dir))
    bundle.save(model_dir)
    metrics_row = evaluate_frame(bundle, val_df).first().asDict()
    metrics = {f"val_{k}": metrics_row[k] for k in ("accuracy", "f1", "precision", "recall")}
    metrics["val_auc_roc"] = metrics_row["auc"]
    tr.feature_importance(model).write.mode("overwrite").parquet(f"{model_dir}/importance")
    run = tr.run_record(spark, {**p, "n_features": len(FEATURE_COLS)},
                        {"model_type": "GBTClassifier", **(tags or {})}, metrics, model_dir)
    run.write.mode("append").parquet(f"{model_dir}/../runs")
    run_id = spark.read.parquet(f"{model_dir}/../runs").where(F.col("model_uri") == model_dir).agg(
        F.max_by("run_id", "created_at")).first()[0]
    with open_text(spark, f"{model_dir}/metrics.json") as f:
        f.write(json.dumps({"run_id": run_id, "metrics": metrics, "model_uri": model_dir}))
    return metrics


def _load_encoder(spark, prep_dir):
    from tarmac.operators.encode import FrequencyModel
    return FrequencyModel.load(spark, f"{prep_dir}/frequencies")


class open_text:
    """Write a small text document through Spark (works on any Hadoop file system)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.parts = spark, path, []

    def __enter__(self):
        return self

    def write(self, s: str):
        self.parts.append(s)

    def __exit__(self, *exc):
        if exc[0] is None:
            (self.spark.createDataFrame([("".join(self.parts),)], "value string")
             .coalesce(1).write.mode("overwrite").text(self.path))


REGISTRY_SCHEMA = ("package_id long, group_name string, status string, created_at timestamp, "
                   "model_uri string, metrics_uri string, metrics_doc string")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry table; an empty one if nothing has been registered yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], REGISTRY_SCHEMA)
        raise


def evaluate(spark: SparkSession, prep_dir: str, model_dir: str, registry_path: str,
             out_dir: str, group: str = MODEL_GROUP) -> DataFrame:
    """Challenger (val metrics) vs latest approved champion; writes the decision document
    and appends a pending registration when the challenger wins.

    The champion's metrics are those of the document registered with it, or the one at its
    URI. A registration carries the decision document, so the model is known by its metrics
    once it is approved."""
    bundle = ModelBundle.load(spark, model_dir)
    val_df = spark.read.parquet(f"{prep_dir}/features").where(F.col("split") == "val")
    m = evaluate_frame(bundle, val_df)
    doc = F.to_json(F.struct(F.struct(
        F.col("accuracy").alias("val_accuracy"), F.col("f1").alias("val_f1"),
        F.col("auc").alias("val_auc_roc")).alias("challenger")))
    doc_uri = f"{out_dir}/comparison.json"
    challenger = m.select(
        F.lit(group).alias("group_name"), F.lit(-1).cast("long").alias("package_id"),
        F.current_timestamp().alias("created_at"), F.lit("Candidate").alias("status"),
        F.lit(model_dir).alias("model_uri"), F.lit(doc_uri).alias("metrics_uri"),
        doc.alias("metrics_doc"))
    registry = read_registry(spark, registry_path)
    champion = rx.with_documents(spark, rx.latest_per_group(registry, "Approved", group))
    decision = rx.decision_document(rx.compare_champion(challenger, champion))
    decision.select("doc").coalesce(1).write.mode("overwrite").text(doc_uri)
    decision = spark.read.text(doc_uri).select(
        F.lit(group).alias("group_name"), F.lit(-1).cast("long").alias("challenger_package"),
        F.col("value").alias("doc"))
    # conditional registration: flag >= 0.5 → append a pending package. Its id is made of the
    # group, the model and its document, so two evaluations at once take two ids, and one that
    # is run again takes the one it had; ids of older packages may be plain numbers
    winner = rx.registrations(decision, challenger).select("status").collect()       # at most one row
    if winner:
        text = decision.first()["doc"]
        next_id = int(hashlib.sha256("\n".join((group, model_dir, doc_uri, text)).encode()).hexdigest()[:15], 16)
        if not registry.where(F.col("package_id") == next_id).isEmpty():
            return decision
        now = spark.range(1).select(
            F.lit(next_id).cast("long").alias("package_id"), F.lit(group).alias("group_name"),
            F.lit(winner[0]["status"]).alias("status"),
            F.current_timestamp().cast(registry.schema["created_at"].dataType).alias("created_at"),
            F.lit(model_dir).alias("model_uri"), F.lit(doc_uri).alias("metrics_uri"),
            F.lit(text).alias("metrics_doc"))
        now.select(*registry.columns).write.mode("append").parquet(registry_path)
    return decision


def baseline_job(spark: SparkSession, reference_path: str, out_dir: str,
                 cols: list[str] | None = None) -> bool:
    """Profile + exact quantiles, suggested constraints (with the rule of whole numbers) and
    equi-depth bins (feature, edges, counts) of the reference rows.

    Written once: when ``{out_dir}/statistics`` already exists the job is skipped
    (returns False), matching "baseline already exists" behaviour. The statistics are written
    last, so a job that died before is run again as a whole.
    """
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(f"{out_dir}/statistics").schema   # exists → skip
        return False
    except AnalysisException:
        pass
    ref = spark.read.parquet(reference_path)
    cols = cols or [c for c in FEATURE_COLS if c in ref.columns]
    (px.baseline_constraints(ref, cols).join(px.type_rules(ref, cols), "feature")
     .write.mode("overwrite").parquet(f"{out_dir}/constraints"))
    # a row for each distinct value: edges, the rows in their bins and the quantiles all follow from it
    cum = _kept(px.cumulative_counts(px._long_values(ref, cols)), scratch_path(spark, "baseline-values"))
    edges = _kept(dx.edges_of(cum), f"{out_dir}/edges")
    counts = (dx.placed(cum, edges, len(dx.PSI_PROBS)).groupBy("feature")
              .agg(dx.bin_counts(len(dx.PSI_PROBS), weight="cnt").alias("counts")))
    edges.join(counts, "feature").write.mode("overwrite").parquet(f"{out_dir}/bins")
    stats = px.feature_profile(ref, cols).join(px.quantiles_of(cum), "feature", "left")
    stats.write.mode("overwrite").parquet(f"{out_dir}/statistics")
    return True


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_bins(spark: SparkSession, baseline_dir: str) -> DataFrame | None:
    """(feature, edges, counts) of a baseline; None for one written before there were bins."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(f"{baseline_dir}/bins")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def capture_features(capture: DataFrame, encoder, at: str = "captured_at") -> DataFrame:
    """Captured requests → the model's features in long form (captured_at, day, feature, value, text,
    wrong), by the same expressions and training counts as scoring."""
    return dx.long_features(encoder.transform(base_features(capture)), FEATURE_COLS, at)


def _checked_days(spark: SparkSession, stats: DataFrame, baseline_dir: str, out_dir: str,
                  bins: DataFrame | None) -> DataFrame:
    """Write the checks and the alarm of the days of ``stats``; the alarm of all days so far."""
    def by_day(df: DataFrame, name: str) -> DataFrame:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day").parquet(f"{out_dir}/{name}"))
        return spark.read.schema(df.schema).parquet(f"{out_dir}/{name}")

    checked = dx.checks(stats, dx.baseline_of_profile(spark.read.parquet(f"{baseline_dir}/statistics")),
                        spark.read.parquet(f"{baseline_dir}/constraints"), bins=bins)
    days = [r["day"] for r in stats.select("day").distinct().collect()]        # as many as monitored days
    return by_day(dx.alarm_of_checks(by_day(checked, "checks").where(F.col("day").isin(days))), "alarm")


def monitor_job(spark: SparkSession, long: DataFrame, baseline_dir: str, out_dir: str) -> DataFrame:
    """Daily statistics of captured values against the stored baseline; writes checks and alarm.

    For days at hand as a whole (a backfill); ``monitor_new`` goes on from day to day.
    ``baseline_dir`` holds what ``baseline_job`` wrote. Every check of every monitored day is
    written with a ``failed`` flag, so a day that is run again replaces all of its rows, and
    a day without violations is a day with rows."""
    bins = read_bins(spark, baseline_dir)
    parts = dx.partial_stats(long, bins, len(dx.PSI_PROBS))
    fresh = dx.merged_stats(_kept(parts, scratch_path(spark, "monitor-parts")))
    days = _kept(fresh, scratch_path(spark, "monitor-stats"))
    (days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(f"{out_dir}/daily_stats"))
    return _checked_days(spark, days, baseline_dir, out_dir, bins)


def monitor_new(spark: SparkSession, capture_dir: str, encoder, baseline_dir: str, out_dir: str,
                day: str = "capture_date", at: str = "captured_at") -> DataFrame | None:
    """Check what was captured since the last run; returns the alarm of all days so far.

    A run reads the published batches that no earlier run has read, only in the day
    partitions they wrote to, and publishes their additive statistics and bin counts per
    (day, feature) together with the names of the batches. Days with new parts are merged
    from all their parts and checked again, so rows that come late count for their day. A
    run that died before its parts were published leaves nothing, the next one reads the
    same batches."""
    states = f"{out_dir}/states"
    read = cm.commits(spark, states).select(F.explode("sources").alias("attempt")).distinct()
    fresh = cm.commits(spark, capture_dir).where("rows > 0").join(read, "attempt", "left_anti").collect()
    bins = read_bins(spark, baseline_dir)
    if fresh:                                # a row for each new batch and day
        attempts, days = sorted({r["attempt"] for r in fresh}), sorted({r["day"] for r in fresh})
        rows = cm.read_committed(spark, capture_dir, day, days, attempts)
        run = hashlib.sha256(",".join(attempts).encode()).hexdigest()[:24]
        if rows is not None:
            long = capture_features(rows, encoder, at)
            cm.publish(dx.partial_stats(long, bins, len(dx.PSI_PROBS)), states, "day", run, attempts)
    # days whose parts were published but not checked, by this run or one that died since
    done = _checked_parts(spark, out_dir)
    todo = cm.commits(spark, states).where("rows > 0").join(done, ["batch", "day"], "left_anti").select("batch", "day").collect()
    if todo:
        days = sorted({r["day"] for r in todo})
        stats = dx.merged_stats(cm.read_committed(spark, states, "day", days))
        _checked_days(spark, _kept(stats, scratch_path(spark, "monitor-stats")), baseline_dir, out_dir, bins)
        (spark.createDataFrame([(r["batch"], r["day"]) for r in todo], "batch string, day date")
         .coalesce(1).write.mode("append").parquet(f"{out_dir}/checked"))
    return spark.read.parquet(f"{out_dir}/alarm") if fresh or todo or not done.isEmpty() else None


def _checked_parts(spark: SparkSession, out_dir: str) -> DataFrame:
    """(batch, day) of published parts that have been checked."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema("batch string, day date").parquet(f"{out_dir}/checked")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "batch string, day date")
